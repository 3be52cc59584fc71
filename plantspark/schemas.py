"""Table layouts, declared value domains and fixed lookup values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


S, D, L, B, TS = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType(), T.TimestampType()

MESSAGE = _struct(topic=S, payload=S, arrived_at=TS)

SENSOR_FIELDS = [
    "temperature", "power", "rpm_spindle", "feed_rate",
    "vibration_level", "cut_depth", "blade_speed", "material_feed",
]
SENSOR_TAGS = ["machine", "machine_type", "location"]
EVENT_TAGS = ["machine", "event_type", "piece_id", "tool"]
EVENT_FIELDS = ["duration", "status", "tool_wear", "cycle_time"]
PIECE_TAGS = ["piece_id", "event_type", "from_station", "to_station", "material"]
PIECE_FIELDS = ["duration", "distance", "operator", "priority"]
SYSTEM_TAGS = ["component", "metric_type", "severity"]
SYSTEM_FIELDS = ["cpu", "free_memory", "ram", "errors", "memory_used_percent", "uptime_seconds"]

ANOMALY = _struct(rule=S, severity=S, message=S, value=D)

SENSOR_DATA = _struct(
    _time=TS, machine=S, machine_type=S, location=S,
    **{f: D for f in SENSOR_FIELDS},
    extra_fields=T.MapType(S, D), anomalies=T.ArrayType(ANOMALY), ts_defaulted=B,
)
MACHINE_EVENTS = _struct(
    _time=TS, machine=S, event_type=S, piece_id=S, tool=S,
    duration=D, status=S, tool_wear=D, cycle_time=D, ts_defaulted=B,
)
PIECE_TRACKING = _struct(
    _time=TS, piece_id=S, event_type=S, from_station=S, to_station=S, material=S,
    duration=D, distance=D, operator=S, priority=L, ts_defaulted=B,
)
SYSTEM_TRACKING = _struct(
    _time=TS, component=S, metric_type=S, severity=S,
    cpu=D, free_memory=D, ram=D, errors=L, memory_used_percent=D, uptime_seconds=D,
)
ALERTS = _struct(
    _time=TS, _measurement=S, machine=S, severity=S, alert_type=S, rule=S,
    message=S, value=D, resolved=B,
)
REJECTS = _struct(topic=S, payload=S, arrived_at=TS, reason=S)
PIPELINE_STATS = _struct(
    _time=TS, messages_received=L, messages_processed=L, errors=L, unknown_topics=L,
    first_message_at=TS, last_message_at=TS, processing_rate=D,
)
STREAM_LOG = _struct(
    _time=TS, query=S, run=S, kind=S, batch=L, rows=L, rows_per_second=D, millis=L, error=S,
)

TABLES = {
    "sensor_data": SENSOR_DATA,
    "machine_events": MACHINE_EVENTS,
    "piece_tracking": PIECE_TRACKING,
    "system_tracking": SYSTEM_TRACKING,
    "alerts": ALERTS,
    "rejects": REJECTS,
    "pipeline_stats": PIPELINE_STATS,
    "stream_log": STREAM_LOG,
}

# Measurements every plant store should hold, and its stores.
EXPECTED_MEASUREMENTS = ["sensor_data", "machine_events", "piece_tracking", "system_tracking"]
EXPECTED_STORES = ["industrial_data", "historical_data", "alerts", "system_metrics"]

# Days each store keeps its points.
RETENTION_DAYS = {"industrial_data": 7, "historical_data": 365, "alerts": 30, "system_metrics": 14}

# Metres between stations, valid both ways, and the distance of any other pair.
STATION_DISTANCES = {
    ("Warehouse", "Saw1"): 30.0,
    ("Saw1", "Milling1"): 25.0,
    ("Saw1", "Milling2"): 35.0,
    ("Saw1", "Lathe1"): 40.0,
    ("Milling1", "Warehouse"): 45.0,
    ("Milling2", "Warehouse"): 50.0,
    ("Lathe1", "Warehouse"): 55.0,
}
DEFAULT_DISTANCE = 30.0


@dataclass(frozen=True)
class Domain:
    """What one declared column may hold; unset parts allow anything."""

    column: str
    values: tuple[str, ...] = ()
    pattern: str = ""
    low: float | None = None
    high: float | None = None
    machine_types: tuple[str, ...] = ()


# The declared domains.
MACHINES = ("Milling1", "Milling2", "Lathe1", "Saw1")
STATIONS = ("Warehouse", "Saw1", "Milling1", "Milling2", "Lathe1")
PIECE_PATTERN = "PZ[0-9]{3}"
DOMAINS = {
    "sensor_data": [
        Domain("machine", values=MACHINES),
        Domain("machine_type", values=("Milling", "Lathe", "Saw")),
        Domain("location", values=("workshop_A", "workshop_B")),
        Domain("shift", values=("morning", "afternoon", "night")),
        Domain("temperature", low=20, high=100),
        Domain("power", low=0, high=10),
        Domain("rpm_spindle", low=1000, high=4000, machine_types=("Milling", "Lathe")),
        Domain("feed_rate", low=200, high=400, machine_types=("Milling",)),
        Domain("vibration_level", low=0, high=5, machine_types=("Milling",)),
        Domain("cut_depth", low=0.5, high=5.0, machine_types=("Lathe",)),
        Domain("blade_speed", low=1500, high=2500, machine_types=("Saw",)),
        Domain("material_feed", low=0.5, high=2.0, machine_types=("Saw",)),
    ],
    "machine_events": [
        Domain("machine", values=MACHINES),
        Domain("event_type", values=("setup_start", "setup_end", "processing_start", "processing_end")),
        Domain("piece_id", pattern=PIECE_PATTERN),
        Domain("tool", values=("TM10", "TM25", "TM12", "TM30", "TL05", "TL08")),
        Domain("status", values=("active", "completed", "error")),
        Domain("tool_wear", low=0, high=1),
    ],
    "piece_tracking": [
        Domain("piece_id", pattern=PIECE_PATTERN),
        Domain("event_type", values=("move_start", "move_end", "deposit")),
        Domain("from_station", values=STATIONS),
        Domain("to_station", values=STATIONS),
        Domain("material", values=("steel", "alu")),
        Domain("priority", low=1, high=5),
    ],
    "system_tracking": [
        Domain("component", values=("event_processor", "mqtt_broker", "database")),
        Domain("metric_type", values=("system_resources", "health", "error")),
        Domain("severity", values=("info", "warning", "error")),
        Domain("cpu", low=0, high=100),
    ],
}
