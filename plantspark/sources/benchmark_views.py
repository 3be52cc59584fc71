"""The benchmark's `events` table seen as the measurement tables of a plant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
BASE = [
    "event_id", "ts as _time", "user_id", "event_type", "value",
    "cast(get_json_object(props, '$.k') as int) as k",
    "case user_id % 4 when 0 then 'Milling1' when 1 then 'Milling2' when 2 then 'Lathe1' else 'Saw1' end as machine",
    "case when user_id % 4 < 2 then 'Milling' when user_id % 4 = 2 then 'Lathe' else 'Saw' end as machine_type",
]
SENSOR_WIDE = [
    "event_id", "_time", "machine", "machine_type", "'workshop_A' as location",
    "20.0d + value/4 as temperature", "value/50 as power",
    "case when machine_type = 'Milling' then value/100 end as vibration_level",
    "case when machine_type in ('Milling', 'Lathe') then value*10 end as rpm_spindle",
]
SENSOR_LONG = [
    "event_id", "_time", "machine", "machine_type",
    "case event_type when 'view' then 'temperature' when 'click' then 'power' when 'error' then 'vibration_level'"
    " when 'purchase' then 'rpm_spindle' else 'feed_rate' end as _field",
    "value as _value",
]
MACHINE_EVENTS = [
    "event_id", "_time", "machine",
    "case event_type when 'click' then 'processing_start' when 'purchase' then 'processing_end'"
    " when 'signup' then 'setup_start' when 'view' then 'setup_end' else 'deposit' end as event_type",
    "concat('PZ', lpad(cast(k as varchar(10)), 3, '0')) as piece_id",
    "case k % 7 when 0 then 'TM10' when 1 then 'TM25' when 2 then 'TM12' when 3 then 'TM30'"
    " when 4 then 'TL05' when 5 then 'TL08' end as tool",
    "(value % 100)/100 as tool_wear",
    "case when event_type = 'purchase' then value/10 end as cycle_time",
]
_STATION = " when 0 then 'Warehouse' when 1 then 'Saw1' when 2 then 'Milling1' when 3 then 'Milling2' else 'Lathe1' end"
PIECE_TRACKING = [
    "event_id", "_time", "concat('PZ', lpad(cast(k as varchar(10)), 3, '0')) as piece_id",
    "case event_type when 'click' then 'move_start' when 'signup' then 'move_start'"
    " when 'view' then 'deposit' else 'move_end' end as event_type",
    f"case k % 5{_STATION} as from_station",
    f"case (k + 1 + user_id % 4) % 5{_STATION} as to_station",
    "value/10 as duration", "1 + k % 5 as priority",
]
SYSTEM_TRACKING = [
    "event_id", "_time",
    "case user_id % 3 when 0 then 'event_processor' when 1 then 'mqtt_broker' else 'database' end as component",
    "case k % 3 when 0 then 'system_resources' when 1 then 'health' else 'error' end as metric_type",
    "case event_type when 'error' then 'error' when 'view' then 'warning' else 'info' end as severity",
    "value % 100 as cpu", "8.0d - k/20.0d as free_memory", "8.0d as ram", "cast(k as bigint) as errors",
    "k * 1.0d as memory_used_percent", "value * 60 as uptime_seconds",
]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """New event files as they appear. Only jobs without a watermark may take them in portions:
    files are not in time order, so a later portion could come too late.
    """
    # A pattern, because a stream takes a plain path for a folder and the table may be one file.
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{sf_dir}/events[.]parquet")


def view(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One of the column lists above over raw events; works on a stream as well."""
    return rows.selectExpr(*BASE).selectExpr(*columns)


def zoned(rows: DataFrame) -> DataFrame:
    """The same rows with `_time` as an instant, which watermarks need."""
    return rows.withColumn("_time", F.col("_time").cast("timestamp"))


def messages(rows: DataFrame) -> DataFrame:
    """Raw events as bus messages, sound and unsound ones.

    view -> reading; error -> broken JSON, reading without data, or a topic nobody handles; click and
    purchase -> machine events (the saw's tool is null); signup -> piece movement. The stamp is plain,
    ISO with `Z`, ISO with an offset, or missing, by `k % 4`; messages arrive a second after.
    """
    base = rows.selectExpr(*BASE).selectExpr(
        "*",
        "concat('PZ', lpad(cast(k as string), 3, '0')) as piece",
        f"case k % 5{_STATION} as origin",
        f"case (k + 1 + user_id % 4) % 5{_STATION} as target",
    )
    return base.selectExpr(
        """case when event_type = 'error' and k % 3 = 2 then concat('/plant/alerts/', machine)
                when event_type in ('view', 'error') then concat('/plant/data/', machine)
                when event_type = 'signup' then '/plant/tracking/piece'
                else concat('/plant/tracking/', machine) end as topic""",
        """concat(
             '{"entity":"', if(event_type = 'signup', 'piece', machine), '"',
             case event_type when 'click' then ',"event":"processing_start"'
               when 'purchase' then ',"event":"processing_end"' when 'signup' then ',"event":"move_end"' else '' end,
             ',"data":{',
             case when event_type = 'view' then concat(
                  '"temperature":', 20.0d + value/4, ',"power":', value/50,
                  if(machine_type = 'Milling', concat(',"vibration_level":', value/100), ''),
                  if(machine_type in ('Milling', 'Lathe'), concat(',"rpm_spindle":', value*10), ''),
                  ',"coolant_level":', k, ',"door_open":', k % 2 = 0, ',"note":"auto","serial":"12"')
               when event_type in ('click', 'purchase') then concat(
                  '"piece_id":"', piece, '","tool":', if(machine_type = 'Saw', 'null', '"TM10"'),
                  if(event_type = 'purchase', concat(',"cycle_time":', value/10), ''))
               when event_type = 'signup' then concat(
                  '"piece_id":"', piece, '","from":"', origin, '","to":"', target, '","duration":"', value/10, '"')
               else '' end, '}',
             case k % 4 when 0 then concat(',"timestamp":"', date_format(_time, 'yyyy-MM-dd HH:mm:ss'), '"')
               when 1 then concat(',"timestamp":"', date_format(_time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), 'Z"')
               when 2 then concat(',"timestamp":"',
                 date_format(_time + interval 2 hours, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), '+02:00"')
               else '' end,
             if(event_type = 'error' and k % 3 = 0, '', '}')) as payload""",
        "cast(_time as timestamp) + interval 1 second as arrived_at",
    )
