"""Every operator and report run over the whole benchmark tables.

Each entry takes (spark, sf_dir). Ranges end at AS_OF and reach back over all data. Sums of doubles
are rounded to six places, because their last bits depend on the order of addition; the small shift
before it keeps exact halves, as means of few decimals often are, from going either way.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from plantspark.functions import panels, plant, rules
from plantspark.operators import alerts as alert_ops, neighbours, normalise, quality, rollups, series
from plantspark.plans import reports
from plantspark.session import new_folder, prepare
from plantspark.schemas import (
    EVENT_FIELDS, EXPECTED_MEASUREMENTS, EXPECTED_STORES, PIECE_FIELDS, SENSOR_FIELDS, SYSTEM_FIELDS,
)
from plantspark.sources import benchmark_views as views, messages as bus, tables
from plantspark.streaming import closed_ranges, in_order, ingest, live, watch, windows

AS_OF = "2024-01-31 00:00:00"
LOOKBACK = "30 days"
SHIFT = 3.7e-10
FILES_PER_BATCH = 1000
WIDE_FIELDS = ["temperature", "power", "vibration_level", "rpm_spindle"]
LONG_FIELDS = ["temperature", "power", "vibration_level", "rpm_spindle", "feed_rate"]
LONG_SERIES = ["machine", "machine_type", "_field"]

PROCESSING = ("processing_start", "processing_end")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Registers a function under its own name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def _view(columns: list[str]) -> Query:
    return lambda spark, sf_dir: views.view(views.events(spark, sf_dir), columns)


sensor = _view(views.SENSOR_WIDE)
long_sensor = _view(views.SENSOR_LONG)
events = _view(views.MACHINE_EVENTS)
pieces = _view(views.PIECE_TRACKING)
system = _view(views.SYSTEM_TRACKING)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_ops.with_anomalies(sensor(spark, sf_dir))


def alert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_ops.alerts(readings(spark, sf_dir), ["event_id"])


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.checked(views.messages(views.events(spark, sf_dir)))


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + SHIFT, places) for c in columns})


def plain(df: DataFrame) -> DataFrame:
    """Instants as stamps without a zone, as the benchmark's own tables have them."""
    zoned = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


# --- messages ---------------------------------------------------------------------------------


@query
def topic_filter(spark, sf_dir):
    """Messages per subscription they fit."""
    rows = views.messages(views.events(spark, sf_dir))
    fits = F.filter(
        F.array(*[F.when(bus.topic_matches(F.col("topic"), p), F.lit(p)) for p in bus.TOPICS]),
        lambda p: p.isNotNull(),
    )
    return rows.select(F.explode(fits).alias("subscription"), "topic").groupBy("subscription", "topic").agg(
        F.count(F.lit(1)).alias("messages"))


@query
def decode_envelope(spark, sf_dir):
    """Readable messages with entity and event, and the number of entries of their data."""
    rows = bus.decode(views.messages(views.events(spark, sf_dir)))
    return plain(rows.where("readable").select(
        "arrived_at", F.col("entity.text").alias("entity"), F.col("event.text").alias("event"),
        F.size("body").cast("bigint").alias("entries"),
    ))


@query
def route_messages(spark, sf_dir):
    rows = bus.route(bus.decode(views.messages(views.events(spark, sf_dir))))
    return rows.groupBy("kind", "topic").agg(F.count(F.lit(1)).alias("messages"))


@query
def parse_timestamp(spark, sf_dir):
    """Stamp of every sound message, and whether it is the arrival time."""
    rows = checked(spark, sf_dir).where(F.col("reason").isNull())
    return plain(normalise.stamped(rows).select("arrived_at", "_time", "ts_defaulted"))


@query
def normalise_sensor(spark, sf_dir):
    rows = normalise.sensor_readings(checked(spark, sf_dir))
    extra = [F.try_element_at("extra_fields", F.lit(f)).alias(f) for f in ("coolant_level", "door_open")]
    return plain(rows.select(
        "_time", "machine", "machine_type", "location", *WIDE_FIELDS, *extra,
        F.size("extra_fields").cast("bigint").alias("extra_count"),
    ))


@query
def numeric_fields_long(spark, sf_dir):
    rows = normalise.accepted(checked(spark, sf_dir), "sensor").drop("topic", "payload")
    return plain(normalise.numeric_fields_long(rows))


@query
def normalise_machine_event(spark, sf_dir):
    return plain(normalise.machine_events(checked(spark, sf_dir)))


@query
def event_duration_status(spark, sf_dir):
    rows = normalise.machine_events(checked(spark, sf_dir))
    return rows.groupBy("event_type", "status", "duration").agg(F.count(F.lit(1)).alias("events"))


@query
def optional_tags(spark, sf_dir):
    """Tags with a JSON null written as text, as the stored points have it."""
    rows = normalise.machine_events(checked(spark, sf_dir), null_text="None")
    return rows.groupBy("machine", "tool").agg(F.count(F.lit(1)).alias("events"))


@query
def normalise_piece_tracking(spark, sf_dir):
    return plain(normalise.piece_movements(checked(spark, sf_dir)).drop("operator"))


@query
def reject_invalid(spark, sf_dir):
    return plain(normalise.rejects(checked(spark, sf_dir)).select("topic", "arrived_at", "reason"))


@query
def machine_type(spark, sf_dir):
    return sensor(spark, sf_dir).groupBy("machine", F.expr(plant.machine_type()).alias("derived_type")).agg(
        F.count(F.lit(1)).alias("readings"))


@query
def piece_material(spark, sf_dir):
    return pieces(spark, sf_dir).groupBy("piece_id", F.expr(plant.piece_material()).alias("material")).agg(
        F.count(F.lit(1)).alias("movements"))


@query
def station_distance(spark, sf_dir):
    metres = F.expr(plant.station_distance())
    return rounded(pieces(spark, sf_dir).groupBy("from_station", "to_station").agg(
        F.count(F.lit(1)).alias("movements"), F.sum(metres).alias("metres")), "metres")


@query
def to_long(spark, sf_dir):
    return series.to_long(sensor(spark, sf_dir), ["event_id", "_time", "machine"], WIDE_FIELDS)


def decoded_readings(spark, sf_dir) -> DataFrame:
    return normalise.sensor_readings(checked(spark, sf_dir))


@query
def to_long_all_fields(spark, sf_dir):
    """Every field of decoded readings, those that no layout declares included."""
    return plain(series.to_long(decoded_readings(spark, sf_dir), ["_time", "machine"], SENSOR_FIELDS, "extra_fields"))


@query
def dedup_points(spark, sf_dir):
    """Alerts of equal measurement, tags and stamp are one point; the rule written last stays."""
    order = F.expr("array_position(array('temperature', 'vibration', 'power', 'rpm'), rule)").alias("written")
    rows = alert_rows(spark, sf_dir).select(
        "_measurement", "machine", "severity", "alert_type", "_time", "rule", "value", order)
    return series.collapse_points(rows, ["_measurement", "machine", "severity", "alert_type", "_time"], ["written"])


# --- anomaly rules ----------------------------------------------------------------------------


def _rule(spark, sf_dir, found: str) -> DataFrame:
    rows = sensor(spark, sf_dir).selectExpr("event_id", "machine", f"{found} as a")
    return rows.where("a is not null").selectExpr(
        "event_id", "machine", "a.rule", "a.severity", f"{rules.message('a')} as message", "a.value")


@query
def anomaly_temperature(spark, sf_dir):
    return _rule(spark, sf_dir, rules.temperature_rule())


@query
def anomaly_vibration(spark, sf_dir):
    return _rule(spark, sf_dir, rules.vibration_rule())


@query
def anomaly_power(spark, sf_dir):
    return _rule(spark, sf_dir, rules.power_rule())


@query
def anomaly_rpm(spark, sf_dir):
    return _rule(spark, sf_dir, rules.rpm_rule())


@query
def anomaly_array(spark, sf_dir):
    return readings(spark, sf_dir).select(
        "event_id", F.size("anomalies").cast("bigint").alias("n"), F.array_join("anomalies.rule", ",").alias("rules"),
    )


@query
def anomaly_custom_thresholds(spark, sf_dir):
    limits = rules.Thresholds.from_settings(temperature=(60.0, 75.0), vibration=(1.5, 2.0), power_warning=3.0)
    rows = alert_ops.with_anomalies(sensor(spark, sf_dir), limits)
    return alert_ops.alerts(rows).groupBy("rule", "severity").agg(F.count(F.lit(1)).alias("alerts"))


@query
def anomaly_stats(spark, sf_dir):
    other = events(spark, sf_dir).select("event_id").unionByName(pieces(spark, sf_dir).select("event_id"))
    return rounded(alert_ops.anomaly_stats(readings(spark, sf_dir), other), "anomaly_rate")


@query
def alerts_routed(spark, sf_dir):
    return alert_rows(spark, sf_dir)


@query
def alert_counts(spark, sf_dir):
    """Alerts per measurement, machine and severity."""
    return alert_rows(spark, sf_dir).groupBy("_measurement", "machine", "severity").agg(
        F.count(F.lit(1)).alias("alerts"), F.max("value").alias("max_value"))


# --- series operators -------------------------------------------------------------------------


@query
def range_scan(spark, sf_dir):
    """A range with its stop included in neither the next range nor left out: whole days of January."""
    rows = sensor(spark, sf_dir)
    start, stop = tables.bounds(rows, AS_OF, LOOKBACK, "1 day")
    return tables.time_range(rows, start, stop).select("event_id", "_time", "machine", "temperature")


@query
def filter_eq(spark, sf_dir):
    rows = tables.recent(long_sensor(spark, sf_dir), AS_OF, LOOKBACK)
    return rows.where((F.col("_field") == "temperature") & (F.col("machine") == "Milling1"))


@query
def filter_regex(spark, sf_dir):
    return long_sensor(spark, sf_dir).where(F.col("_field").rlike("temperature|power"))


@query
def sum_by(spark, sf_dir):
    return rounded(series.sum_by(long_sensor(spark, sf_dir), LONG_SERIES), "_value")


@query
def count_by(spark, sf_dir):
    return series.count_by(long_sensor(spark, sf_dir), LONG_SERIES, "_value")


@query
def mean_by(spark, sf_dir):
    return rounded(series.mean_by(long_sensor(spark, sf_dir), LONG_SERIES), "_value")


@query
def last_by(spark, sf_dir):
    return series.last_by(long_sensor(spark, sf_dir), LONG_SERIES)


@query
def first_by(spark, sf_dir):
    return series.first_by(long_sensor(spark, sf_dir), LONG_SERIES)


@query
def limit_per_series(spark, sf_dir):
    rows = tables.recent(long_sensor(spark, sf_dir), AS_OF, LOOKBACK).where(F.col("machine") == "Milling1")
    return series.limit_per_series(rows, LONG_SERIES, 100)


@query
def limit_per_series_2000(spark, sf_dir):
    """More rows per series than Spark ranks before a shuffle by itself."""
    rows = sensor(spark, sf_dir).select("event_id", "_time", "machine", "temperature")
    return series.limit_per_series(rows, ["machine"], 2000, newest=True)


@query
def keep_columns(spark, sf_dir):
    """Without the other columns series merge: counts per machine only."""
    return series.count_by(long_sensor(spark, sf_dir).select("machine", "_value"), ["machine"], "_value")


@query
def pivot_fields(spark, sf_dir):
    return series.pivot_fields(long_sensor(spark, sf_dir), ["_time", "machine"], LONG_FIELDS)


def _long_windows(spark, sf_dir, every: str, fn) -> DataFrame:
    rows = long_sensor(spark, sf_dir)
    _, stop = tables.bounds(rows, AS_OF, LOOKBACK)
    return rounded(series.window_value(
        tables.recent(rows, AS_OF, LOOKBACK), LONG_SERIES, every, fn, stop), "_value")


@query
def window_mean_30s(spark, sf_dir):
    return rounded(reports.temperature_panel(sensor(spark, sf_dir), AS_OF, LOOKBACK), "temperature")


@query
def window_mean_1h(spark, sf_dir):
    rows = sensor(spark, sf_dir)
    return rounded(reports.field_window_mean(rows, "temperature", AS_OF, LOOKBACK, "1 hour"), "temperature")


@query
def window_mean_long_1d(spark, sf_dir):
    return _long_windows(spark, sf_dir, "1 day", F.avg)


@query
def window_sum_1d(spark, sf_dir):
    return rounded(reports.daily_cycle_time_by_machine(events(spark, sf_dir), AS_OF, LOOKBACK), "cycle_time")


@query
def window_count_1h(spark, sf_dir):
    return reports.production_rate(events(spark, sf_dir), AS_OF, LOOKBACK)


@query
def elapsed_seconds(spark, sf_dir):
    return neighbours.elapsed(
        long_sensor(spark, sf_dir).select("event_id", "_time", "machine", "_field"), ["machine", "_field"])


@query
def moving_average(spark, sf_dir):
    rows = long_sensor(spark, sf_dir).select("event_id", "_time", *LONG_SERIES, "_value")
    return rounded(neighbours.moving_average(rows, LONG_SERIES, 10), "_value")


@query
def cycle_time_pairs(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "_time", "machine", "event_type")
    return rounded(neighbours.start_end_pairs(rows, ["machine"], "processing_start", "processing_end"), "seconds")


@query
def alerts_limits_over_time(spark, sf_dir):
    """Alerts by limits that changed: two machines have their own, one of them others from the middle of the month on."""
    changes = [
        ("Milling1", "2024-01-01", 30.0, 40.0, 0.5), ("Milling1", "2024-01-16", 35.0, 42.0, None),
        ("Saw1", "2024-01-10", None, 85.0, None), ("Nobody", "2024-01-01", 1.0, 2.0, 0.1),
    ]
    names = "machine string, valid_from string, temperature_warning double, temperature_critical double, vibration_warning double"
    limits = spark.createDataFrame(changes, names).withColumn("valid_from", F.col("valid_from").cast("timestamp_ntz"))
    found = alert_ops.with_anomalies_over_time(sensor(spark, sf_dir), limits)
    return alert_ops.alerts(found, ["event_id"]).select("event_id", "machine", "rule", "severity", "value")


@query
def nearest_starts(spark, sf_dir):
    """Every end of processing with the latest start of its piece on its machine, other pieces' events in between or not."""
    rows = events(spark, sf_dir).select("event_id", "_time", "machine", "piece_id", "event_type")
    return rounded(neighbours.nearest_starts(rows, ["machine", "piece_id"], *PROCESSING, within="10 days"), "seconds")


# --- named reports ----------------------------------------------------------------------------


@query
def machine_temperature(spark, sf_dir):
    return reports.machine_temperature(sensor(spark, sf_dir), AS_OF, LOOKBACK)


@query
def temperature_all(spark, sf_dir):
    return reports.field_values(sensor(spark, sf_dir), "temperature", AS_OF, LOOKBACK)


@query
def machine_all_sensors(spark, sf_dir):
    return reports.machine_all_sensors(sensor(spark, sf_dir), AS_OF, LOOKBACK)


@query
def machine_all_fields(spark, sf_dir):
    """All decoded fields of one machine."""
    rows = reports.machine_all_sensors(decoded_readings(spark, sf_dir), AS_OF, LOOKBACK)
    extra = [F.try_element_at("extra_fields", F.lit(f)).alias(f) for f in ("coolant_level", "door_open")]
    return plain(rows.select("_time", "machine", "machine_type", "location", *WIDE_FIELDS, *extra))


@query
def power_by_machine(spark, sf_dir):
    return reports.power_by_machine(sensor(spark, sf_dir), AS_OF, LOOKBACK)


@query
def processing_time_total(spark, sf_dir):
    return rounded(reports.processing_time_total(events(spark, sf_dir), AS_OF, LOOKBACK), "cycle_time")


@query
def machine_availability_counts(spark, sf_dir):
    return reports.machine_availability_counts(events(spark, sf_dir), AS_OF, LOOKBACK)


@query
def cycle_time_mean(spark, sf_dir):
    return rounded(reports.cycle_time_mean(events(spark, sf_dir), AS_OF, LOOKBACK), "cycle_time")


@query
def high_temperature(spark, sf_dir):
    return reports.high_temperature(sensor(spark, sf_dir), AS_OF, LOOKBACK)


@query
def high_vibration(spark, sf_dir):
    return reports.high_vibration(sensor(spark, sf_dir), AS_OF, LOOKBACK)


@query
def high_power(spark, sf_dir):
    return reports.high_power(sensor(spark, sf_dir), AS_OF, LOOKBACK)


@query
def tool_wear_last(spark, sf_dir):
    return reports.tool_wear_last(events(spark, sf_dir), AS_OF, LOOKBACK)


@query
def piece_traceability(spark, sf_dir):
    return reports.piece_traceability(pieces(spark, sf_dir), AS_OF, LOOKBACK)


@query
def pieces_in_production(spark, sf_dir):
    return reports.pieces_in_production(events(spark, sf_dir), AS_OF, LOOKBACK)


@query
def transport_time_mean(spark, sf_dir):
    return rounded(reports.transport_time_mean(pieces(spark, sf_dir), AS_OF, LOOKBACK), "mean_duration")


@query
def production_by_material(spark, sf_dir):
    return reports.production_by_material(pieces(spark, sf_dir), AS_OF, LOOKBACK)


@query
def daily_production(spark, sf_dir):
    return reports.daily_production(pieces(spark, sf_dir), AS_OF, LOOKBACK)


@query
def processor_performance(spark, sf_dir):
    return reports.processor_performance(system(spark, sf_dir), AS_OF, LOOKBACK)


@query
def system_health_last(spark, sf_dir):
    return reports.system_health_last(system(spark, sf_dir), AS_OF, LOOKBACK)


@query
def errors_by_component(spark, sf_dir):
    return reports.errors_by_component(system(spark, sf_dir), AS_OF, LOOKBACK)


@query
def machine_efficiency(spark, sf_dir):
    return rounded(
        reports.machine_efficiency(events(spark, sf_dir), AS_OF, LOOKBACK), "tool_wear", "cycle_time")


@query
def temperature_mean_by_machine(spark, sf_dir):
    return rounded(
        reports.temperature_mean_by_machine(sensor(spark, sf_dir), AS_OF, LOOKBACK), "mean_temperature")


@query
def temperature_trend(spark, sf_dir):
    return rounded(reports.temperature_trend(sensor(spark, sf_dir), AS_OF, LOOKBACK), "temperature")


@query
def temperature_power_pivot(spark, sf_dir):
    return reports.temperature_power(sensor(spark, sf_dir), AS_OF, LOOKBACK)


@query
def panel_power(spark, sf_dir):
    means = reports.field_window_mean(sensor(spark, sf_dir), "power", AS_OF, LOOKBACK)
    return rounded(means, "power")


@query
def pieces_processed(spark, sf_dir):
    return reports.pieces_processed(events(spark, sf_dir), AS_OF, LOOKBACK)


@query
def critical_alerts(spark, sf_dir):
    return reports.critical_alerts(alert_rows(spark, sf_dir), AS_OF, LOOKBACK)


@query
def recent_alerts(spark, sf_dir):
    return reports.recent_alerts(alert_rows(spark, sf_dir), AS_OF, LOOKBACK)


@query
def system_performance(spark, sf_dir):
    rows = reports.system_performance(system(spark, sf_dir), AS_OF, LOOKBACK)
    return rounded(rows, "cpu", "memory_used_percent")


@query
def distinct_machines(spark, sf_dir):
    return reports.distinct_machines(sensor(spark, sf_dir), AS_OF, LOOKBACK)


@query
def threshold_band(spark, sf_dir):
    """Readings per machine and colour band, for temperature and power."""
    rows = series.to_long(sensor(spark, sf_dir), ["machine"], ["temperature", "power"])
    band = (
        f"if(_field = 'temperature', {panels.threshold_band('_value', 'temperature')},"
        f" {panels.threshold_band('_value', 'power')})"
    )
    return rows.groupBy("machine", "_field", F.expr(band).alias("band")).agg(F.count(F.lit(1)).alias("readings"))


@query
def legend_summary(spark, sf_dir):
    rows = series.to_long(sensor(spark, sf_dir), ["event_id", "_time", "machine"], ["temperature", "power"])
    return rounded(series.legend(rows, ["machine", "_field"], "_value"), "mean_value")


@query
def severity_label(spark, sf_dir):
    rows = alert_rows(spark, sf_dir)
    return rows.groupBy("severity", F.expr(panels.severity_label()).alias("label")).agg(
        F.count(F.lit(1)).alias("alerts"))


@query
def filter_machines(spark, sf_dir):
    rows = series.selected(sensor(spark, sf_dir), "machine", ["Milling2", "Saw1"])
    return rows.select("event_id", "_time", "machine", "temperature", "power")


@query
def availability_pct(spark, sf_dir):
    return rounded(
        reports.availability(events(spark, sf_dir), AS_OF, LOOKBACK, by=["machine"]), "availability_pct")


@query
def availability_by_tool(spark, sf_dir):
    """Pieces and tools told apart, in a range that processing reaches over on both sides."""
    return rounded(reports.availability(events(spark, sf_dir), "2024-01-20 00:00:00", "10 days"), "availability_pct")


@query
def temperature_power_corr(spark, sf_dir):
    """Correlation of the hourly means of two fields that are measured apart, per machine."""
    rows = long_sensor(spark, sf_dir)
    return rounded(reports.field_corr(rows, "temperature", "power", AS_OF, LOOKBACK), "correlation")


@query
def machine_status(spark, sf_dir):
    return reports.machine_status(events(spark, sf_dir), AS_OF, LOOKBACK)


@query
def tool_wear_trend(spark, sf_dir):
    return rounded(reports.tool_wear_trend(events(spark, sf_dir), AS_OF, LOOKBACK), "wear_per_hour")


# --- data quality -----------------------------------------------------------------------------


def _counts(spark, sf_dir) -> DataFrame:
    return quality.measurement_counts({
        "sensor_data": (sensor(spark, sf_dir), WIDE_FIELDS),
        "machine_events": (events(spark, sf_dir), ["tool_wear", "cycle_time"]),
        "piece_tracking": (pieces(spark, sf_dir), ["duration", "priority"]),
        "system_tracking": (system(spark, sf_dir), SYSTEM_FIELDS),
    })


@query
def measurement_counts_decoded(spark, sf_dir):
    """Values of every field that decoded messages bring, text fields and undeclared ones included."""
    rows = checked(spark, sf_dir)
    return quality.measurement_counts({
        "sensor_data": (normalise.sensor_readings(rows), [*SENSOR_FIELDS, "extra_fields"]),
        "machine_events": (normalise.machine_events(rows), EVENT_FIELDS),
        "piece_tracking": (normalise.piece_movements(rows), PIECE_FIELDS),
    })


@query
def measurement_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


@query
def volume_report(spark, sf_dir):
    return quality.volume_report(_counts(spark, sf_dir))


@query
def completeness_by_machine(spark, sf_dir):
    rows = tables.recent(sensor(spark, sf_dir), AS_OF, LOOKBACK)
    return quality.completeness(rows, ["machine"], "temperature")


@query
def gap_detection(spark, sf_dir):
    rows = sensor(spark, sf_dir).select("event_id", "_time", "machine")
    return quality.gaps(rows, ["machine"])


@query
def gap_detection_field(spark, sf_dir):
    """Gaps of one field: readings without it do not close a gap."""
    rows = views.view(views.events(spark, sf_dir), [
        "event_id", "_time", "machine", "case when event_type = 'view' then value end as temperature"])
    return quality.gaps(rows, ["machine"], field="temperature").drop("temperature")


@query
def gap_summary(spark, sf_dir):
    rows = sensor(spark, sf_dir).select("event_id", "_time", "machine")
    return quality.gap_summary(quality.gaps(rows, ["machine"]), ["machine"])


@query
def tag_combinations(spark, sf_dir):
    return quality.tag_combinations(sensor(spark, sf_dir), ["machine", "machine_type"])


@query
def missing_tables(spark, sf_dir):
    """Expected measurements and alert tables without any row."""
    raised = alert_rows(spark, sf_dir)
    alert_tables = ["temperature_alerts", "vibration_alerts", "system_alerts"]
    found = quality.present_names({
        "sensor_data": sensor(spark, sf_dir), "machine_events": events(spark, sf_dir),
        "piece_tracking": pieces(spark, sf_dir), "system_tracking": system(spark, sf_dir),
        **{name: raised.where(F.col("_measurement") == name) for name in alert_tables},
    })
    expected = [*EXPECTED_MEASUREMENTS, "system_metrics", *alert_tables]
    return quality.missing_names(spark, expected, found, "_measurement")


@query
def missing_stores(spark, sf_dir):
    """Expected stores that storage does not hold, after two of them have been written."""
    root = new_folder(spark, "stores")
    for name, rows in {"industrial_data": events(spark, sf_dir), "alerts": alert_rows(spark, sf_dir)}.items():
        tables.append_batch(rows, root, name, 0)
    return quality.missing_names(spark, EXPECTED_STORES, tables.stored_names(spark, root, EXPECTED_STORES), "name")


@query
def schema_violations(spark, sf_dir):
    parts = [
        quality.schema_violations(rows, name)
        for name, rows in {
            "sensor_data": sensor(spark, sf_dir), "machine_events": events(spark, sf_dir),
            "piece_tracking": pieces(spark, sf_dir), "system_tracking": system(spark, sf_dir),
        }.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- rollups and statistics -------------------------------------------------------------------


def _stored(spark: SparkSession, rollup: DataFrame, name: str) -> DataFrame:
    """Merges a rollup of the whole range into history and reads it back."""
    root = new_folder(spark, "history")
    tables.merge_windows(rollup, root, name, *tables.bounds(rollup, AS_OF, LOOKBACK))
    return tables.read_windows(spark, root, name).select(*rollup.columns)


@query
def rollup_hourly(spark, sf_dir):
    rows = rollups.hourly_means(sensor(spark, sf_dir), AS_OF, LOOKBACK, "0 hours", fields=WIDE_FIELDS)
    return rounded(_stored(spark, rows, "sensor_data_1h"), *WIDE_FIELDS)


@query
def rollup_hourly_all_fields(spark, sf_dir):
    """Hourly means of every decoded field, a row per field."""
    rows = rollups.hourly_means_long(decoded_readings(spark, sf_dir), AS_OF, LOOKBACK, "0 hours")
    return rounded(plain(rows), "_value")


@query
def rollup_rerun(spark, sf_dir):
    """A rollup of a range that is run again when rows are gone: no window of the first run is left over."""
    root, rows = new_folder(spark, "history"), sensor(spark, sf_dir)
    fewer = rows.where((F.col("machine") != "Saw1") & (F.col("_time") < F.lit("2024-01-20").cast("timestamp_ntz")))
    for part in (rows, fewer):
        means = rollups.hourly_means(part, AS_OF, LOOKBACK, "0 hours", fields=["temperature"])
        tables.merge_windows(means, root, "sensor_data_1h", *tables.bounds(rows, AS_OF, LOOKBACK))
    return rounded(tables.read_windows(spark, root, "sensor_data_1h").drop("window_date"), "temperature")


@query
def rollup_daily(spark, sf_dir):
    rows = rollups.daily_cycle_time(events(spark, sf_dir), AS_OF, LOOKBACK, "0 days")
    return rounded(_stored(spark, rows, "machine_events_1d"), "cycle_time")


def stored_in_batches(spark: SparkSession, rows: DataFrame, root: str, name: str, batches: int = 20) -> None:
    """Files rows in a table as a stream does that gets them in so many portions."""
    rows.repartitionByRange(batches, "event_id").write.parquet(f"{root}/in")
    portions = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    writer = portions.writeStream.foreachBatch(lambda batch, number: tables.append_batch(batch, root, name, number))
    ingest.start(writer, f"{root}/checkpoint", every=None).awaitTermination()


@query
def compacted_batches(spark, sf_dir):
    """Readings that came in 20 micro-batches, after compaction: figures, and folders, of each day."""
    root = new_folder(spark, "compacted")
    stored_in_batches(spark, views.zoned(sensor(spark, sf_dir)), root, "sensor_data")
    tables.compact(spark, root, "sensor_data")
    folders = [(day, n) for day, n in tables.folders_of(spark, root, "sensor_data").items()]
    days = spark.createDataFrame(folders, "event_date string, folders int").withColumn("event_date", F.col("event_date").cast("date"))
    rows = tables.read_table(spark, root, "sensor_data").groupBy("event_date", "machine").agg(
        F.count(F.lit(1)).alias("readings"), F.sum("temperature").alias("temperature"), F.max("_time").alias("last_time"))
    return rounded(plain(rows.join(F.broadcast(days), "event_date")), "temperature")


@query
def machine_efficiency_1h(spark, sf_dir):
    rows = rollups.hourly_efficiency(events(spark, sf_dir), AS_OF, LOOKBACK, "0 hours")
    return rounded(rows, "cycle_time")


@query
def retention_filter(spark, sf_dir):
    return tables.retained(sensor(spark, sf_dir), "industrial_data", AS_OF).select("event_id", "_time", "machine")


@query
def message_stats(spark, sf_dir):
    return rounded(plain(rollups.message_stats(checked(spark, sf_dir))), "processing_rate")


@query
def write_stats(spark, sf_dir):
    return rollups.write_stats({
        "sensor_data": sensor(spark, sf_dir), "machine_events": events(spark, sf_dir),
        "piece_tracking": pieces(spark, sf_dir), "system_tracking": system(spark, sf_dir),
        "alerts": alert_rows(spark, sf_dir),
    })


@query
def system_tracking_fill(spark, sf_dir):
    samples = system(spark, sf_dir).selectExpr(
        "_time", "if(errors % 10 = 0, null, cpu) as cpu", "free_memory * 1073741824 as memory_available",
        "if(errors % 7 = 0, null, ram * 1073741824) as memory_total", "if(errors % 5 = 0, null, errors) as errors",
        "memory_used_percent", "uptime_seconds",
    )
    return rounded(normalise.system_samples(samples), "uptime_seconds")


# --- streams ----------------------------------------------------------------------------------


@query
def stream_ingest_route(spark, sf_dir):
    """What continuous ingestion has stored: one line per row of every table."""
    root = new_folder(spark, "ingest")
    source = views.messages(views.event_stream(spark, sf_dir, FILES_PER_BATCH))
    ingest.ingest(source, root, f"{root}/checkpoint", every=None).awaitTermination()
    lines = {
        "sensor_data": ("_time", F.col("machine"), F.size("anomalies").cast("string")),
        "machine_events": ("_time", F.col("machine"), F.col("event_type")),
        "piece_tracking": ("_time", F.col("piece_id"), F.col("to_station")),
        "alerts": ("_time", F.col("machine"), F.col("rule")),
        "rejects": ("arrived_at", F.col("topic"), F.col("reason")),
    }
    parts = [
        tables.read_table(spark, root, name).select(
            F.lit(name).alias("_table"), F.col(time).alias("_time"), who.alias("name"), what.alias("detail"))
        for name, (time, who, what) in lines.items()
    ]
    return plain(reduce(DataFrame.unionByName, parts))


@query
def stream_ingest_statistics(spark, sf_dir):
    """Running counters, read back from what continuous ingestion has stored for its batches."""
    root = new_folder(spark, "ingest")
    source = views.messages(views.event_stream(spark, sf_dir, FILES_PER_BATCH))
    ingest.ingest(source, root, f"{root}/checkpoint", every=None).awaitTermination()
    totals = rollups.pipeline_totals(tables.read_table(spark, root, "pipeline_stats"))
    return rounded(plain(totals), "processing_rate")


@query
def alerts_stream(spark, sf_dir):
    root = new_folder(spark, "alerts")
    rows = alert_ops.with_anomalies(views.view(views.event_stream(spark, sf_dir, FILES_PER_BATCH), views.SENSOR_WIDE))
    stream = ingest.alerts_stream(rows, f"{root}/alerts", f"{root}/checkpoint", every=None, extra=["event_id"])
    stream.awaitTermination()
    return spark.read.parquet(f"{root}/alerts")


def _zoned(columns: list[str]):
    stream = lambda spark, sf_dir: views.zoned(views.view(views.event_stream(spark, sf_dir), columns))
    table = lambda spark, sf_dir: views.zoned(views.view(views.events(spark, sf_dir), columns))
    return stream, table


@query
def stream_window_mean(spark, sf_dir):
    root = new_folder(spark, "windows")
    stream, _ = _zoned(views.SENSOR_LONG)
    mean = [F.avg("_value").alias("_value"), F.count("_value").alias("readings")]
    windows.window_stream(
        stream(spark, sf_dir), LONG_SERIES, "1 hour", mean, f"{root}/means", f"{root}/checkpoint", every=None,
    ).awaitTermination()
    return rounded(plain(spark.read.parquet(f"{root}/means")), "_value")


@query
def stream_distinct_points(spark, sf_dir):
    """Readings that were delivered twice, stored once."""
    root = new_folder(spark, "distinct")
    stream, _ = _zoned(views.SENSOR_WIDE)
    twice = stream(spark, sf_dir).selectExpr("event_id", "_time", "machine", "temperature", "explode(array(1, 2)) as copy")
    once = windows.distinct_points(twice.drop("copy"), ["event_id", "machine", "_time"])
    writer = once.writeStream.format("parquet").option("path", f"{root}/points")
    ingest.start(writer, f"{root}/checkpoint", every=None).awaitTermination()
    return plain(spark.read.parquet(f"{root}/points"))


def _followed(spark, sf_dir, columns: list[str], keep: list[str], start, operator) -> DataFrame:
    """Result of a closed-range stream over the benchmark events, finished at the end of its input."""
    root = new_folder(spark, "ranges")
    stream, table = _zoned(columns)
    rows = lambda: table(spark, sf_dir).select(*keep)
    start(stream(spark, sf_dir).select(*keep), rows, root, f"{root}/checkpoint").awaitTermination()
    closed_ranges.finish(rows, operator, root, f"{root}/checkpoint")
    return plain(closed_ranges.results(root, table(spark, sf_dir)))


@query
def stream_gaps(spark, sf_dir):
    return _followed(
        spark, sf_dir, views.SENSOR_WIDE, ["event_id", "_time", "machine"],
        lambda s, t, root, cp: closed_ranges.gap_stream(s, t, ["machine"], root, cp, every=None),
        closed_ranges.gaps_over(["machine"]),
    )


@query
def stream_moving_average(spark, sf_dir):
    rows = _followed(
        spark, sf_dir, views.SENSOR_LONG, ["event_id", "_time", *LONG_SERIES, "_value"],
        lambda s, t, root, cp: closed_ranges.moving_average_stream(s, t, LONG_SERIES, 10, root, cp, every=None),
        closed_ranges.means_over(LONG_SERIES, 10),
    )
    return rounded(rows, "_value")


@query
def stream_cycle_time(spark, sf_dir):
    kinds = ("processing_start", "processing_end")
    rows = _followed(
        spark, sf_dir, views.MACHINE_EVENTS, ["event_id", "_time", "machine", "event_type"],
        lambda s, t, root, cp: closed_ranges.pair_stream(s, t, ["machine"], *kinds, root, cp, every=None),
        closed_ranges.pairs_over(["machine"], *kinds),
    )
    return rounded(rows, "seconds")


def _portions(spark: SparkSession, rows: DataFrame, root: str, n: int = 4) -> DataFrame:
    """A stream that gets rows in n portions, by their number and not by their time."""
    rows.repartitionByRange(n, "event_id").sortWithinPartitions("event_id").write.parquet(f"{root}/in")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")


@query
def stream_live_windows(spark, sf_dir):
    """Hourly means kept up by a stream whose rows come in no order of time; windows that late rows belong to are repaired."""
    root = new_folder(spark, "live")
    rows = views.zoned(long_sensor(spark, sf_dir))
    stream, mean = _portions(spark, rows, root), [F.avg("_value").alias("_value"), F.count("_value").alias("readings")]
    live.live_windows(stream, LONG_SERIES, "1 hour", mean, root, "means", f"{root}/a", every=None).awaitTermination()
    live.note_late(stream, "1 hour", root, "late", f"{root}/b", every=None).awaitTermination()
    live.repair_windows(rows, LONG_SERIES, "1 hour", mean, root, "means", "late")
    return rounded(plain(tables.read_windows(spark, root, "means").drop("window_date")), "_value")


@query
def stream_last_rows(spark, sf_dir):
    """The last reading of every machine, kept up by a stream."""
    root = new_folder(spark, "last")
    rows = views.zoned(sensor(spark, sf_dir)).select("event_id", "_time", "machine", "temperature")
    live.follow_last(_portions(spark, rows, root), ["machine"], root, "last", f"{root}/checkpoint", every=None).awaitTermination()
    return plain(live.last_rows(spark, root, "last"))


@query
def stream_merged_points(spark, sf_dir):
    """Points whose fields come in different micro-batches: one row each, with the field values that came last."""
    root = new_folder(spark, "points")
    key = ["machine", "_time"]
    rows = views.zoned(sensor(spark, sf_dir)).withColumn("_time", F.date_trunc("minute", "_time")).selectExpr(
        "event_id", *key, "if(event_id % 2 = 0, temperature, null) as temperature", "if(event_id % 3 = 0, power, null) as power")
    points = live.merged_points(_portions(spark, rows, root), key, ["event_id"], delay="60 days")
    day = F.to_date("_time").alias("event_date")
    keep = lambda batch, _: tables.merge_rows(batch.select("*", day), root, "points", key, "event_date")
    writer = points.writeStream.foreachBatch(keep).outputMode("update")
    ingest.start(writer, f"{root}/checkpoint", every=None).awaitTermination()
    return plain(tables.read_parts(spark, root, "points", "event_date").drop("event_date"))


@query
def stream_nearest_starts(spark, sf_dir):
    """`nearest_starts` on a stream; an end and a later start far in the future end the input."""
    root = new_folder(spark, "starts")
    rows = views.zoned(events(spark, sf_dir)).select("event_id", "_time", "machine", "piece_id", "event_type")
    last = [(2**62, "2100-01-01", None, None, PROCESSING[1]), (2**62 + 1, "2100-01-02", None, None, PROCESSING[0])]
    marks = spark.createDataFrame(last, "event_id long, _time string, machine string, piece_id string, event_type string")
    rows.unionByName(views.zoned(marks)).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
    pairs = live.nearest_start_stream(stream, ["machine", "piece_id"], *PROCESSING, within="10 days", unique="event_id")
    ingest.start(pairs.writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/checkpoint", every=None).awaitTermination()
    return rounded(plain(spark.read.parquet(f"{root}/out")), "seconds")


def _ended(spark: SparkSession, rows: DataFrame, root: str, **series_of_the_mark: str) -> DataFrame:
    """A stream over rows in four portions in the order of time, and then one row far in the future, which ends the input."""
    mark = rows.limit(1).select(*[
        (F.lit("2100-01-01") if c == "_time" else F.lit(series_of_the_mark.get(c))).cast(rows.schema[c].dataType).alias(c) for c in rows.columns])
    micros = F.unix_micros("_time")
    low, high = rows.agg(F.min(micros), F.max(micros)).first()
    quarter = F.least(F.floor((micros - low) * 4 / max(1, high - low)), F.lit(3))
    for part in (*[rows.where(quarter == k) for k in range(4)], mark):  # files are taken by their age
        part.repartition(1).write.mode("append").parquet(f"{root}/in")  # one file each, made by many tasks
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")


def _arrived(spark: SparkSession, found: DataFrame, root: str) -> DataFrame:
    with in_order.rocksdb(spark):
        query = ingest.start(found.writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/checkpoint", every=None)
    query.awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query
def stream_gaps_on_arrival(spark, sf_dir):
    """Gaps as soon as the watermark has passed them, from state and timers of each machine."""
    root = new_folder(spark, "arrival")
    rows = views.zoned(sensor(spark, sf_dir)).select("event_id", "_time", "machine")
    return plain(_arrived(spark, in_order.gaps_on_arrival(_ended(spark, rows, root, machine="end"), ["machine"]), root))


@query
def stream_moving_average_on_arrival(spark, sf_dir):
    root = new_folder(spark, "arrival")
    rows = views.zoned(long_sensor(spark, sf_dir)).select("event_id", "_time", *LONG_SERIES, "_value")
    found = in_order.means_on_arrival(_ended(spark, rows, root, machine="end", _value="0"), LONG_SERIES, 10)
    return rounded(plain(_arrived(spark, found, root)), "_value")


@query
def stream_system_samples(spark, sf_dir):
    """Figures of hosts, stored by a stream."""
    root = new_folder(spark, "system")
    rows = views.zoned(views.view(views.event_stream(spark, sf_dir, FILES_PER_BATCH), views.SYSTEM_TRACKING)).selectExpr(
        "_time", "cpu", "cast(ram * 1073741824 as bigint) as memory_total", "cast(free_memory * 1073741824 as bigint) as memory_available",
        "errors", "memory_used_percent", "uptime_seconds")
    ingest.store_stream(normalise.system_samples(rows), root, "system_tracking", f"{root}/checkpoint", every=None).awaitTermination()
    found = tables.read_table(spark, root, "system_tracking").groupBy("component", "metric_type", "severity").agg(
        F.count(F.lit(1)).alias("samples"), F.sum("errors").alias("errors"), F.sum("ram").alias("ram"), F.max("_time").alias("last_time"))
    return plain(found)


@query
def stream_write_errors(spark, sf_dir):
    """What two streams did, as filed by a watch: one stores all readings, the other's sink fails."""
    root = new_folder(spark, "watched")
    rows = views.zoned(views.view(views.event_stream(spark, sf_dir, FILES_PER_BATCH), views.SENSOR_WIDE))

    def fails(batch, number):
        raise OSError("the disk is full")

    observer = watch.Watch(spark, root).attach()
    good = ingest.store_stream(rows, root, "sensor_data", f"{root}/a", every=None, name="stores")
    bad = ingest.start(rows.writeStream.foreachBatch(fails).queryName("fails"), f"{root}/b", every=None)
    for stream in (good, bad):
        try:
            stream.awaitTermination()
        except StreamingQueryException:
            pass
        observer.wait_for(stream.runId)
    observer.detach()
    report = watch.write_report(tables.read_table(spark, root, "stream_log"))
    return report.select("query", "batches", "rows_written", "write_errors", F.col("last_write_time").isNotNull().alias("has_written"),
                         F.col("last_error").contains("the disk is full").alias("says_why"))
