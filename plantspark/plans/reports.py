"""The plant's reports. Each takes a measurement table, an explicit `as_of` and a lookback.

`sensor` tables are wide (one column per field); the column asked for is chosen here, so the scan
reads no other field. Functions whose table must be long say so.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from plantspark.functions.panels import severity_label, threshold_band
from plantspark.functions.plant import piece_material
from plantspark.operators import series
from plantspark.operators.neighbours import moving_average, start_end_pairs
from plantspark.schemas import SENSOR_FIELDS, SENSOR_TAGS
from plantspark.sources.tables import bounds, recent, time_range

Moment = datetime | str

SERIES = ["machine", "machine_type", "location"]


def _ids(df: DataFrame) -> list[str]:
    return [c for c in ("event_id",) if c in df.columns]


def _tags(df: DataFrame, tags: Sequence[str] = SENSOR_TAGS) -> list[str]:
    return [t for t in tags if t in df.columns]


def field_values(sensor: DataFrame, field: str, as_of: Moment, lookback: str = "1 hour",
                 machine: str | None = None) -> DataFrame:
    """Present readings of one field, of all machines or of one."""
    rows = recent(sensor, as_of, lookback).where(F.col(field).isNotNull())
    if machine is not None:
        rows = rows.where(F.col("machine") == machine)
    return rows.select(*_ids(sensor), "_time", *_tags(sensor), field)


def machine_temperature(sensor: DataFrame, as_of: Moment, lookback: str = "1 hour",
                        machine: str = "Milling1") -> DataFrame:
    return field_values(sensor, "temperature", as_of, lookback, machine)


def machine_all_sensors(sensor: DataFrame, as_of: Moment, lookback: str = "30 minutes",
                        machine: str = "Milling1") -> DataFrame:
    """All fields of one machine, a row per stamp; undeclared ones in the map `extra_fields`, if the table has it."""
    fields = [f for f in (*SENSOR_FIELDS, "extra_fields") if f in sensor.columns]
    rows = recent(sensor, as_of, lookback).where(F.col("machine") == machine)
    return rows.select(*_ids(sensor), "_time", *_tags(sensor), *fields)


def power_by_machine(sensor: DataFrame, as_of: Moment, lookback: str = "1 hour") -> DataFrame:
    rows = field_values(sensor, "power", as_of, lookback)
    return rows.orderBy("machine", *series.order_columns(rows))


def above(sensor: DataFrame, field: str, limit: float, as_of: Moment, lookback: str = "1 hour") -> DataFrame:
    """Readings of a field over a limit."""
    return field_values(sensor, field, as_of, lookback).where(F.col(field) > limit)


def high_temperature(sensor: DataFrame, as_of: Moment, lookback: str = "1 hour") -> DataFrame:
    return above(sensor, "temperature", 80.0, as_of, lookback)


def high_vibration(sensor: DataFrame, as_of: Moment, lookback: str = "1 hour") -> DataFrame:
    return above(sensor, "vibration_level", 2.5, as_of, lookback)


def high_power(sensor: DataFrame, as_of: Moment, lookback: str = "1 hour") -> DataFrame:
    return above(sensor, "power", 5.0, as_of, lookback)


def temperature_mean_by_machine(sensor: DataFrame, as_of: Moment, lookback: str = "1 hour") -> DataFrame:
    return series.mean_by(recent(sensor, as_of, lookback), ["machine"], "temperature", "mean_temperature")


def _finished(events: DataFrame, as_of: Moment, lookback: str) -> DataFrame:
    return recent(events, as_of, lookback).where(F.col("event_type") == "processing_end")


def processing_time_total(events: DataFrame, as_of: Moment, lookback: str = "24 hours") -> DataFrame:
    return series.sum_by(_finished(events, as_of, lookback), ["machine"], "cycle_time", "cycle_time")


def cycle_time_mean(events: DataFrame, as_of: Moment, lookback: str = "24 hours") -> DataFrame:
    return series.mean_by(_finished(events, as_of, lookback), ["machine"], "cycle_time", "cycle_time")


def machine_availability_counts(events: DataFrame, as_of: Moment, lookback: str = "24 hours") -> DataFrame:
    """Processing events per machine and kind."""
    rows = recent(events, as_of, lookback).where(F.col("event_type").rlike("processing_"))
    return series.count_by(rows, ["machine", "event_type"], name="events")


def machine_efficiency(events: DataFrame, as_of: Moment, lookback: str = "24 hours") -> DataFrame:
    """Sums of the numeric fields of processing events per machine."""
    rows = recent(events, as_of, lookback).where(F.col("event_type").rlike("processing"))
    fields = [f for f in ("duration", "tool_wear", "cycle_time") if f in events.columns]
    return rows.groupBy("machine").agg(*[F.sum(f).alias(f) for f in fields])


def tool_wear_last(events: DataFrame, as_of: Moment, lookback: str = "24 hours", limit: float = 0.8) -> DataFrame:
    """Per machine and tool the newest reading of those over the limit."""
    worn = recent(events, as_of, lookback).where(F.col("tool_wear") > limit)
    return series.last_by(worn.select(*_ids(events), "_time", "machine", "tool", "tool_wear"), ["machine", "tool"])


def pieces_in_production(events: DataFrame, as_of: Moment, lookback: str = "24 hours") -> DataFrame:
    """Newest processing start of every piece."""
    started = recent(events, as_of, lookback).where(F.col("event_type") == "processing_start")
    return series.last_by(started, ["piece_id"])


def pieces_processed(events: DataFrame, as_of: Moment, lookback: str = "1 hour") -> DataFrame:
    """Finished processing events and distinct finished pieces, over all machines."""
    return _finished(events, as_of, lookback).agg(
        F.count(F.lit(1)).alias("processing_ends"), F.count_distinct("piece_id").alias("pieces"),
    )


def production_rate(events: DataFrame, as_of: Moment, lookback: str = "24 hours",
                    by: Sequence[str] = ("machine", "event_type", "piece_id", "tool")) -> DataFrame:
    """Finished processing events per series and hour."""
    _, stop = bounds(events, as_of, lookback)
    count = [F.count(F.lit(1)).alias("_value")]
    return series.window_aggregate(_finished(events, as_of, lookback), by, "1 hour", count, stop)


def daily_cycle_time_by_machine(events: DataFrame, as_of: Moment, lookback: str = "24 hours") -> DataFrame:
    _, stop = bounds(events, as_of, lookback)
    return series.window_value(
        _finished(events, as_of, lookback), ["machine"], "1 day", F.sum, stop, "cycle_time", "cycle_time",
    )


def machine_status(events: DataFrame, as_of: Moment, lookback: str = "24 hours") -> DataFrame:
    """Newest event of every machine and the status it implies."""
    newest = series.last_by(
        recent(events, as_of, lookback).select(*_ids(events), "_time", "machine", "event_type"), ["machine"],
    )
    status = (
        F.when(F.col("event_type").endswith("start"), "active")
        .when(F.col("event_type").endswith("end"), "completed").otherwise("unknown")
    )
    return newest.withColumn("status", status)


def availability(events: DataFrame, as_of: Moment, lookback: str = "24 hours",
                 by: Sequence[str] = ("machine", "piece_id", "tool")) -> DataFrame:
    """Percent of the range each machine spent between a processing start and its end.

    Processing that reaches over an edge of the range counts up to it: a series whose first event in
    the range is an end was busy from the start of the range, one whose last event is a start is busy until
    its stop.
    """
    start, stop = bounds(events, as_of, lookback)
    inside = time_range(events, start, stop).select(*_ids(events), "_time", "event_type", *by)
    named = inside.where(F.col("event_type").isNotNull())
    pairs = start_end_pairs(inside, by, "processing_start", "processing_end").select("machine", "seconds")
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    head = series.first_by(named, by).where(F.col("event_type") == "processing_end")
    tail = series.last_by(named, by).where(F.col("event_type") == "processing_start")
    busy = (
        pairs.unionByName(head.select("machine", ((micros(F.col("_time")) - micros(start)) / F.lit(1e6)).alias("seconds")))
        .unionByName(tail.select("machine", ((micros(stop) - micros(F.col("_time"))) / F.lit(1e6)).alias("seconds")))
    )
    span = (micros(stop) - micros(start)) / F.lit(1e6)
    return busy.groupBy("machine").agg(F.sum("seconds").alias("seconds")).select(
        "machine", (F.col("seconds") / span * 100.0).alias("availability_pct"),
    )


def tool_wear_trend(events: DataFrame, as_of: Moment, lookback: str = "24 hours") -> DataFrame:
    """Change of wear per hour of each tool on each machine, by least squares."""
    start, _ = bounds(events, as_of, lookback)
    rows = recent(events, as_of, lookback).where(F.col("tool_wear").isNotNull() & F.col("tool").isNotNull())
    micros = F.unix_micros(F.col("_time").cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    hours = micros / F.lit(3.6e9)
    return rows.groupBy("machine", "tool").agg(
        F.regr_slope("tool_wear", hours).alias("wear_per_hour"), F.count(F.lit(1)).alias("readings"),
    )


def piece_traceability(pieces: DataFrame, as_of: Moment, lookback: str = "24 hours",
                       piece_id: str = "PZ001") -> DataFrame:
    """Everything that happened to one piece, oldest first."""
    return series.sort_by_time(recent(pieces, as_of, lookback).where(F.col("piece_id") == piece_id))


def transport_time_mean(pieces: DataFrame, as_of: Moment, lookback: str = "24 hours") -> DataFrame:
    moved = recent(pieces, as_of, lookback).where(F.col("event_type") == "move_end")
    return series.mean_by(moved, ["from_station", "to_station"], "duration", "mean_duration")


def production_by_material(pieces: DataFrame, as_of: Moment, lookback: str = "24 hours") -> DataFrame:
    """Deposited pieces per material."""
    done = recent(pieces, as_of, lookback).where(F.col("event_type") == "deposit")
    if "material" not in pieces.columns:
        done = done.withColumn("material", F.expr(piece_material()))
    return series.count_by(done, ["material"])


def daily_production(pieces: DataFrame, as_of: Moment, lookback: str = "24 hours") -> DataFrame:
    return production_by_material(pieces, as_of, lookback).withColumnRenamed("_value", "pieces_completed")


def processor_performance(system: DataFrame, as_of: Moment, lookback: str = "1 hour",
                          component: str = "event_processor",
                          field_pattern: str = "cpu|memory|uptime") -> DataFrame:
    """Fields of one component whose names match a pattern, a row per stamp."""
    import re

    known = [f for f in system.columns if f not in ("event_id", "_time", "component", "metric_type", "severity")]
    fields = [f for f in known if re.search(field_pattern, f)]
    rows = recent(system, as_of, lookback).where(F.col("component") == component)
    return rows.select(*_ids(system), "_time", "component", "metric_type", "severity", *fields)


def system_health_last(system: DataFrame, as_of: Moment, lookback: str = "30 minutes",
                       metric_type: str = "health") -> DataFrame:
    rows = recent(system, as_of, lookback).where(F.col("metric_type") == metric_type)
    return series.last_by(rows, ["component"])


def errors_by_component(system: DataFrame, as_of: Moment, lookback: str = "24 hours",
                        field: str = "errors") -> DataFrame:
    return series.sum_by(recent(system, as_of, lookback), ["component"], field, "errors")


def system_performance(system: DataFrame, as_of: Moment, lookback: str = "1 hour",
                       every: str = "30 seconds") -> DataFrame:
    """Mean processor and memory use per series and window."""
    _, stop = bounds(system, as_of, lookback)
    means = [F.avg(f).alias(f) for f in ("cpu", "memory_used_percent")]
    by = ["component", "metric_type", "severity"]
    return series.window_aggregate(recent(system, as_of, lookback), by, every, means, stop)


def field_window_mean(sensor: DataFrame, field: str, as_of: Moment, lookback: str = "1 hour",
                      every: str = "30 seconds", by: Sequence[str] = SERIES) -> DataFrame:
    """Mean of one field per series and window."""
    _, stop = bounds(sensor, as_of, lookback)
    return series.window_value(recent(sensor, as_of, lookback), by, every, F.avg, stop, field, field)


def temperature_panel(sensor: DataFrame, as_of: Moment, lookback: str = "1 hour") -> DataFrame:
    """30 s means of temperature with their colour band."""
    means = field_window_mean(sensor, "temperature", as_of, lookback)
    return means.withColumn("band", F.expr(threshold_band("temperature", "temperature")))


def temperature_trend(sensor: DataFrame, as_of: Moment, lookback: str = "6 hours", machine: str = "Milling1",
                      n: int = 10) -> DataFrame:
    """Moving average of one machine's temperature."""
    rows = field_values(sensor, "temperature", as_of, lookback, machine)
    return moving_average(rows, _tags(sensor), n, "temperature")


def temperature_power(sensor: DataFrame, as_of: Moment, lookback: str = "2 hours",
                      machine: str = "Milling1") -> DataFrame:
    """Temperature and power of one machine side by side."""
    rows = recent(sensor, as_of, lookback).where(F.col("machine") == machine)
    present = rows.where(F.col("temperature").isNotNull() | F.col("power").isNotNull())
    return present.select(*_ids(sensor), "_time", *_tags(sensor), "temperature", "power")


def temperature_power_corr(sensor: DataFrame, as_of: Moment, lookback: str = "2 hours") -> DataFrame:
    """Correlation over the readings that have both fields."""
    return recent(sensor, as_of, lookback).groupBy("machine").agg(
        F.corr("temperature", "power").alias("correlation"),
    )


def field_corr(long: DataFrame, first: str, second: str, as_of: Moment, lookback: str = "24 hours",
               every: str = "1 hour") -> DataFrame:
    """Correlation, per machine, of the window means of two fields of a long table; windows without one of them are left out."""
    rows = recent(long, as_of, lookback).where(F.col("_field").isin(first, second))
    mean = lambda f: F.avg(F.when(F.col("_field") == f, F.col("_value"))).alias(f)
    windows = series.window_aggregate(rows, ["machine"], every, [mean(first), mean(second)])
    return windows.groupBy("machine").agg(
        F.corr(first, second).alias("correlation"),
        F.count_if(F.col(first).isNotNull() & F.col(second).isNotNull()).alias("windows"),
    )


def distinct_machines(sensor: DataFrame, as_of: Moment, lookback: str = "24 hours") -> DataFrame:
    return series.distinct_values(recent(sensor, as_of, lookback), "machine")


def critical_alerts(alerts: DataFrame, as_of: Moment, lookback: str = "1 hour") -> DataFrame:
    """Number of critical alerts and its colour band."""
    critical = recent(alerts, as_of, lookback).where(F.col("severity") == "critical")
    counted = critical.agg(F.count(F.lit(1)).alias("critical_alerts"))
    return counted.withColumn("band", F.expr(threshold_band("critical_alerts", "critical_alerts")))


def recent_alerts(alerts: DataFrame, as_of: Moment, lookback: str = "1 hour", n: int = 20,
                  ties: Sequence[str] = ("machine", "rule")) -> DataFrame:
    """The newest alerts as the dashboard lists them."""
    top = series.newest(recent(alerts, as_of, lookback), n, ["_time", *ties])
    return top.select("_time", "machine", "severity", F.expr(severity_label()).alias("label"), "message")
