"""Hourly and daily rollups into history, and statistics of the messages themselves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from plantspark.operators.series import to_long, window_aggregate, window_value
from plantspark.schemas import SENSOR_FIELDS, SENSOR_TAGS
from plantspark.sources.tables import bounds, time_range


def hourly_means(sensor: DataFrame, as_of: datetime | str, lookback: str = "2 hours", lag: str = "1 hour",
                 by: Sequence[str] = SENSOR_TAGS, fields: Sequence[str] = SENSOR_FIELDS) -> DataFrame:
    """Mean of every field per series and hour; the default range leaves late rows one hour."""
    start, stop = bounds(sensor, as_of, lookback, lag)
    means = [F.avg(f).alias(f) for f in fields if f in sensor.columns]
    tags = [t for t in by if t in sensor.columns]
    return window_aggregate(time_range(sensor, start, stop), tags, "1 hour", means, stop)


def hourly_means_long(sensor: DataFrame, as_of: datetime | str, lookback: str = "2 hours", lag: str = "1 hour",
                      by: Sequence[str] = SENSOR_TAGS, fields: Sequence[str] = SENSOR_FIELDS,
                      extra: str = "extra_fields") -> DataFrame:
    """Mean of every field per series and hour, those that no layout declares included; a row per field."""
    start, stop = bounds(sensor, as_of, lookback, lag)
    tags = [t for t in by if t in sensor.columns]
    long = to_long(time_range(sensor, start, stop), [*tags, "_time"], fields, extra if extra in sensor.columns else None)
    return window_value(long, [*tags, "_field"], "1 hour", F.avg, stop)


def daily_cycle_time(events: DataFrame, as_of: datetime | str, lookback: str = "2 days", lag: str = "1 day",
                     by: Sequence[str] = ("machine", "event_type", "piece_id", "tool")) -> DataFrame:
    """Summed cycle time per series and day."""
    start, stop = bounds(events, as_of, lookback, lag)
    ends = time_range(events, start, stop).where(F.col("event_type") == "processing_end")
    return window_value(ends, by, "1 day", F.sum, stop, "cycle_time", "cycle_time")


def hourly_efficiency(events: DataFrame, as_of: datetime | str, lookback: str = "2 hours",
                      lag: str = "1 hour") -> DataFrame:
    """Summed cycle time and finished pieces per machine and hour."""
    start, stop = bounds(events, as_of, lookback, lag)
    ends = time_range(events, start, stop).where(
        (F.col("event_type") == "processing_end") & F.col("cycle_time").isNotNull()
    )
    sums = [F.sum("cycle_time").alias("cycle_time"), F.count(F.lit(1)).alias("pieces")]
    return window_aggregate(ends, ["machine"], "1 hour", sums, stop)


def message_stats(checked: DataFrame, uptime_seconds: float | None = None) -> DataFrame:
    """Messages received, processed, refused and unknown, rate per second, last arrival.

    Payloads that are no JSON were never received. Without an uptime, the time between the first
    and the last arrival is taken, and at least one second.
    """
    reason = F.col("reason")
    received = F.coalesce(reason, F.lit("")) != "bad_json"
    counted = checked.agg(
        F.count_if(received).alias("messages_received"),
        F.count_if(reason.isNull()).alias("messages_processed"),
        F.count_if(received & reason.isNotNull() & (reason != "unknown_topic")).alias("errors"),
        F.count_if(reason == "unknown_topic").alias("unknown_topics"),
        F.min("arrived_at").alias("first_message_at"),
        F.max("arrived_at").alias("last_message_at"),
    )
    seconds = (
        F.lit(float(uptime_seconds)) if uptime_seconds is not None
        else F.timestamp_diff("SECOND", F.col("first_message_at"), F.col("last_message_at"))
    )
    rate = F.col("messages_processed") / F.greatest(seconds.cast("double"), F.lit(1.0))
    return counted.withColumn("processing_rate", rate)


def pipeline_totals(stats: DataFrame) -> DataFrame:
    """Running counters of an ingestion, from the statistics it stored for each of its batches."""
    total = stats.agg(
        *[F.sum(c).alias(c) for c in ("messages_received", "messages_processed", "errors", "unknown_topics")],
        F.min("first_message_at").alias("first_message_at"), F.max("last_message_at").alias("last_message_at"),
    )
    seconds = F.timestamp_diff("SECOND", F.col("first_message_at"), F.col("last_message_at")).cast("double")
    return total.withColumn("processing_rate", F.col("messages_processed") / F.greatest(seconds, F.lit(1.0)))


def write_stats(tables: Mapping[str, DataFrame], time: str = "_time") -> DataFrame:
    """Points written and the newest stamp, per table."""
    return reduce(DataFrame.unionByName, [
        rows.agg(F.count(F.lit(1)).alias("points_written"), F.max(time).alias("last_time"))
        .select(F.lit(name).alias("_table"), "points_written", "last_time")
        for name, rows in tables.items()
    ])
