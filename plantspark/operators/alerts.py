"""From readings with anomalies to alert rows and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plantspark.functions.rules import DEFAULTS, Thresholds, alert_table, anomalies, message
from plantspark.operators.limits import TableLimits, limits_at


def with_anomalies(readings: DataFrame, limits: Thresholds | TableLimits = DEFAULTS) -> DataFrame:
    """Adds the anomalies to a wide sensor table; fields the table lacks stay silent."""
    def field(name: str) -> str:
        return name if name in readings.columns else "cast(null as double)"

    found = anomalies(
        field("temperature"), field("vibration_level"), field("power"), field("rpm_spindle"), limits=limits,
    )
    return readings.selectExpr("*", f"{found} as anomalies")


def with_anomalies_over_time(readings: DataFrame, limits: DataFrame, defaults: Thresholds = DEFAULTS) -> DataFrame:
    """Adds the anomalies by the limits of each reading's machine at the time of the reading."""
    found = with_anomalies(limits_at(readings, limits), TableLimits.over(defaults))
    return found.select(*readings.columns, "anomalies")


def alerts(readings: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """One alert per anomaly, stored under the measurement its rule belongs to.

    Takes anomalies fresh from the rules or as stored. `extra` keeps further columns of the reading.
    """
    keep = extra or []
    stored = "message" in readings.schema["anomalies"].dataType.elementType.names
    hit = readings.selectExpr("_time", "machine", *keep, "explode(anomalies) as a")
    return hit.selectExpr(
        "_time", *keep, f"{alert_table('a.rule')} as _measurement", "machine", "a.severity",
        "'anomaly' as alert_type", "a.rule", f"{'a.message' if stored else message('a')} as message", "a.value",
        "false as resolved",
    )


def anomaly_stats(readings: DataFrame, other_processed: DataFrame | None = None) -> DataFrame:
    """processed_count, anomaly_count (readings with at least one) and their ratio.

    `other_processed` are rows of the other kinds: they count as processed and never as anomalous.
    """
    flags = readings.select((F.size("anomalies") > 0).alias("hit"))
    if other_processed is not None:
        flags = flags.unionByName(other_processed.select(F.lit(False).alias("hit")))
    counted = flags.agg(
        F.count(F.lit(1)).alias("processed_count"), F.count_if("hit").alias("anomaly_count"),
    )
    return counted.withColumn(
        "anomaly_rate", F.col("anomaly_count") / F.greatest("processed_count", F.lit(1)),
    )
