"""Limits of the rules as a table: per machine, and valid from a time on."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plantspark.functions.rules import Thresholds

#: Tables of limits up to so many rows are broadcast, a row per machine; others are joined by a shuffle.
BROADCAST_LIMITS = 100_000
#: Columns of a table of limits, besides `machine` and `valid_from`.
LIMITS = [
    "temperature_warning", "temperature_critical", "vibration_warning", "vibration_critical",
    "power_warning", "power_critical", "power_low", "milling_rpm_low", "milling_rpm_high", "lathe_rpm_low", "lathe_rpm_high",
]
LAYOUT = T.StructType([
    T.StructField("machine", T.StringType()), T.StructField("valid_from", T.TimestampType()),
    *[T.StructField(name, T.DoubleType()) for name in LIMITS],
])
#: The column of the limits that hold for a reading.
OF_READING = "_limits"


@dataclass(frozen=True)
class TableLimits:
    """Limits as SQL: the value in the reading's row of the table, or the default where it has none."""

    temperature_warning: str
    temperature_critical: str
    vibration_warning: str
    vibration_critical: str
    power_warning: str
    power_critical: str
    power_low: str
    milling_rpm: tuple[str, str]
    lathe_rpm: tuple[str, str]

    @classmethod
    def over(cls, defaults: Thresholds) -> TableLimits:
        def sql(name: str, default: float) -> str:
            return f"coalesce({OF_READING}.{name}, {default}d)"

        values = {}
        for f in fields(cls):
            default = getattr(defaults, f.name)
            pair = isinstance(default, tuple)
            values[f.name] = tuple(sql(f"{f.name}_{end}", x) for end, x in zip(("low", "high"), default)) if pair else sql(f.name, default)
        return cls(**values)


def limits_at(readings: DataFrame, limits: DataFrame, time: str = "_time") -> DataFrame:
    """Adds the limits in force for each reading: of its machine's rows the one that became valid last, up to its time.

    A machine's rows go into one sorted array, so a reading meets one row, whatever the number of changes. Readings of a machine
    without limits, or before its first ones, get NULL. Of rows valid from the same time, the greater one counts.
    """
    zone = readings.schema[time].dataType
    values = [F.col(c) if c in limits.columns else F.lit(None).cast("double").alias(c) for c in LIMITS]
    known = limits.where(F.col("machine").isNotNull() & F.col("valid_from").isNotNull()).select(
        "machine", F.struct(F.col("valid_from").cast(zone).alias("valid_from"), *values).alias("row"))
    changes = known.groupBy(F.col("machine").alias("_machine")).agg(F.sort_array(F.collect_list("row")).alias("_changes"))
    side = F.broadcast(changes) if limits.count() <= BROADCAST_LIMITS else changes
    in_force = F.filter("_changes", lambda row: row["valid_from"] <= F.col(time))
    joined = readings.join(side, F.col("machine") == F.col("_machine"), "left")
    return joined.withColumn(OF_READING, F.try_element_at(in_force, F.lit(-1))).drop("_machine", "_changes")


def limit_problems(limits: DataFrame) -> DataFrame:
    """Rows of a table of limits that could never make sense, by the rules for configured ones: machine, valid_from, problem."""
    has = set(limits.columns)

    def low_high(low: str, high: str, text: str) -> Column:
        return F.when(F.col(low) >= F.col(high), F.lit(text)) if {low, high} <= has else F.lit(None)

    found = [low_high(f"{n}_warning", f"{n}_critical", f"{n} critical must be higher than warning") for n in ("temperature", "vibration", "power")]
    found += [low_high(f"{n}_rpm_low", f"{n}_rpm_high", f"{n} rpm limits must be in order") for n in ("milling", "lathe")]
    found += [F.when(F.col(f"{n}_warning") <= 0, F.lit(f"{n} warning must be positive")) for n in ("temperature", "vibration", "power") if f"{n}_warning" in has]
    found += [F.when(F.col("machine").isNull(), F.lit("machine is missing")), F.when(F.col("valid_from").isNull(), F.lit("valid_from is missing"))]
    return limits.select("machine", "valid_from", F.explode(F.array_compact(F.array(*found))).alias("problem"))
