"""Data-quality jobs: counts, completeness, gaps, tag combinations, declared domains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plantspark.operators.neighbours import elapsed
from plantspark.operators.series import count_by
from plantspark.schemas import DOMAINS, EXPECTED_MEASUREMENTS

# Totals below / above these call for more data / for retention.
TOO_FEW, TOO_MANY = 1000, 100_000
# Fixed value: seconds without a reading that make a gap.
GAP_SECONDS = 10


def measurement_counts(tables: Mapping[str, tuple[DataFrame, Sequence[str]]],
                       expected: Sequence[str] = EXPECTED_MEASUREMENTS) -> DataFrame:
    """Present field values per measurement; expected measurements without any count 0.

    `tables` maps a measurement to its rows and its field columns. A map column counts its entries.
    """
    spark = next(iter(tables.values()))[0].sparkSession

    def values(rows: DataFrame, field: str) -> Column:
        if rows.schema[field].dataType.typeName() != "map":
            return F.count(field)
        present = F.size(F.map_filter(field, lambda name, value: value.isNotNull()))
        return F.coalesce(F.sum(F.when(F.col(field).isNotNull(), present)), F.lit(0))

    counts = [
        rows.agg(reduce(lambda a, b: a + b, [values(rows, f) for f in fields]).alias("records"))
        .select(F.lit(name).alias("_measurement"), "records")
        for name, (rows, fields) in tables.items() if name in expected
    ]
    names = spark.createDataFrame([(n,) for n in expected], "_measurement string")
    if not counts:
        return names.withColumn("records", F.lit(0).cast("bigint"))
    found = reduce(DataFrame.unionByName, counts)
    return names.join(F.broadcast(found), "_measurement", "left").select(
        "_measurement", F.coalesce("records", F.lit(0)).cast("bigint").alias("records"),
    )


def volume_report(counts: DataFrame) -> DataFrame:
    """One row: total records, empty measurements and the advice for that volume."""
    total = counts.agg(
        F.sum(F.greatest("records", F.lit(0))).alias("total_records"),
        F.count_if(F.col("records") == 0).alias("empty_measurements"),
    )
    advice = (
        F.when(F.col("total_records") < TOO_FEW, "increase frequency")
        .when(F.col("total_records") > TOO_MANY, "retention")
        .otherwise("ok")
    )
    return total.withColumn("advice", advice)


def completeness(df: DataFrame, by: Sequence[str], field: str, name: str = "readings") -> DataFrame:
    """Readings of one field per group."""
    return count_by(df, by, field, name)


def gaps(df: DataFrame, by: Sequence[str], longer_than: int = GAP_SECONDS, field: str | None = None,
         **options) -> DataFrame:
    """Rows that follow the one before in their series by more than `longer_than` seconds.

    With `field`, only rows that have this field count.
    """
    rows = df if field is None else df.where(F.col(field).isNotNull())
    return elapsed(rows, by, "SECOND", **options).where(F.col("elapsed") > longer_than)


def gap_summary(gap_rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Gaps and longest gap per series that has any."""
    return gap_rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("gaps"), F.max("elapsed").alias("longest_seconds"),
    )


def tag_combinations(df: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Distinct combinations of tags, and whether one of them is missing."""
    missing = reduce(lambda a, b: a | b, [F.col(t).isNull() for t in tags])
    return df.select(*tags).distinct().withColumn("has_missing_tag", missing)


def present_names(tables: Mapping[str, DataFrame], name: str = "_measurement") -> DataFrame:
    """Those of the named tables that have any row; a scan stops at the first one."""
    return reduce(DataFrame.unionByName, [rows.limit(1).select(F.lit(n).alias(name)) for n, rows in tables.items()])


def missing_names(spark: SparkSession, expected: Sequence[str], found: DataFrame, name: str) -> DataFrame:
    """Expected names that are not among the found ones."""
    wanted = spark.createDataFrame([(e,) for e in expected], f"{name} string")
    return wanted.join(found.select(name).distinct(), name, "left_anti")


def _checks(df: DataFrame, measurement: str) -> list[tuple[str, str, Column]]:
    """(column, rule, condition that breaks it) for the declared columns the table has."""
    checks = []
    for d in DOMAINS[measurement]:
        if d.column not in df.columns:
            continue
        value = F.col(d.column)
        if d.values:
            checks.append((d.column, "allowed_values", ~value.isin(list(d.values))))
        if d.pattern:
            checks.append((d.column, "pattern", ~value.rlike(f"^{d.pattern}$")))
        if d.low is not None:
            checks.append((d.column, "range", ~value.between(d.low, d.high)))
        if d.machine_types and "machine_type" in df.columns:
            misplaced = value.isNotNull() & ~F.col("machine_type").isin(list(d.machine_types))
            checks.append((d.column, "machine_type", misplaced))
    return checks


def schema_violations(df: DataFrame, measurement: str) -> DataFrame:
    """Rows breaking each declared domain, one line per column and rule. A missing value breaks none.

    All rules are counted in one pass over the table.
    """
    checks = _checks(df, measurement)
    counted = df.agg(*[F.count_if(broken).alias(f"{column}|{rule}") for column, rule, broken in checks])
    lines = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(r).alias("rule"), F.col(f"{c}|{r}").alias("violations"))
        for c, r, _ in checks
    ])
    return counted.select(F.explode(lines).alias("line")).select(
        F.lit(measurement).alias("_measurement"), "line.*",
    )


def violating_rows(df: DataFrame, measurement: str) -> DataFrame:
    """Rows that break any declared domain, with the list of what they break."""
    broken = F.array(*[
        F.when(condition, F.lit(f"{column}:{rule}")) for column, rule, condition in _checks(df, measurement)
    ])
    flagged = df.withColumn("violations", F.filter(broken, lambda b: b.isNotNull()))
    return flagged.where(F.size("violations") > 0)
