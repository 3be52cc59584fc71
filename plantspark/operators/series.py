"""Series operators. `by` names the columns that tell one series from another."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

TIE = ("event_id",)
# Tasks may each keep n rows of the same series; this many groups share them before the last step.
LIMIT_SALTS = 32
# Spark's own limit for ranking before a shuffle (spark.sql.optimizer.windowGroupLimitThreshold).
OPTIMIZED_LIMIT = 1000


def order_columns(df: DataFrame, time: str = "_time", ties: Sequence[str] = TIE) -> list[str]:
    """Time and the tie-breakers the table has; without any, all columns that can be ordered.

    So rows of equal time keep one order however often a task is repeated.
    """
    present = [t for t in ties if t in df.columns]
    if not present:
        unordered = (T.MapType, T.VariantType)
        present = [f.name for f in df.schema if f.name != time and not isinstance(f.dataType, unordered)]
    return [time, *present]


def aggregate(df: DataFrame, by: Sequence[str], fn: Callable[[Column], Column], value: str = "_value",
              name: str = "_value") -> DataFrame:
    """One value per group: `fn` is any aggregate function of one column."""
    return df.groupBy(*by).agg(fn(F.col(value)).alias(name))


def sum_by(df: DataFrame, by: Sequence[str], value: str = "_value", name: str = "_value") -> DataFrame:
    """Sums per group; groups without any value are not points and do not appear."""
    return aggregate(df.where(F.col(value).isNotNull()), by, F.sum, value, name)


def count_by(df: DataFrame, by: Sequence[str], value: str | None = None, name: str = "_value") -> DataFrame:
    """Rows per group, or non-null values of one column per group."""
    rows = df if value is None else df.where(F.col(value).isNotNull())
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def mean_by(df: DataFrame, by: Sequence[str], value: str = "_value", name: str = "_value") -> DataFrame:
    return aggregate(df.where(F.col(value).isNotNull()), by, F.avg, value, name)


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def _whole_rows(df: DataFrame, by: Sequence[str], latest: bool, order: Sequence[str]) -> DataFrame:
    """One whole row per group: a hash aggregate of the time alone, then a choice among the rows that have it.

    So no task sorts all its rows to keep one per group. The times are one row per group.
    """
    time, *ties = order
    edge = df.groupBy(*by).agg((F.max if latest else F.min)(time).alias(time))
    met = df.alias("r").join(edge.alias("e"), _same("r", "e", [*by, time]), "left_semi")
    ranks = [F.col(c).desc() if latest else F.col(c).asc() for c in (ties or [time])]
    return _first_n(met, by, 1, ranks)


def last_by(df: DataFrame, by: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The whole row with the greatest time of each group."""
    return _whole_rows(df, by, True, order or order_columns(df))


def first_by(df: DataFrame, by: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The whole row with the least time of each group; rows without a time come after all others."""
    return _whole_rows(df, by, False, order or order_columns(df))


def _first_n(df: DataFrame, keys: Sequence[str], n: int, order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def limit_per_series(df: DataFrame, by: Sequence[str], n: int, newest: bool = False,
                     order: Sequence[str] | None = None) -> DataFrame:
    """First (or newest) n rows of every series.

    A series may hold a third of all rows, and each task may pass on n of them; salted groups cut
    them down to n * LIMIT_SALTS before one task sees the whole series. Spark ranks inside a task before
    the shuffle only up to OPTIMIZED_LIMIT rows; beyond it rows are counted by hour first, and only the hours
    that can hold the first n rows are ranked.
    """
    names = order or order_columns(df)
    columns = [F.col(c).desc() if newest else F.col(c).asc() for c in names]
    if n > OPTIMIZED_LIMIT:
        return _first_n(_edge_hours(df, by, n, newest, names[0]), by, n, columns)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*names), F.lit(LIMIT_SALTS)))
    return _first_n(_first_n(salted, [*by, "_salt"], n, columns).drop("_salt"), by, n, columns)


def _edge_hours(df: DataFrame, by: Sequence[str], n: int, newest: bool, time: str) -> DataFrame:
    """Rows of the hours in which the first (or newest) n rows of their series lie."""
    timed = df.withColumn("_hour", F.date_trunc("hour", time))
    counts = timed.groupBy(*by, "_hour").agg(F.count(F.lit(1)).alias("_rows"))
    ahead = Window.partitionBy(*by).orderBy(F.col("_hour").desc() if newest else F.col("_hour").asc())
    before = F.sum("_rows").over(ahead.rowsBetween(Window.unboundedPreceding, -1))
    wanted = counts.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < n)
    return timed.alias("r").join(wanted.alias("e"), _same("r", "e", [*by, "_hour"]), "left_semi").drop("_hour")


def newest(df: DataFrame, n: int, order: Sequence[str] | None = None) -> DataFrame:
    """The n newest rows of the whole table, newest first."""
    names = order or order_columns(df)
    return df.orderBy(*[F.col(c).desc() for c in names]).limit(n)


def sort_by_time(df: DataFrame, descending: bool = False, ties: Sequence[str] = TIE) -> DataFrame:
    names = order_columns(df, ties=ties)
    return df.orderBy(*[F.col(c).desc() if descending else F.col(c).asc() for c in names])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column, as `_value`."""
    return df.select(F.col(column).alias("_value")).distinct()


def to_long(df: DataFrame, ids: Sequence[str], fields: Sequence[str], extra: str | None = None) -> DataFrame:
    """One row per present field: the id columns, `_field`, `_value`.

    `extra` names a map column with further fields; they come out in the same pass over the rows.
    """
    if extra is None:
        same_type = df.select(*ids, *[F.col(f).cast("double").alias(f) for f in fields])
        long = same_type.unpivot(list(ids), list(fields), "_field", "_value")
        return long.where(F.col("_value").isNotNull())
    declared = F.array(*[F.struct(F.lit(f).alias("key"), F.col(f).cast("double").alias("value")) for f in fields])
    others = F.coalesce(F.map_entries(F.col(extra).cast("map<string,double>")), F.array())
    entries = F.filter(F.concat(declared, others), lambda e: e["value"].isNotNull())
    return df.select(*ids, F.inline(entries).alias("_field", "_value"))


def pivot_fields(df: DataFrame, keys: Sequence[str], fields: Sequence[str],
                 order: Sequence[str] | None = None) -> DataFrame:
    """Long rows to one row per key with a column per field; of equal points the later one counts.

    The field list is given, so no job is needed to find it and other fields are dropped early.
    """
    ties = [t for t in (order or order_columns(df)) if t not in keys]
    wanted = df.where(F.col("_field").isin(list(fields)))
    if not ties:
        value: Callable[[str], Column] = lambda f: F.max(F.when(F.col("_field") == f, F.col("_value")))
    else:
        rank = F.struct(*ties) if len(ties) > 1 else F.col(ties[0])
        value = lambda f: F.max_by("_value", F.when(F.col("_field") == f, rank))
    return wanted.groupBy(*keys).agg(*[value(f).alias(f) for f in fields])


def window_aggregate(df: DataFrame, by: Sequence[str], every: str, aggregates: Sequence[Column],
                     stop: Column | None = None, time: str = "_time") -> DataFrame:
    """Tumbling windows aligned to the epoch, one row per group and non-empty window.

    `_time` is the end of the window, or the end of the scanned range where that cuts the window.
    Partial aggregation leaves one row per task, group and window to shuffle.
    """
    grouped = df.groupBy(*by, F.window(time, every).alias("_window")).agg(*aggregates)
    end = F.col("_window.end")
    end = F.least(end, stop) if stop is not None else end
    results = [c for c in grouped.columns if c not in by and c != "_window"]
    return grouped.select(*by, end.alias("_time"), *results)


def window_value(df: DataFrame, by: Sequence[str], every: str, fn: Callable[[Column], Column],
                 stop: Column | None = None, value: str = "_value", name: str = "_value",
                 time: str = "_time") -> DataFrame:
    """`window_aggregate` of one column; rows without a value are not points."""
    rows = df.where(F.col(value).isNotNull())
    return window_aggregate(rows, by, every, [fn(F.col(value)).alias(name)], stop, time)


def collapse_points(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of equal key become one point; each field keeps its last value that is present.

    Stamps lead the grouping: it is done by sorting, and they differ sooner than tags.
    """
    rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
    fields = [c for c in df.columns if c not in key and c not in order]
    kept = [F.max_by(f, F.when(F.col(f).isNotNull(), rank)).alias(f) for f in fields]
    stamps_first = sorted(key, key=lambda c: "timestamp" not in df.schema[c].dataType.typeName())
    return df.groupBy(*stamps_first).agg(*kept).select(*key, *fields)


def legend(df: DataFrame, by: Sequence[str], value: str, time: str = "_time",
           order: Sequence[str] | None = None) -> DataFrame:
    """Last present value, maximum and mean of each series."""
    present = df.where(F.col(value).isNotNull())
    figures = present.groupBy(*by).agg(F.max(value).alias("max_value"), F.avg(value).alias("mean_value"))
    last = last_by(present, by, order or order_columns(present, time))
    return (
        last.select(*by, F.col(value).alias("last_value")).alias("l")
        .join(figures.alias("f"), _same("l", "f", by))
        .select(*[F.col(f"l.{c}").alias(c) for c in by], "last_value", "max_value", "mean_value")
    )


def selected(df: DataFrame, column: str, choice: Sequence[str] | str) -> DataFrame:
    """Rows whose column is among the chosen values; `All` keeps every row."""
    chosen = [choice] if isinstance(choice, str) else list(choice)
    return df if "All" in chosen else df.where(F.col(column).isin(chosen))
