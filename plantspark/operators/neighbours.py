"""Operators that look at earlier rows of the same series: elapsed time, moving averages, pairs.

A plain window over a series would put the whole series into one task, and one machine may hold a
third of all rows. Here every series is cut into time chunks; the few rows just before a chunk are
copied into it, so each chunk can be computed alone and the result is the same as without cutting.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from plantspark.operators.series import order_columns

CHUNK = ("_chunk", "_sub")
# Chunk widths in microseconds; a chunk with too many rows is cut by the next width. The last one
# holds a single instant, whose rows are cut by their tie-breaker.
WIDTHS = (3_600_000_000, 240_000_000, 15_000_000, 1_000_000, 62_500, 3_900, 1)


@dataclass(frozen=True)
class Chunking:
    """How series are cut.

    Without `max_rows` every chunk is `width` microseconds long, an hour unless the caller knows that the
    data are denser, and no job runs before the result is asked for. With `max_rows` one count after the other finds
    the chunks with more rows and cuts them finer, down to ranges of the tie-breaker; a list of dense
    chunks of up to `broadcast_rows` is broadcast.
    """

    max_rows: int | None = None
    broadcast_rows: int = 200_000
    width: int = WIDTHS[0]


def _floor(micros: Column, width: int) -> Column:
    return micros - F.pmod(micros, F.lit(width))


def in_chunks(df: DataFrame, by: Sequence[str], time: str = "_time", tie: str | None = None,
              chunking: Chunking = Chunking()) -> tuple[DataFrame, list[str]]:
    """Adds `_chunk` and `_sub`: consecutive pieces of each series. Also gives the columns that tell pieces apart."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    keys, limit = [*by, *CHUNK], chunking.max_rows
    cut = df.withColumn("_chunk", _floor(micros, chunking.width)).withColumn("_sub", F.lit(0).cast("bigint"))
    finer = [w for w in WIDTHS if w < chunking.width]
    for width in [*finer, 1] if limit else []:
        sizes = cut.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > limit)
        found = sizes.count()
        if not found:
            break
        dense = sizes.select(*keys, F.lit(True).alias("_dense"))
        if found <= chunking.broadcast_rows:
            dense = F.broadcast(dense)
        marked = cut.alias("c").join(
            dense.alias("d"),
            reduce(lambda a, b: a & b, [F.col(f"c.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys]),
            "left",
        ).select("c.*", "d._dense")
        inner = _floor(micros, width)
        sub = F.floor(F.col(tie) / limit).cast("bigint") if tie and width == 1 else F.lit(0)
        cut = (
            marked.withColumn("_chunk", F.when(F.col("_dense"), inner).otherwise(F.col("_chunk")))
            .withColumn("_sub", F.when(F.col("_dense"), sub).otherwise(F.col("_sub")).cast("bigint"))
            .drop("_dense")
        )
    return cut, keys


def chunk_tails(cut: DataFrame, keys: Sequence[str], n: int, order: Sequence[str]) -> DataFrame:
    """The last n rows of every piece; tasks drop the others before the shuffle."""
    latest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return cut.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") <= n).drop("_rank")


def with_history(cut: DataFrame, tails: DataFrame, by: Sequence[str], n: int, order: Sequence[str]) -> DataFrame:
    """Rows of a chunked table plus, marked `_history`, the n rows before each piece.

    `tails` holds at least the last n rows of every piece. A tail row belongs to the history of
    those later pieces that start within the next n tail rows.
    """
    chunk = F.struct(*CHUNK)
    ahead = Window.partitionBy(*by).orderBy(*order).rowsBetween(1, n)
    later = F.array_except(F.collect_set(chunk).over(ahead), F.array(chunk))
    columns = [c for c in cut.columns if c not in CHUNK]
    history = (
        tails.withColumn("_later", later)
        .select(*columns, F.explode("_later").alias("_to"))
        .select(*columns, "_to._chunk", "_to._sub", F.lit(True).alias("_history"))
    )
    return cut.withColumn("_history", F.lit(False)).unionByName(history)


def _ordered(df: DataFrame, time: str, order: Sequence[str] | None) -> tuple[list[str], str | None]:
    names = list(order) if order else order_columns(df, time)
    last = names[-1]
    is_whole = last != time and df.schema[last].dataType.typeName() in ("long", "integer")
    return names, last if is_whole else None


def elapsed(df: DataFrame, by: Sequence[str], unit: str = "SECOND", time: str = "_time",
            order: Sequence[str] | None = None, chunking: Chunking = Chunking()) -> DataFrame:
    """Adds `elapsed`: whole units since the row before in the series; first rows are dropped.

    Of the piece before only its last stamp is needed, which a plain maximum gives without sorting.
    """
    names, tie = _ordered(df, time, order)
    cut, keys = in_chunks(df, by, time, tie, chunking)
    following = F.lead(F.struct(*CHUNK)).over(Window.partitionBy(*by).orderBy(*CHUNK))
    history = (
        cut.groupBy(*by, *CHUNK).agg(F.max(time).alias(time))
        .select(*by, time, following.alias("_to"))
        .where(F.col("_to").isNotNull())
        .select(*by, time, "_to._chunk", "_to._sub", F.lit(True).alias("_history"))
    )
    rows = cut.withColumn("_history", F.lit(False)).unionByName(history, allowMissingColumns=True)
    # Without tie-breakers of its own the history row sorts before rows of its stamp.
    return (
        rows.withColumn("_before", F.lag(time).over(Window.partitionBy(*keys).orderBy(*names)))
        .where(~F.col("_history") & F.col("_before").isNotNull())
        .withColumn("elapsed", F.timestamp_diff(unit, F.col("_before"), F.col(time)))
        .select(*df.columns, "elapsed")
    )


def moving_average(df: DataFrame, by: Sequence[str], n: int, value: str = "_value", time: str = "_time",
                   order: Sequence[str] | None = None, whole_series: bool = True,
                   chunking: Chunking = Chunking()) -> DataFrame:
    """Replaces the value by the mean of the last n values, from the n-th row of a series on.

    A series with fewer rows gives one row with the mean of all of them, unless `whole_series` is
    off because more rows are still to come.
    """
    present = df.where(F.col(value).isNotNull())
    if n < 2:
        return present
    names, tie = _ordered(df, time, order)
    cut, keys = in_chunks(present, by, time, tie, chunking)
    cut = cut.repartition(*keys)  # once, for the tails and for the rows themselves
    tails = chunk_tails(cut, keys, n, names)
    rows = with_history(cut, tails, by, n - 1, names)
    frame = Window.partitionBy(*keys).orderBy(*names).rowsBetween(-(n - 1), 0)
    full = (
        rows.withColumn("_mean", F.avg(value).over(frame))
        .withColumn("_seen", F.count(value).over(frame))
        .where(~F.col("_history") & (F.col("_seen") == n))
        .withColumn(value, F.col("_mean"))
        .select(*df.columns)
    )
    if not whole_series:
        return full
    # A series with fewer than n rows is wholly contained in the tails of its chunks.
    others = [c for c in df.columns if c not in by]
    short = (
        tails.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("_seen"),
            F.avg(value).alias("_mean"),
            F.max_by(F.struct(*others), F.struct(*names)).alias("_row"),
        )
        .where(F.col("_seen") < n)
        .select(*by, "_row.*", "_mean")
        .withColumn(value, F.col("_mean"))
        .select(*df.columns)
    )
    return full.unionByName(short)


def start_end_pairs(df: DataFrame, by: Sequence[str], start: str, end: str, event: str = "event_type",
                    time: str = "_time", order: Sequence[str] | None = None,
                    chunking: Chunking = Chunking()) -> DataFrame:
    """End events directly preceded in their series by a start event: adds `start_time`, `seconds`."""
    named = df.where(F.col(event).isNotNull())
    names, tie = _ordered(df, time, order)
    cut, keys = in_chunks(named, by, time, tie, chunking)
    cut = cut.repartition(*keys)
    rows = with_history(cut, chunk_tails(cut, keys, 1, names), by, 1, names)
    w = Window.partitionBy(*keys).orderBy(*names)
    return (
        rows.withColumn("_event_before", F.lag(event).over(w))
        .withColumn("start_time", F.lag(time).over(w))
        .where(~F.col("_history") & (F.col(event) == end) & (F.col("_event_before") == start))
        .withColumn(
            "seconds",
            (F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp")))
            / F.lit(1e6),
        )
        .select(*df.columns, "start_time", "seconds")
    )


def nearest_starts(df: DataFrame, by: Sequence[str], start: str, end: str, within: str | None = None, event: str = "event_type",
                   time: str = "_time", chunking: Chunking = Chunking()) -> DataFrame:
    """End events with the nearest start event before them in their series (or at the same time), whatever lies between: adds
    `start_time`, `seconds`. Ends without one, or with none inside the interval `within`, are left out.

    Each piece of a series needs its own rows and one time from the pieces before, the latest start. That is a running maximum over a row per
    piece, so no task gets a whole series.
    """
    kinds = df.where(F.col(event).isin(start, end))
    cut, keys = in_chunks(kinds, by, time, None, chunking)
    begun = F.when(F.col(event) == start, F.col(time))
    latest = cut.groupBy(*keys).agg(F.max(begun).alias("_latest"))
    before = Window.partitionBy(*by).orderBy(*CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.withColumn("_carried", F.max("_latest").over(before)).drop("_latest")
    own = Window.partitionBy(*keys).orderBy(F.col(time)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = cut.withColumn("_own", F.max(begun).over(own)).where(F.col(event) == end).alias("r")
    same = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys])
    found = rows.join(carried.alias("c"), same).select("r.*", F.coalesce("r._own", "c._carried").alias("start_time"))
    found = found.where(F.col("start_time").isNotNull()).select(*df.columns, "start_time", seconds_between("start_time", time))
    return found.where(F.col("start_time") >= F.col(time) - F.expr(f"INTERVAL {within}")) if within else found


def seconds_between(first: str, second: str) -> Column:
    """Seconds from one time to another, as `seconds`."""
    micros = [F.unix_micros(F.col(c).cast("timestamp")) for c in (first, second)]
    return ((micros[1] - micros[0]) / F.lit(1e6)).alias("seconds")
