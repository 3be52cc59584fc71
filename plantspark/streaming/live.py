"""Tables that a stream keeps up to date: open windows, the last row of each series, merged points, nearest starts; and the
repair of windows that late rows belong to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from plantspark.operators.neighbours import seconds_between
from plantspark.operators.series import last_by, order_columns, window_aggregate
from plantspark.sources import snapshots
from plantspark.sources.tables import merge_rows, read_parts, run_of
from plantspark.streaming.ingest import FLUSH_EVERY, start

#: The part of a table of windows is the day before the end of a window, as in rollups.
WINDOW_DAY = "window_date"
#: Up to so many recorded windows are broadcast.
FEW_WINDOWS = 100_000
#: A table of last rows lies in so many shards, of which a batch rewrites those that it has rows of.
SHARDS, SHARD = 16, "shard"
#: Nearest starts: slots that make one of the next level, and levels of slots.
PARTS, LEVELS = 32, 2


def _day(time: str = "_time") -> Column:
    return F.to_date(F.col(time) - F.expr("INTERVAL 1 MICROSECOND"))


# --- windows ----------------------------------------------------------------------------------


def live_windows(rows: DataFrame, by: Sequence[str], window: str, aggregates: Sequence[Column], root: str, name: str,
                 checkpoint: str, delay: str = "1 hour", every: str | None = FLUSH_EVERY) -> StreamingQuery:
    """Keeps a table of all windows, open ones included: every batch merges the windows it has changed.

    The state holds the windows that end later than `delay` before the newest row. Rows later than that change nothing here;
    `note_late` records their windows, and `repair_windows` brings these in order.
    """
    windows = window_aggregate(rows.withWatermark("_time", delay), by, window, aggregates)

    def merge(changed: DataFrame, batch_id: int) -> None:
        merge_rows(changed.withColumn(WINDOW_DAY, _day()), root, name, [*by, "_time"], WINDOW_DAY)

    return start(windows.writeStream.foreachBatch(merge).outputMode("update"), checkpoint, every)


def note_late(rows: DataFrame, window: str, root: str, name: str, checkpoint: str, delay: str = "1 hour",
              every: str | None = FLUSH_EVERY) -> StreamingQuery:
    """Records the windows that got rows after they were given out, or may have: those that ended `delay` before the newest
    row, whichever job saw that first. A row per window and batch; a window that was complete is repaired in vain, none is missed.
    """
    spark, run = rows.sparkSession, run_of(rows.sparkSession, checkpoint)

    def note(batch: DataFrame, batch_id: int) -> None:
        newest = batch.agg(F.unix_micros(F.max("_time"))).first()[0]
        seen = {int(n.rpartition("-")[2]): n for n in snapshots.names_in(spark, f"{root}/seen") if n.startswith(f"{run}-")}
        before = sorted(k for k in seen if k < batch_id)
        known = [int(snapshots.read_text(spark, f"{root}/seen/{seen[k]}")) for k in before[-1:]]
        high = max([x for x in (newest, *known) if x is not None], default=None)
        if high is None:
            return
        closed = F.timestamp_micros(F.lit(high)) - F.expr(f"INTERVAL {delay}")
        late = batch.groupBy(F.window("_time", window).alias("w")).agg(F.count(F.lit(1)).alias("rows"))
        late = late.where(F.col("w.end") <= closed).select(F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "rows")
        late = late.withColumn(WINDOW_DAY, _day("stop"))
        snapshots.add_batch(late, f"{root}/{name}", run, batch_id, WINDOW_DAY)
        mine = f"{root}/seen/{run}-{batch_id}"
        if not snapshots.write_text(spark, mine, str(high)):  # left by an earlier try of this batch
            snapshots.delete(spark, mine)
            snapshots.write_text(spark, mine, str(high))
        for old in before[:-1]:
            snapshots.delete(spark, f"{root}/seen/{seen[old]}")

    return start(rows.writeStream.foreachBatch(note), checkpoint, every)


def repair_windows(table: DataFrame, by: Sequence[str], window: str, aggregates: Sequence[Column], root: str, name: str,
                   late: str) -> list[str]:
    """Makes the recorded windows anew from the stored rows, and those only; the days that were touched. Records that have been seen to go.

    table: the stored rows. Only the days of the recorded windows are scanned, and their rows outside these windows are dropped
    before they are grouped."""
    spark, path = table.sparkSession, f"{root}/{late}"
    now = snapshots.state(spark, path)
    recorded = snapshots.read(spark, path, WINDOW_DAY, at=now)
    if recorded is None:
        return []
    wanted = recorded.select("start", "stop").distinct()
    low, high = wanted.agg(F.min("start"), F.max("stop")).first()
    zone = table.schema["_time"].dataType
    inside = table.where((F.col("_time") >= F.lit(low).cast(zone)) & (F.col("_time") < F.lit(high).cast(zone)))
    own = F.window("_time", window)
    # rows of recorded windows; there are few windows in a day, whatever the number of series
    begins = wanted.select(F.col("start").alias("_w"))
    begins = F.broadcast(begins) if wanted.count() <= FEW_WINDOWS else begins
    marked = inside.withColumn("_w", own.getField("start").cast("timestamp")).join(begins, "_w", "left_semi")
    made = window_aggregate(marked.drop("_w"), by, window, aggregates)
    days = merge_rows(made.withColumn(WINDOW_DAY, _day()), root, name, [*by, "_time"], WINDOW_DAY)

    def seen_to(newer: snapshots.State) -> snapshots.State:
        left = {d: [v for v in versions if v not in now.days.get(d, [])] for d, versions in newer.days.items()}
        return snapshots.replace(newer, days={d: v for d, v in left.items() if v}, batches=snapshots.taken_in(newer, now, now.days))

    snapshots.change(spark, path, seen_to)
    return days


# --- last rows --------------------------------------------------------------------------------


def follow_last(rows: DataFrame, by: Sequence[str], root: str, name: str, checkpoint: str, order: Sequence[str] | None = None,
                every: str | None = FLUSH_EVERY) -> StreamingQuery:
    """Keeps a table with the last row of every series, whatever the order in which rows come: `last_by` of all rows so far.

    A batch is cut down to one row per series before it meets the table.
    """
    names = list(order) if order else order_columns(rows)

    def keep(batch: DataFrame, batch_id: int) -> None:
        shard = F.format_string("s%02d", F.pmod(F.xxhash64(*by), F.lit(SHARDS)))
        new = last_by(batch, by, names).withColumn(SHARD, shard)
        old = read_parts(batch.sparkSession, root, name, SHARD)
        if old is not None:
            touched = [r[0] for r in new.select(SHARD).distinct().collect()]
            new = last_by(new.unionByName(old.where(F.col(SHARD).isin(touched))), by, names)
        merge_rows(new, root, name, by, SHARD)

    return start(rows.writeStream.foreachBatch(keep), checkpoint, every)


def last_rows(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The last row of every series so far, one state of it."""
    found = read_parts(spark, root, name, SHARD)
    return None if found is None else found.drop(SHARD)


# --- points -----------------------------------------------------------------------------------


def merged_points(rows: DataFrame, key: Sequence[str], order: Sequence[str], delay: str = "1 hour", time: str = "_time") -> DataFrame:
    """Rows of equal key, which `time` is part of, become one point: each field keeps the last value that is present, by `order`
    (when it came). `collapse_points` on a stream: a point is given out once, when the watermark has passed its time by `delay`.

    One state, a row per open point; tasks merge their own rows before the shuffle, so a point of which a third of all rows are
    copies is no hot spot.
    """
    rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
    fields = [c for c in rows.columns if c not in key and c not in order]
    kept = [F.max_by(f, F.when(F.col(f).isNotNull(), rank)).alias(f) for f in fields]
    return rows.withWatermark(time, delay).groupBy(*key).agg(*kept).select(*key, *fields)


# --- pairs ------------------------------------------------------------------------------------


def start_candidates(rows: DataFrame, by: Sequence[str], begin: str, end: str, within: str, event: str, time: str, delay: str) -> DataFrame:
    """Ends joined with those starts of their series in the interval `within` before them that can be the latest, as `_start` in microseconds.

    Time is cut into slots, PARTS of which make a slot of the next level; PARTS of the widest make the interval. An end meets the starts of its own
    narrowest slot, and of the slots before it only the latest start each: of the slots of a level that share its slot of the next level, and of the
    widest slots as far as the interval reaches. So an end meets LEVELS * PARTS rows and the starts of one narrow slot, however many the interval holds,
    and a series with a third of all rows is spread by time.
    """
    spark = rows.sparkSession
    width = spark.range(1).select(F.expr(f"CAST(unix_micros(TIMESTAMP'1970-01-01' + INTERVAL {within}) AS BIGINT)")).first()[0]
    narrowest = max(1, -(-width // (1000 * PARTS**LEVELS))) * 1000  # whole milliseconds, as watermarks are
    widths = [narrowest * PARTS**k for k in range(LEVELS)]
    seen = rows.withWatermark(time, delay)
    series = [F.col(c).alias(f"_s_{c}") for c in by]

    def slot(level: int, micros: Column = F.unix_micros(time)) -> Column:
        return F.call_function("div", micros - F.pmod(micros, F.lit(widths[level])), F.lit(widths[level]))

    # starts, each under the key (level, slot) of the ends that may meet it; `_at`: when the row is known to be complete
    begun = seen.where(F.col(event) == begin)
    met = begun.select(*series, F.col(time).alias("_at"), F.unix_micros(time).alias("_start"), F.lit(0).alias("_level"), slot(0).alias("_slot"))
    for k in range(LEVELS):
        latest = begun.groupBy(*by, F.window(time, f"{widths[k]} microseconds")).agg(F.max(F.unix_micros(time)).alias("_start"))
        latest = latest.select(*series, F.window_time("window").alias("_at"), "_start")
        if k + 1 < LEVELS:
            latest = latest.withColumns({"_level": F.lit(k + 1), "_slot": slot(k + 1, F.col("_start"))})
        else:
            own = slot(k, F.col("_start"))
            latest = latest.withColumns({"_level": F.lit(k), "_slot": F.explode(F.sequence(own + 1, own + PARTS + 1))})
        met = met.unionByName(latest)

    keys = F.array(*[F.struct(F.lit(k).alias("level"), slot(k).alias("slot")) for k in range(LEVELS)])
    ends = seen.where(F.col(event) == end).withColumn("_end", F.explode(keys))
    same = (F.col("_end.level") == F.col("_level")) & (F.col("_end.slot") == F.col("_slot"))
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    reach = F.col(time) - F.expr(f"INTERVAL {within}")
    return ends.join(met, same & (F.col("_at") <= F.col(time)) & (F.col("_at") >= reach) & (F.col("_start") >= F.unix_micros(reach)))


def nearest_start_stream(rows: DataFrame, by: Sequence[str], begin: str, end: str, within: str, unique: str, event: str = "event_type",
                         time: str = "_time", delay: str = "1 hour") -> DataFrame:
    """`nearest_starts` on a stream: ends joined with starts of their series in the interval `within` before them, of which
    the latest counts. `unique` tells ends apart. State: rows of the last `within` and `delay`, and the latest start of each slot (`start_candidates`).
    """
    pairs = start_candidates(rows, by, begin, end, within, event, time, delay)
    kept = [c for c in rows.columns if c not in (unique, time)]
    latest = pairs.groupBy(unique, time).agg(F.timestamp_micros(F.max("_start")).alias("start_time"), *[F.any_value(c).alias(c) for c in kept])
    return latest.select(*rows.columns, "start_time", seconds_between("start_time", time))
