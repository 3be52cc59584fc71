"""Measurement tables: scanning by time, idempotent appends and overwrites, retention."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plantspark.functions.panels import RANGE_PRESETS
from plantspark.schemas import RETENTION_DAYS, TABLES
from plantspark.sources import snapshots
from plantspark.sources.snapshots import delete, folder_of as _folder


def stamp(df: DataFrame, moment: datetime | str, time: str = "_time") -> Column:
    """A literal of the time column's own type, so that comparisons reach the Parquet scan."""
    return F.lit(str(moment)).cast(df.schema[time].dataType)


def bounds(df: DataFrame, as_of: datetime | str, lookback: str, lag: str | None = None,
           time: str = "_time") -> tuple[Column, Column]:
    """Start and stop of `lookback` up to `as_of`, or up to `lag` before it.

    The lookback is an interval such as `24 hours`, or one of the presets such as `24h`.
    """
    now = stamp(df, as_of, time)
    stop = now - F.expr(f"INTERVAL {lag}") if lag else now
    return now - F.expr(f"INTERVAL {RANGE_PRESETS.get(lookback, lookback)}"), stop


def time_range(df: DataFrame, start: Column, stop: Column, time: str = "_time") -> DataFrame:
    """Rows with start <= time < stop; also prunes `event_date` partitions where the table has them."""
    rows = df.where((F.col(time) >= start) & (F.col(time) < stop))
    if "event_date" in df.columns:
        rows = rows.where(F.col("event_date").between(start.cast("date"), stop.cast("date")))
    return rows


def recent(df: DataFrame, as_of: datetime | str, lookback: str, time: str = "_time") -> DataFrame:
    """Rows of the `lookback` before `as_of`."""
    return time_range(df, *bounds(df, as_of, lookback, time=time), time=time)


def stored_layout(name: str) -> T.StructType:
    """Declared columns of a table and the day its files lie under."""
    return T.StructType([*TABLES[name].fields, T.StructField("event_date", T.DateType())])


def read_table(spark: SparkSession, root: str, name: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """A measurement table with its declared columns and `event_date`, also while nothing has been written.

    first, last: days outside are not even listed. What is read is one state of the table, whatever is written meanwhile.
    """
    layout, path = stored_layout(name), f"{root}/{name}"
    now = snapshots.state(spark, path)
    days = [d for d in now.days if (first is None or d >= first) and (last is None or d <= last)]
    found = snapshots.read(spark, path, "event_date", layout, days, now)
    return spark.createDataFrame([], layout) if found is None else found


def read_windows(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A rollup table with `window_date`: one state of it, whatever is merged meanwhile. None before its first window."""
    return snapshots.read(spark, f"{root}/{name}", "window_date")


def folders_of(spark: SparkSession, root: str, name: str) -> dict[str, int]:
    """In how many folders each day of a table lies."""
    return {day: len(versions) for day, versions in sorted(snapshots.state(spark, f"{root}/{name}").days.items())}


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """Name of the job that owns a checkpoint: made on first use and kept in it.

    Micro-batches are numbered from 0 in every checkpoint, so only both together name a batch.
    """
    path = f"{checkpoint}/run"
    folder, files = _folder(spark, path)
    kept = [r.value for r in spark.read.text(path).collect()] if files.exists(folder) else []
    if kept:
        return kept[0]
    name = f"r{uuid.uuid4().hex}"
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return name


def append_batch(rows: DataFrame, root: str, name: str, batch_id: int, time: str = "_time", run: str = "r0") -> None:
    """Adds one micro-batch of a run, in the place of what an earlier try of it left.

    Batches of other runs are never touched. Readers see all of a batch or nothing. `compact` rewrites days that many batches
    have added to; a batch whose rows it has taken in is stored for good.
    """
    snapshots.add_batch(rows.withColumn("event_date", F.to_date(time)), f"{root}/{name}", run, batch_id, "event_date")


def compact(spark: SparkSession, root: str, name: str, most: int = 1) -> list[str]:
    """Rewrites the days of a measurement table that lie in over `most` folders into few files each; the days rewritten."""
    return snapshots.compact(spark, f"{root}/{name}", "event_date", stored_layout(name), most)


def days_of(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the outer partition column that a table holds: as its state says, or from one listing of a plain folder."""
    now = snapshots.state(spark, path)
    if now.number >= 0:
        return sorted(day for day in now.days if not day.endswith("__"))
    names = snapshots.names_in(spark, path)
    return sorted(name.split("=")[1] for name in names if name.startswith(f"{column}=") and not name.endswith("__"))


def merge_windows(rows: DataFrame, root: str, name: str, start: Column, stop: Column, time: str = "_time",
                  lock_seconds: float = 6 * 3600, tries: int = 3) -> None:
    """Replaces the windows of start..stop in a rollup table, so that a second run changes nothing.

    A window is filed under the day before its end. Only the days of the range are read and written,
    and their other windows are kept. Readers (`read_windows`) have the windows before or after the merge, never some of each.
    A second merge into the same table is refused while one runs; the lock of a job that died ends after `lock_seconds`.
    A merge that finds its days changed by a job that outlived its lock is made again.
    """
    spark, path = rows.sparkSession, f"{root}/{name}"
    inside = F.col(time) - F.expr("INTERVAL 1 MICROSECOND")
    filed = rows.withColumn("window_date", F.to_date(inside))
    top, files = _folder(spark, root)
    files.mkdirs(top)
    first, last = spark.range(1).select(F.to_date(start).cast("string"), F.to_date(stop).cast("string")).first()
    with snapshots.Lock(spark, f"{root}/{name}.lock", lock_seconds):
        for left in reversed(range(tries)):
            base = snapshots.state(spark, path)
            days = [day for day in base.days if first <= day <= last]
            old, merged = snapshots.read(spark, path, "window_date", None, days, base), filed
            if old is not None:
                kept = old.where((F.col(time) <= start) | (F.col(time) > stop))
                merged = filed.unionByName(kept, allowMissingColumns=True)
            try:
                snapshots.replace_days(merged, path, "window_date", base, days)
                return
            except snapshots.Changed:
                if not left:
                    raise


def merge_rows(rows: DataFrame, root: str, name: str, keys: Sequence[str], column: str, tries: int = 10) -> list[str]:
    """Puts rows in the place of those of equal keys in a versioned table, and adds the others. `column` names the part (a day, a shard) that a
    row lies in, which follows from its keys; it is in the rows. Only parts with new rows are read and written, and
    readers see all of the change or nothing. Doing it again changes nothing. Returns the parts written."""
    spark, path = rows.sparkSession, f"{root}/{name}"
    rows = rows.withColumn(column, F.col(column).cast("string"))
    parts = [r[0] for r in rows.select(column).distinct().collect()]
    if not parts:
        return []
    for left in reversed(range(tries)):
        base = snapshots.state(spark, path)
        old, merged = snapshots.read(spark, path, column, None, parts, base), rows
        if old is not None:
            old = old.withColumn(column, F.col(column).cast("string")).alias("old")
            same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in (*keys, column)]
            kept = old.join(rows.select(*keys, column).alias("new"), reduce(lambda a, b: a & b, same), "left_anti")
            merged = rows.unionByName(kept, allowMissingColumns=True)
        try:
            snapshots.replace_days(merged, path, column, base, parts)
            return sorted(parts)
        except snapshots.Changed:
            if not left:
                raise
    return []


def read_parts(spark: SparkSession, root: str, name: str, column: str, like: T.StructType | None = None) -> DataFrame | None:
    """A table that `merge_rows` keeps, one state of it; without its first row nothing, or an empty table of the given layout."""
    found = snapshots.read(spark, f"{root}/{name}", column)
    return spark.createDataFrame([], like) if found is None and like else found


def retained(df: DataFrame, store: str, as_of: datetime | str, time: str = "_time") -> DataFrame:
    """Rows still inside the store's retention."""
    rows = df.where(F.col(time) >= stamp(df, as_of, time) - F.expr(f"INTERVAL {RETENTION_DAYS[store]} DAYS"))
    if "event_date" in df.columns:
        first = (stamp(df, as_of, time) - F.expr(f"INTERVAL {RETENTION_DAYS[store]} DAYS")).cast("date")
        rows = rows.where(F.col("event_date") >= first)
    return rows


def expire_days(spark: SparkSession, table: str, store: str, as_of: date) -> list[str]:
    """Drops the whole days of a catalogue table, partitioned by `event_date`, that are past retention."""
    first = as_of - timedelta(days=RETENTION_DAYS[store])
    days = {row[0].split("/")[0].split("=")[1] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    expired = sorted(day for day in days if day < first.isoformat())
    for day in expired:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (event_date = '{day}')")
    return expired


def expire_stored_days(spark: SparkSession, root: str, name: str, store: str, as_of: date,
                       column: str = "event_date") -> list[str]:
    """Takes the whole days of a table under `root` that are past retention out of it; the days that went.

    Readers that have begun go on; `snapshots.clean` deletes the files when no kept state names them.
    """
    first = (as_of - timedelta(days=RETENTION_DAYS[store])).isoformat()
    return snapshots.drop_days(spark, f"{root}/{name}", lambda day: day < first)


def stored_names(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """Those of the named tables that have been written under a root."""
    found = [(name,) for name in names if snapshots.state(spark, f"{root}/{name}").number >= 0]
    return spark.createDataFrame(found, "name string")


def points(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    """A few `{tags, fields, time}` points as rows of a measurement table."""
    schema = TABLES[table]
    flat = [{"_time": p["time"], **p.get("tags", {}), **p.get("fields", {})} for p in rows]
    return spark.createDataFrame([tuple(p.get(f.name) for f in schema) for p in flat], schema)
