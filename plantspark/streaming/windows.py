"""Streaming tumbling windows and distinct points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from plantspark.operators.series import window_aggregate
from plantspark.streaming.ingest import FLUSH_EVERY, start


def window_stream(rows: DataFrame, by: Sequence[str], window: str, aggregates: Sequence[Column], path: str,
                  checkpoint: str, delay: str = "1 hour", every: str | None = FLUSH_EVERY) -> StreamingQuery:
    """Writes each window once, when the watermark has passed its end.

    Rows more than `delay` late are left out here; they are in the measurement table, from which
    the batch rollup of that range makes the final figures.
    """
    windows = window_aggregate(rows.withWatermark("_time", delay), by, window, aggregates)
    writer = windows.writeStream.outputMode("append").format("parquet").option("path", path)
    return start(writer, checkpoint, every)


def distinct_points(rows: DataFrame, key: Sequence[str], delay: str = "1 hour") -> DataFrame:
    """Drops exact copies of a point that arrive within the delay; the state forgets keys after it.

    A third of all rows may be copies of one point. They are first dropped per key and reading task,
    so that the last step gets at most one copy from each task.
    """
    marked = rows.withWatermark("_time", delay).withColumn("_task", F.spark_partition_id())
    per_task = marked.dropDuplicatesWithinWatermark([*key, "_task"]).drop("_task")
    return per_task.dropDuplicatesWithinWatermark(list(key))
