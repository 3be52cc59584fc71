"""Series operators on a stream: gaps, moving averages, start/end pairs.

They need rows in time order, which a stream does not have. So a watermarked window count over the
stream only finds out which time ranges are complete; for each newly closed range the batch operator
then runs over the table the stream reads. The state is one row per open window, whatever the number
of series or rows. The last rows of every series are kept as the history of the next range.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from plantspark.operators.neighbours import elapsed, moving_average, start_end_pairs
from plantspark.operators.quality import GAP_SECONDS
from plantspark.operators.series import limit_per_series, order_columns
from plantspark.sources.tables import days_of, delete, run_of, time_range
from plantspark.streaming.ingest import FLUSH_EVERY, start

OLD = "_old"


def _earlier(spark: SparkSession, root: str, run: str, before: int | None = None) -> list[int]:
    """Numbers of this run's batches that have left a history, from one listing."""
    names = days_of(spark, f"{root}/history", "batch")
    own = [int(n.rpartition("-")[2]) for n in names if n.rpartition("-")[0] == run]
    return sorted(n for n in own if before is None or n < before)


def _read(like: DataFrame, path: str) -> DataFrame:
    return like.sparkSession.read.schema(like.schema).parquet(path)


def _over(rows: DataFrame, old: DataFrame, operator: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """What the operator makes of new rows after old ones, and both together."""
    joined = rows.withColumn(OLD, F.lit(False)).unionByName(old.withColumn(OLD, F.lit(True)))
    return operator(joined).where(~F.col(OLD)).drop(OLD), joined.drop(OLD)


def follow_closed_ranges(stream: DataFrame, table: Callable[[], DataFrame], by: Sequence[str], history: int,
                         operator: Callable[[DataFrame], DataFrame], root: str, checkpoint: str,
                         range_width: str = "1 hour", delay: str = "1 hour", every: str | None = FLUSH_EVERY,
                         forget_after: str | None = None) -> StreamingQuery:
    """Runs `operator` over each closed range, with `history` earlier rows per series before it.

    `stream` and `table` read the same stored rows, `stream` as they arrive. The operator gets and
    must keep a column `_old` that marks the history; results for old rows were written before.

    Results and history are filed under the checkpoint's run and the batch, so a new checkpoint never
    replaces what an older one wrote. Only the history of the batch before is read, and older ones are
    deleted. With `forget_after` (an interval) a series that is silent for so long is dropped from the
    history: its next row counts as its first.
    """
    run_name = run_of(stream.sparkSession, checkpoint)
    delete(stream.sparkSession, f"{root}/result/batch={run_name}-rest")
    closed = (
        stream.withWatermark("_time", delay)
        .groupBy(F.window("_time", range_width).alias("range"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )

    def run(batch: DataFrame, batch_id: int) -> None:
        low, high = batch.agg(F.min("range.start"), F.max("range.end")).first()
        if low is None:
            return
        rows = table()
        spark, zone = rows.sparkSession, rows.schema["_time"].dataType
        fresh = time_range(rows, F.lit(low).cast(zone), F.lit(high).cast(zone))
        earlier = _earlier(spark, root, run_name, batch_id)
        old = _read(rows, f"{root}/history/batch={run_name}-{earlier[-1]}") if earlier else rows.limit(0)
        result, joined = _over(fresh, old, operator)
        result.hint("rebalance").write.mode("overwrite").parquet(f"{root}/result/batch={run_name}-{batch_id}")
        last = limit_per_series(joined, by, history, newest=True, order=order_columns(rows))
        if forget_after:
            last = last.where(F.col("_time") >= F.lit(high).cast(zone) - F.expr(f"INTERVAL {forget_after}"))
        last.hint("rebalance").write.mode("overwrite").parquet(f"{root}/history/batch={run_name}-{batch_id}")
        until = spark.createDataFrame([(high,)], "until timestamp")
        until.coalesce(1).write.mode("overwrite").parquet(f"{root}/until/batch={run_name}-{batch_id}")
        for number in earlier[:-1]:
            delete(spark, f"{root}/history/batch={run_name}-{number}")

    return start(closed.writeStream.foreachBatch(run).outputMode("append"), checkpoint, every)


def finish(table: Callable[[], DataFrame], operator: Callable[[DataFrame], DataFrame], root: str, checkpoint: str) -> None:
    """Writes the results of the ranges still open, once a finite input has been read to its end.

    With it the results are those of the batch operator over the whole table. A stream that goes on
    from the same checkpoint first deletes these results, and gives them again when the ranges close.
    """
    rows = table()
    spark, zone = rows.sparkSession, rows.schema["_time"].dataType
    run_name = run_of(spark, checkpoint)
    earlier, old = _earlier(spark, root, run_name), rows.limit(0)
    if earlier:
        old = _read(rows, f"{root}/history/batch={run_name}-{earlier[-1]}")
        until = spark.read.parquet(f"{root}/until/batch={run_name}-{earlier[-1]}").first()["until"]
        rows = rows.where(F.col("_time") >= F.lit(until).cast(zone))
    result, _ = _over(rows, old, operator)
    result.hint("rebalance").write.mode("overwrite").parquet(f"{root}/result/batch={run_name}-rest")


def gaps_over(by: Sequence[str], longer_than: int = GAP_SECONDS) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: elapsed(rows, by).where(F.col("elapsed") > longer_than)


def means_over(by: Sequence[str], n: int, value: str = "_value") -> Callable[[DataFrame], DataFrame]:
    return lambda rows: moving_average(rows, by, n, value, whole_series=False)


def pairs_over(by: Sequence[str], begin: str, end: str) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: start_end_pairs(rows, by, begin, end)


def gap_stream(stream: DataFrame, table: Callable[[], DataFrame], by: Sequence[str], root: str, checkpoint: str,
               longer_than: int = GAP_SECONDS, **options) -> StreamingQuery:
    """Rows that follow the one before by more than `longer_than` seconds."""
    return follow_closed_ranges(stream, table, by, 1, gaps_over(by, longer_than), root, checkpoint, **options)


def moving_average_stream(stream: DataFrame, table: Callable[[], DataFrame], by: Sequence[str], n: int, root: str,
                          checkpoint: str, value: str = "_value", **options) -> StreamingQuery:
    """Moving average of the last n values, from the n-th row of a series on."""
    return follow_closed_ranges(stream, table, by, n - 1, means_over(by, n, value), root, checkpoint, **options)


def pair_stream(stream: DataFrame, table: Callable[[], DataFrame], by: Sequence[str], begin: str, end: str,
                root: str, checkpoint: str, **options) -> StreamingQuery:
    """End events directly preceded by their start event."""
    return follow_closed_ranges(stream, table, by, 1, pairs_over(by, begin, end), root, checkpoint, **options)


def results(table_root: str, like: DataFrame) -> DataFrame:
    """Everything written so far."""
    return like.sparkSession.read.parquet(f"{table_root}/result").drop("batch")
