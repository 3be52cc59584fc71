"""Continuous ingestion: messages to measurement tables, alerts and rejects."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from plantspark.functions.rules import DEFAULTS, Thresholds
from plantspark.operators import normalise
from plantspark.operators.alerts import alerts
from plantspark.operators.rollups import message_stats
from plantspark.sources.messages import decode, route, subscribed
from plantspark.sources.tables import append_batch, run_of

FLUSH_EVERY = "5 seconds"
#: Tasks per core that the messages of a batch are dealt to.
TASKS_A_CORE = 4


def checked(messages: DataFrame, deposit_as_piece: bool = True) -> DataFrame:
    """Messages with parsed body, kind and the reason why they are refused, if any."""
    return normalise.check(route(decode(messages), deposit_as_piece))


def spread(messages: DataFrame) -> DataFrame:
    """Deals messages evenly over the cores: decoding is most of the work, and a backlog may lie in few files or row groups."""
    return messages.repartition(TASKS_A_CORE * messages.sparkSession.sparkContext.defaultParallelism)


def outputs(rows: DataFrame, limits: Thresholds = DEFAULTS) -> Iterator[tuple[str, DataFrame, str]]:
    """(table, rows, time column) for everything one batch of checked messages leads to."""
    readings = normalise.sensor_readings(rows, limits)
    yield "sensor_data", readings, "_time"
    yield "machine_events", normalise.machine_events(rows), "_time"
    yield "piece_tracking", normalise.piece_movements(rows), "_time"
    yield "alerts", alerts(readings), "_time"
    yield "rejects", normalise.rejects(rows), "arrived_at"


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = FLUSH_EVERY) -> StreamingQuery:
    """Starts a stream; without an interval it takes what is there and stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def ingest(messages: DataFrame, root: str, checkpoint: str, every: str | None = FLUSH_EVERY,
           limits: Thresholds = DEFAULTS, deposit_as_piece: bool = True, topics: Sequence[str] | None = None,
           name: str | None = None) -> StreamingQuery:
    """Stores every micro-batch under the name of its run and its batch id.

    topics: patterns of the topics to take (`messages.TOPICS` are those of a plant); others are dropped unread. Without patterns, messages
    on a topic that nobody handles are counted and filed as rejects. name: of the stream, as `watch` files it.

    A batch that is replayed after a failure replaces its own files, so nothing is lost or doubled; a
    job with a new checkpoint is a new run and adds to what is there.
    Running counters are reported as the observed metrics `ingest` of each batch, and every batch whose
    tables are written leaves its statistics in `pipeline_stats`.
    """
    wanted = messages if topics is None else subscribed(messages, list(topics))
    rows = checked(spread(wanted), deposit_as_piece)
    counted = rows.observe(
        "ingest",
        F.count_if(F.col("kind") != "bad_json").alias("received"),
        F.count_if(F.col("reason").isNull()).alias("processed"),
        F.count_if(F.col("reason").isNotNull() & ~F.col("reason").isin("bad_json", "unknown_topic")).alias("errors"),
    )

    run = run_of(messages.sparkSession, checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        parts = list(outputs(batch, limits))
        try:
            batch.count()  # decodes once; writes that begin together would wait for each other's messages, or decode them again elsewhere
            with ThreadPoolExecutor(len(parts)) as pool:
                writes = [pool.submit(append_batch, rows, root, name, batch_id, time, run) for name, rows, time in parts]
            for write in writes:
                write.result()
            stats = message_stats(batch).withColumn("_time", F.col("last_message_at")).where("_time is not null")
            append_batch(stats, root, "pipeline_stats", batch_id, "_time", run)
        finally:
            batch.unpersist()

    writer = counted.writeStream.foreachBatch(store)
    return start(writer.queryName(name) if name else writer, checkpoint, every)


def store_stream(rows: DataFrame, root: str, table: str, checkpoint: str, time: str = "_time", every: str | None = FLUSH_EVERY,
                 name: str | None = None) -> StreamingQuery:
    """Stores a stream of rows of one measurement table, such as the figures of hosts (`normalise.system_samples`)."""
    run = run_of(rows.sparkSession, checkpoint)
    writer = rows.writeStream.foreachBatch(lambda batch, number: append_batch(batch, root, table, number, time, run))
    return start(writer.queryName(name) if name else writer, checkpoint, every)


def alerts_stream(readings: DataFrame, path: str, checkpoint: str, every: str | None = FLUSH_EVERY,
                  extra: list[str] | None = None) -> StreamingQuery:
    """Alerts of a stream of readings with their anomalies, written as they arrive."""
    writer = alerts(readings, extra).writeStream.format("parquet").option("path", path)
    return start(writer.outputMode("append"), checkpoint, every)
