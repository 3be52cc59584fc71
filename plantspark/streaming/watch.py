"""What streams did, kept in a table: every batch, and why a stream ended."""

from __future__ import annotations

import threading
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.listener import QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent, StreamingQueryListener

from plantspark.schemas import STREAM_LOG
from plantspark.sources.tables import append_batch

#: Events that wait before they are written together; the end of a stream is written at once.
TOGETHER = 100
#: Characters of an error that are kept.
ERROR_TEXT = 2000


class Watch(StreamingQueryListener):
    """Files the progress and the failures of the streams of a session in the table `stream_log` under `root`.

        watch = Watch(spark, root).attach()
        ...
        watch.detach()          # writes what still waits

    A batch without rows leaves nothing. Every object is a run of its own in the table.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.run, self.number = spark, root, f"w{uuid4().hex}", 0
        self.names: dict[str, str] = {}
        self.waiting: list[tuple] = []
        self.lock, self.ended = threading.RLock(), threading.Condition()
        self.finished: set[str] = set()

    def attach(self) -> Watch:
        self.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self.spark.streams.removeListener(self)
        self.write()

    def wait_for(self, run_id: str, seconds: float = 60) -> bool:
        """Whether the end of a stream has been filed; events come a little after the stream has ended."""
        with self.ended:
            return self.ended.wait_for(lambda: str(run_id) in self.finished, seconds)

    def _add(self, *values) -> None:
        with self.lock:
            self.waiting.append((datetime.now(timezone.utc), *values))
            if len(self.waiting) >= TOGETHER:
                self.write()

    def write(self) -> None:
        with self.lock:
            if self.waiting:
                append_batch(self.spark.createDataFrame(self.waiting, STREAM_LOG), self.root, "stream_log", self.number, run=self.run)
                self.number, self.waiting = self.number + 1, []

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        self.names[str(event.runId)] = event.name or str(event.id)

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        p = event.progress
        if p.numInputRows:
            name = self.names.get(str(p.runId), p.name or str(p.id))
            self._add(name, str(p.runId), "batch", p.batchId, p.numInputRows, p.processedRowsPerSecond, p.batchDuration, None)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        run, error = str(event.runId), event.exception
        self._add(self.names.pop(run, str(event.id)), run, "failed" if error else "ended", None, None, None, None, error and error[:ERROR_TEXT])
        self.write()
        with self.ended:
            self.finished.add(run)
            self.ended.notify_all()


def write_report(log: DataFrame) -> DataFrame:
    """Per stream: batches and rows written, write errors, when it last wrote and what its last error was."""
    done = F.col("kind") == "batch"
    return log.groupBy("query").agg(
        F.count_if(done).alias("batches"),
        F.coalesce(F.sum(F.when(done, F.col("rows"))), F.lit(0)).alias("rows_written"),
        F.count_if(F.col("kind") == "failed").alias("write_errors"),
        F.max(F.when(done, F.col("_time"))).alias("last_write_time"),
        F.max_by("error", F.when(F.col("kind") == "failed", F.col("_time"))).alias("last_error"),
    )
