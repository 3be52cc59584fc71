"""Series operators on a stream whose results come as soon as the watermark has passed a row, not when a range of time has closed.

Rows wait in the state of their series until no earlier row can come any more; a timer then hands them on in order, with
the last rows before them. So the state of a series is its last rows and what came within the delay. What waits is kept in chunks of the rows
of one SLOT of time, and slots are handed on one after the other: a task holds the rows of a slot, however many have come. Rows that come later than that
are left out, as in every watermarked stream (`live.note_late` records their windows).
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from itertools import groupby, islice

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from plantspark.operators.quality import GAP_SECONDS
from plantspark.operators.series import order_columns

#: Timers and arbitrary state need this store.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
MICROS = "_micros"
#: Microseconds of a slot; new rows that are dealt to their slots at a time.
SLOT, DEALT = 3_600_000_000, 400_000

#: The rows before and the new rows of a series, in order; the results of the new ones.
Operator = Callable[[list[Row], list[Row]], Iterable[tuple]]


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB; the session's own setting comes back afterwards."""
    before = spark.conf.get(STORE[0], None)
    spark.conf.set(*STORE)
    try:
        yield
    finally:
        spark.conf.unset(STORE[0]) if before is None else spark.conf.set(STORE[0], before)


class InOrder(StatefulProcessor):
    """order: names of columns that sort a series, MICROS first. history: rows that the operator sees before the new ones."""

    def __init__(self, layout: T.StructType, order: Sequence[str], history: int, operator: Operator, result: T.StructType):
        self.layout, self.order, self.history, self.operator, self.result = layout, list(order), history, operator, result

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # a chunk: rows of a slot, in no order; `first` is the time of its earliest row
        self.waiting = handle.getMapState("waiting", "slot long, number long, first long", "rows binary")
        self.mark = handle.getValueState("mark", "passed long, chunks long, before binary")
        self.micros, self.places = self.layout.names.index(MICROS), [self.layout.names.index(c) for c in self.order]
        self.row_of, self.result_of = Row(*self.layout.names), Row(*self.result.names)

    def _rank(self, row: tuple) -> tuple:
        return tuple((True, row[i]) if row[i] is not None else (False, 0) for i in self.places)

    def _marks(self) -> tuple[int | None, int, list[tuple]]:
        """How far rows have been handed on, the number of chunks so far, the last rows handed on."""
        passed, chunks, before = self.mark.get() if self.mark.exists() else (None, 0, None)
        return passed, chunks, pickle.loads(before) if before else []

    def _keep(self, slot: int, number: int, rows: list[tuple]) -> int:
        first = min(r[self.micros] for r in rows)
        self.waiting.updateValue((slot, number, first), (pickle.dumps(rows),))
        return first

    def _wake(self, first: int, timerValues) -> None:
        self.handle.registerTimer(max(first // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1))

    def handleInputRows(self, key, rows, timerValues):
        passed, chunks, before = self._marks()
        names, micros = self.layout.names, self.micros
        plain = (tuple(r[c] for c in names) for r in rows)
        new = (r for r in plain if passed is None or r[micros] > passed)
        first = None
        while some := list(islice(new, DEALT)):
            slots: dict[int, list[tuple]] = {}
            for row in some:
                slots.setdefault(row[micros] // SLOT, []).append(row)
            for slot, own in slots.items():
                earliest = self._keep(slot, chunks, own)
                first = earliest if first is None else min(first, earliest)
                chunks += 1
        if first is not None:
            self.mark.update((passed, chunks, pickle.dumps(before)))
            self._wake(first, timerValues)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        keys = sorted(tuple(k) for k in self.waiting.keys()) if self.waiting.exists() else []
        due = [k for k in keys if k[2] <= upto]
        if not due:
            return
        firsts = [k[2] for k in keys if k[2] > upto]
        _, chunks, before = self._marks()
        for slot, own in groupby(due, key=lambda k: k[0]):
            rows: list[tuple] = []
            for k in own:
                rows += pickle.loads(self.waiting.getValue(k)[0])
                self.waiting.removeKey(k)
            left = [r for r in rows if r[self.micros] > upto]
            if left:
                firsts.append(self._keep(slot, chunks, left))
                chunks += 1
            ready = sorted((r for r in rows if r[self.micros] <= upto), key=self._rank)
            del rows, left
            history = [self.row_of(*r) for r in before]
            before = (before + ready)[-self.history :]
            for out in self.operator(history, [self.row_of(*r) for r in ready]):
                yield self.result_of(*out)
        self.mark.update((upto, chunks, pickle.dumps(before)))
        if firsts:
            self._wake(min(firsts), timerValues)

    def close(self) -> None:
        pass


def in_order(rows: DataFrame, by: Sequence[str], history: int, operator: Operator, result: T.StructType, delay: str = "1 hour",
             time: str = "_time", order: Sequence[str] | None = None) -> DataFrame:
    """Results of `operator` for the rows of each series in their order. Its results have the layout `result`; a row's time is its column MICROS.

    Start the query inside `rocksdb(spark)`."""
    names = [MICROS, *(c for c in (order or order_columns(rows, time)) if c != time)]
    marked = rows.withWatermark(time, delay).withColumn(MICROS, F.unix_micros(F.col(time).cast("timestamp")))
    layout = T.StructType([f for f in marked.schema if f.name != time])
    processor = InOrder(layout, names, history, operator, result)
    return marked.groupBy(*by).transformWithState(processor, result, "Append", "EventTime")


def _with_time(found: DataFrame, columns: Sequence[str], time: str) -> DataFrame:
    return found.withColumn(time, F.timestamp_micros(MICROS)).select(*columns)


def gaps_on_arrival(rows: DataFrame, by: Sequence[str], longer_than: int = GAP_SECONDS, delay: str = "1 hour", time: str = "_time") -> DataFrame:
    """Rows that follow the one before in their series by more than `longer_than` seconds, with `elapsed`."""
    kept = [f for f in rows.schema if f.name != time]
    names = [f.name for f in kept]

    def gaps(before: list[Row], new: list[Row]) -> Iterator[tuple]:
        last = before[-1][MICROS] if before else None
        for row in new:
            now = row[MICROS]
            if last is not None and (elapsed := (now - last) // 1_000_000) > longer_than:
                yield (*(row[c] for c in names), now, elapsed)
            last = now

    result = T.StructType([*kept, T.StructField(MICROS, T.LongType()), T.StructField("elapsed", T.LongType())])
    return _with_time(in_order(rows, by, 1, gaps, result, delay, time), [*rows.columns, "elapsed"], time)


def means_on_arrival(rows: DataFrame, by: Sequence[str], n: int, value: str = "_value", delay: str = "1 hour", time: str = "_time") -> DataFrame:
    """The mean of the last n values of the series in the place of each value, from the n-th row on; rows without a value do not count."""
    present = rows.where(F.col(value).isNotNull())
    kept = [f for f in rows.schema if f.name != time]
    names = [f.name for f in kept]

    def means(before: list[Row], new: list[Row]) -> Iterator[tuple]:
        last = before[-(n - 1) :] if n > 1 else []
        for row in new:
            last = [*last, row][-n:]
            if len(last) == n:
                mean = sum(r[value] for r in last) / n
                yield (*(mean if c == value else row[c] for c in names), row[MICROS])

    result = T.StructType([*kept, T.StructField(MICROS, T.LongType())])
    return _with_time(in_order(present, by, max(1, n - 1), means, result, delay, time), rows.columns, time)
