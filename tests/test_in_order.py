"""Ordered streams: results come when the watermark has passed a row, and are those of the batch operators."""

import random
from datetime import datetime, timedelta

from pyspark.sql import Row, functions as F, types as T

from plantspark.operators import neighbours, quality
from plantspark.streaming import in_order, ingest

T0 = datetime(2024, 1, 1)
COLUMNS = "event_id bigint, _time timestamp, machine string, _value double"


def feed(spark, root, batches, make):
    """Results after each batch, which starts the stream again."""
    seen = []
    for batch in batches:
        rows = spark.createDataFrame([(i, T0 + timedelta(seconds=s), m, v) for i, s, m, v in batch], COLUMNS)
        rows.coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        with in_order.rocksdb(spark):
            query = ingest.start(make(stream).writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/checkpoint", every=None)
        query.awaitTermination()
        seen.append((sorted(r["event_id"] for r in spark.read.parquet(f"{root}/out").collect()), query.recentProgress))
    return spark.read.schema(COLUMNS).parquet(f"{root}/in"), seen


def same(a, b):
    a, b = (sorted(map(str, x.collect())) for x in (a, b))
    return a == b


def test_gaps_come_before_their_hour_has_closed(spark, root):
    batches = [
        [(1, 100, "a", 1.0), (3, 700, "a", 1.0), (2, 400, "a", 1.0), (4, 500, "b", 1.0)],
        [(5, 2000, "a", 1.0), (6, 720, "b", 1.0)],  # the watermark goes to 1400
        [(7, 2100, "b", 1.0), (8, 1990, "a", 1.0), (9, 900, "a", 1.0)],  # the last is late
        [(10, 10**6, "end", 1.0)],
    ]
    before = spark.conf.get(in_order.STORE[0], None)
    table, seen = feed(spark, root, batches, lambda s: in_order.gaps_on_arrival(s, ["machine"], 60, delay="10 minutes"))
    assert seen[1][0] == [2, 3, 6] and seen[3][0] == [2, 3, 6, 7, 8]  # in the second batch, at 2000 s: hour 0 is open
    expected = quality.gaps(table.where("event_id not in (9, 10)"), ["machine"], longer_than=60)
    assert same(spark.read.parquet(f"{root}/out").select(*expected.columns), expected)
    assert spark.conf.get(in_order.STORE[0], None) == before


def test_random_series_equal_the_batch(spark, root):
    draw = random.Random(3)
    rows = [(i, i * 20 + draw.randrange(500), draw.choice(["hot", "hot", "hot", "cold", None]), None if draw.random() < 0.1 else float(i % 17)) for i in range(360)]
    rows += [(1000 + i, 3000, "ties", float(i)) for i in range(12)]
    rows.sort(key=lambda r: r[0] if r[0] < 1000 else 150)
    batches = [rows[:120], rows[120:240], rows[240:], [(9999, 10**6, "end", 0.0)]]
    table, seen = feed(spark, root, batches, lambda s: in_order.means_on_arrival(s, ["machine"], 5, delay="10 minutes"))
    figure = lambda df: df.select("event_id", "machine", "_time", F.round("_value", 9).alias("v"))
    expected = neighbours.moving_average(table.where("event_id <> 9999"), ["machine"], 5, whole_series=False)
    assert same(figure(spark.read.parquet(f"{root}/out")), figure(expected))
    last = [p for _, ps in seen for p in ps if p["stateOperators"]][-1]["stateOperators"][0]
    assert last["numRowsTotal"] <= 4 * (4 + 3) + 4  # of each series the last rows and two marks; what waits is gone


class Held:
    """State of one series, and the most rows that were read from it at a time."""

    def __init__(self):
        self.chunks, self.value, self.timers, self.reads = {}, None, [], []

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        return Mark()

    def exists(self):
        return bool(self.chunks)

    def keys(self):
        return iter(list(self.chunks))

    def getValue(self, key):
        self.reads.append(key[0])
        return self.chunks[key]

    def updateValue(self, key, value):
        self.chunks[key] = value

    def removeKey(self, key):
        del self.chunks[key]

    def registerTimer(self, at):
        self.timers.append(at)


class Mark:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Clock:
    def __init__(self, millis):
        self.millis = millis

    def getCurrentWatermarkInMs(self):
        return self.millis


def test_a_long_wait_is_handed_on_slot_by_slot():
    layout = T.StructType([T.StructField("event_id", T.LongType()), T.StructField(in_order.MICROS, T.LongType())])
    sizes = []

    def operator(before, new):
        sizes.append(len(new))
        return [(r["event_id"], r[in_order.MICROS], before[-1]["event_id"] if before else None) for r in new[:1]]

    result = T.StructType([*layout.fields, T.StructField("before", T.LongType())])
    processor, held = in_order.InOrder(layout, [in_order.MICROS, "event_id"], 1, operator, result), Held()
    processor.init(held)
    ids = list(range(2000))
    random.Random(1).shuffle(ids)
    make = Row("event_id", in_order.MICROS)
    processor.handleInputRows(("a",), iter([make(i, i * 10_000_000) for i in ids]), Clock(0))
    found = list(processor.handleExpiredTimer(("a",), Clock(15_005_000), None))
    assert sum(sizes) == 1501 and max(sizes) == in_order.SLOT // 10_000_000 == 360
    assert [(r["event_id"], r["before"]) for r in found] == [(i, i - 1 if i else None) for i in range(0, 1501, 360)]
    assert held.timers[-1] == 15_010_001
    processor.handleInputRows(("a",), iter([make(5000, 15_004_000_000), make(5001, 15_006_000_000)]), Clock(15_005_000))
    sizes.clear()
    list(processor.handleExpiredTimer(("a",), Clock(10**8), None))
    assert sum(sizes) == 500 and not held.chunks  # 499 that were left and one of the new; the other came too late
