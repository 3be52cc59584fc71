"""Tables that streams keep up to date, against the batch operators, over several starts and with late rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plantspark.operators import neighbours, series
from plantspark.sources import snapshots, tables
from plantspark.streaming import ingest, live

T0 = datetime(2024, 1, 1)
COLUMNS = "event_id bigint, _time timestamp, machine string, event_type string, _value double"


def mean():
    return [F.avg("_value").alias("_value"), F.count("_value").alias("n")]


def rows_of(spark, batch):
    return spark.createDataFrame([(i, T0 + timedelta(seconds=s), m, e, v) for i, s, m, e, v in batch], COLUMNS)


def fed(spark, root, batches, start):
    """Stores one more file for each batch and starts the stream again."""
    for k, batch in enumerate(batches):
        rows_of(spark, batch).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        start(stream, k).awaitTermination()
    return spark.read.schema(COLUMNS).parquet(f"{root}/in")


def same(a, b):
    a, b = (sorted(map(str, x.collect())) for x in (a, b))
    return a == b


def windows_of(spark, root):
    found = tables.read_windows(spark, root, "means")
    return sorted((r["machine"], r["_time"], r["_value"], r["n"]) for r in found.collect())


BATCHES = [
    [(1, 100, "a", "x", 1.0), (2, 3000, "a", "x", 3.0), (3, 100_000, "b", "x", 4.0)],
    [(4, 100_100, "a", "x", 5.0), (5, 200, "a", "x", 8.0)],  # the second is a day late
    [(6, 190_000, "a", "x", 7.0), (7, 99_000, "b", "x", 9.0), (8, 300, "c", "x", 2.0)],
    [(9, 190_001, "b", "x", 1.0)],
]


def test_windows_are_there_while_open_and_repaired_when_late(spark, root):
    def both(stream, k):
        live.live_windows(stream, ["machine"], "1 hour", mean(), root, "means", f"{root}/a", every=None).awaitTermination()
        if k == 0:
            assert len(windows_of(spark, root)) == 2  # the newest window included
        return live.note_late(stream, "1 hour", root, "late", f"{root}/b", every=None)

    table = fed(spark, root, BATCHES, both)
    expected = series.window_aggregate(table, ["machine"], "1 hour", mean())
    whole = sorted((r["machine"], r["_time"], r["_value"], r["n"]) for r in expected.collect())
    assert windows_of(spark, root) != whole
    state = snapshots.state(spark, f"{root}/late")
    assert set(state.days) <= {"2024-01-01", "2024-01-02"}
    days = live.repair_windows(table, ["machine"], "1 hour", mean(), root, "means", "late")
    assert windows_of(spark, root) == whole and days == sorted(state.days)
    assert live.repair_windows(table, ["machine"], "1 hour", mean(), root, "means", "late") == []


def test_a_record_that_comes_during_a_repair_stays(spark, root, monkeypatch):
    late = spark.createDataFrame([(T0, T0 + timedelta(hours=1), 1, T0.date())], "start timestamp, stop timestamp, rows long, window_date date")
    snapshots.add_batch(late, f"{root}/late", "r", 0, "window_date")
    merge, table = tables.merge_rows, rows_of(spark, [(1, 10, "a", "x", 1.0), (2, 20, "a", "x", 5.0), (3, 90_000, "a", "x", 5.0)])

    def meanwhile(*args):
        snapshots.add_batch(late, f"{root}/late", "r", 1, "window_date")
        return merge(*args)

    monkeypatch.setattr(live, "merge_rows", meanwhile)
    assert live.repair_windows(table, ["machine"], "1 hour", mean(), root, "means", "late") == ["2024-01-01"]
    assert windows_of(spark, root) == [("a", T0 + timedelta(hours=1), 3.0, 2)]
    assert len(snapshots.state(spark, f"{root}/late").days["2024-01-01"]) == 1
    assert tables.merge_rows(late.limit(0), root, "none", ["start"], "window_date") == []


@pytest.mark.parametrize("seed", [1, 2])
def test_last_rows_after_each_batch(spark, root, seed):
    draw, seen = random.Random(seed), []
    batches = [[(k * 50 + i, draw.randrange(50_000), draw.choice(["a", "a", "b", "c", None]), "x", draw.random()) for i in range(30)] for k in range(3)]
    batches[2].append((9999, 60_000, "late riser", "x", 0.5))

    def follow(stream, k):
        query = live.follow_last(stream, ["machine"], root, "last", f"{root}/checkpoint", every=None)
        query.awaitTermination()
        seen.extend(batches[k])
        assert same(live.last_rows(spark, root, "last").select("event_id", "machine"), series.last_by(rows_of(spark, seen), ["machine"]).select("event_id", "machine"))
        return query

    fed(spark, root, batches, follow)
    # a batch that is given again changes nothing
    before = live.last_rows(spark, root, "last").collect()
    live.follow_last(spark.readStream.schema(COLUMNS).parquet(f"{root}/in"), ["machine"], root, "last", f"{root}/other", every=None).awaitTermination()
    assert sorted(map(str, live.last_rows(spark, root, "last").collect())) == sorted(map(str, before))


POINT = "n bigint, _time timestamp, machine string, temperature double, status string"


def test_points_merge_over_batches_in_one_state(spark, root):
    batches = [
        [(1, 10, "a", 1.0, None), (2, 10, "a", None, "on")] + [(3, 20, "hot", 5.0, "x")] * 300,
        [(4, 10, "a", 2.0, None), (5, 10, "a", None, None), (6, 30, "b", None, "off")] + [(7, 20, "hot", 5.0, None)] * 300,
        [(8, 30, "b", 7.0, None), (9, 90_000, "end", 0.0, None)],
        [(10, 90_001, "end", 0.0, None)],
    ]
    progress = []
    for batch in batches:
        rows = spark.createDataFrame([(n, T0 + timedelta(seconds=s), m, t, x) for n, s, m, t, x in batch], POINT)
        rows.repartition(3).write.mode("append").parquet(f"{root}/in")
        points = live.merged_points(spark.readStream.schema(POINT).parquet(f"{root}/in"), ["machine", "_time"], ["n"])
        query = ingest.start(points.writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/checkpoint", every=None)
        query.awaitTermination()
        progress += [p for p in query.recentProgress if p["numInputRows"]]
    table = spark.read.schema(POINT).parquet(f"{root}/in")
    expected = series.collapse_points(table, ["machine", "_time"], ["n"]).where(F.col("machine") != "end")
    assert same(spark.read.parquet(f"{root}/out").select(*expected.columns), expected)
    assert all(len(p["stateOperators"]) == 1 and p["stateOperators"][0]["numRowsTotal"] <= 5 for p in progress)


def plain_nearest(rows, within):
    out = []
    for i, s, m, e, v in rows:
        starts = [t for _, t, n, f, _ in rows if f == "start" and n == m and t <= s and t >= s - within]
        if e == "end" and starts:
            out.append((i, max(starts), float(s - max(starts))))
    return sorted(out)


def pairs_in(found):
    return sorted((r["event_id"], int((r["start_time"] - T0).total_seconds()), r["seconds"]) for r in found.collect())


@pytest.mark.parametrize("width", [3_600_000_000, 50_000_000])
def test_nearest_starts_with_other_events_between(spark, width):
    draw = random.Random(4)
    rows = [(i, draw.randrange(20_000), draw.choice(["a", "a", "b", None]), draw.choice(["start", "end", "end", "x"]), 0.0) for i in range(400)]
    rows += [(500, 100, "c", "end", 0.0), (501, 90_000, "c", "end", 0.0), (502, 90_000, "c", "start", 0.0), (503, 170_000, "c", "end", 0.0)]
    chunking = neighbours.Chunking(width=width)
    for within, seconds in ((None, 10**9), ("30 minutes", 1800)):
        found = neighbours.nearest_starts(rows_of(spark, rows), ["machine"], "start", "end", within, chunking=chunking)
        assert pairs_in(found) == plain_nearest(rows, seconds)
    assert neighbours.nearest_starts(rows_of(spark, rows[:1]).limit(0), ["machine"], "start", "end").count() == 0


def test_nearest_starts_on_a_stream(spark, root):
    draw = random.Random(5)
    rows = [(i, i * 60 + draw.randrange(1200), draw.choice(["a", "a", "b", None]), draw.choice(["start", "end", "x"]), 0.0) for i in range(300)]
    marks = [(9000, 10**6, "z", "end", 0.0), (9001, 10**6 + 1, "z", "start", 0.0)]

    def start(stream, _):
        pairs = live.nearest_start_stream(stream, ["machine"], "start", "end", "30 minutes", "event_id")
        return ingest.start(pairs.writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/checkpoint", every=None)

    fed(spark, root, [rows[:100], rows[100:200], rows[200:], marks], start)
    assert pairs_in(spark.read.parquet(f"{root}/out")) == plain_nearest(rows, 1800)


@pytest.mark.parametrize("parts", [2, 3, 32])
def test_ends_meet_few_starts_of_a_dense_series(spark, parts, monkeypatch):
    monkeypatch.setattr(live, "PARTS", parts)
    draw = random.Random(6)
    rows = [(i, draw.randrange(-3000, 6000), draw.choice("aaab"), draw.choice(["start", "end"]), 0.0) for i in range(4000)]
    rows += [(5000 + k, 20_000 + s, "c", e, 0.0) for k, (s, e) in enumerate([(0, "start"), (1799, "end"), (1800, "end"), (1801, "end"), (0, "end")])]
    found = live.start_candidates(rows_of(spark, rows), ["machine"], "start", "end", "30 minutes", "event_type", "_time", "1 hour")
    latest = found.groupBy("event_id", "_time").agg(F.timestamp_micros(F.max("_start")).alias("start_time"))
    latest = latest.withColumn("seconds", (F.unix_micros("_time") - F.unix_micros("start_time")) / 1e6)
    assert pairs_in(latest) == plain_nearest(rows, 1800)
    if parts == 32:  # there are about 200 starts in half an hour
        assert found.count() < 60 * sum(e == "end" for _, _, _, e, _ in rows)
