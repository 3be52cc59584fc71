"""Series operators against plain Python on small tables."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plantspark.operators import neighbours, series
from plantspark.operators.neighbours import Chunking
from plantspark.sources import tables

T0 = datetime(2024, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def table(spark, rows, columns="event_id bigint, _time timestamp, machine string, _value double"):
    return spark.createDataFrame(rows, columns)


@pytest.fixture(scope="module")
def skewed(spark):
    """One machine with most rows, many of them within one second and some at one instant; one with
    rows hours apart; one with very few; one without a name."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        rows.append((i, at(3600 + rng.random()), "hot"))
    for i in range(400, 460):
        rows.append((i, at(7200), "hot"))
    for i in range(460, 700):
        rows.append((i, at(rng.randrange(0, 86400)), "hot"))
    for i in range(700, 730):
        rows.append((i, at(i * 9000.5), "sparse"))
    rows += [(730, at(5), "few"), (731, at(9), "few"), (732, at(50), None), (733, at(3700), None), (734, at(3709), None)]
    rows = [(i, t, m, float(i % 17)) for i, t, m in rows]
    rng.shuffle(rows)
    return rows


def by_machine(rows):
    groups = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[1], r[0])):
        groups[row[2]].append(row)
    return groups


CHUNKINGS = [Chunking(), Chunking(max_rows=20), Chunking(max_rows=3), Chunking(max_rows=3, broadcast_rows=2)]


@pytest.mark.parametrize("chunking", CHUNKINGS)
def test_elapsed_is_exact_for_any_chunking(spark, skewed, chunking):
    expected = [
        (b[0], int((b[1] - a[1]).total_seconds())) for g in by_machine(skewed).values() for a, b in zip(g, g[1:])
    ]
    found = neighbours.elapsed(table(spark, skewed), ["machine"], chunking=chunking)
    assert sorted((r["event_id"], r["elapsed"]) for r in found.collect()) == sorted(expected)


@pytest.mark.parametrize("chunking, n", [(CHUNKINGS[0], 10), (CHUNKINGS[1], 31), (CHUNKINGS[2], 2), (CHUNKINGS[0], 1)])
def test_moving_average_is_exact_for_any_chunking(spark, skewed, chunking, n):
    expected = {}
    for group in by_machine(skewed).values():
        values = [r[3] for r in group]
        if len(group) < n:
            expected[group[-1][0]] = sum(values) / len(values)
        for i in range(n - 1, len(group)):
            expected[group[i][0]] = sum(values[i - n + 1:i + 1]) / n
    found = {r["event_id"]: r["_value"] for r in neighbours.moving_average(
        table(spark, skewed), ["machine"], n, chunking=chunking).collect()}
    assert found == pytest.approx(expected)


@pytest.mark.parametrize("chunking", CHUNKINGS[1:2])
def test_pairs_are_exact_for_any_chunking(spark, skewed, chunking):
    named = [(i, t, m, ["start", "end", "other"][i % 3]) for i, t, m, _ in skewed]
    expected = [
        (b[0], a[1]) for g in by_machine(named).values() for a, b in zip(g, g[1:]) if (a[3], b[3]) == ("start", "end")
    ]
    rows = table(spark, named, "event_id bigint, _time timestamp, machine string, event_type string")
    found = neighbours.start_end_pairs(rows, ["machine"], "start", "end", chunking=chunking)
    assert expected and sorted((r["event_id"], r["start_time"]) for r in found.collect()) == sorted(expected)


@pytest.mark.parametrize("max_rows", [3])
def test_chunks_are_bounded(spark, skewed, max_rows):
    chunked, keys = neighbours.in_chunks(table(spark, skewed), ["machine"], tie="event_id", chunking=Chunking(max_rows))
    assert keys == ["machine", "_chunk", "_sub"]
    sizes = chunked.groupBy("machine", "_chunk", "_sub").count().agg(F.max("count")).first()[0]
    assert sizes <= max_rows


@pytest.mark.parametrize("width", [1, 3_900, 15_000_000])
def test_any_width_gives_the_same(spark, skewed, width):
    rows = table(spark, skewed)
    plain = sorted(neighbours.elapsed(rows, ["machine"]).collect())
    assert sorted(neighbours.elapsed(rows, ["machine"], chunking=Chunking(width=width)).collect()) == plain


def test_no_job_runs_before_the_result_is_asked_for(spark, skewed):
    rows = table(spark, skewed)
    spark.sparkContext.setJobGroup("building", "no job may run")
    neighbours.elapsed(rows, ["machine"])
    neighbours.moving_average(rows, ["machine"], 10)
    neighbours.start_end_pairs(rows.withColumn("event_type", F.lit("start")), ["machine"], "start", "end")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("other", "")


def test_one_row_per_group_needs_no_sorted_aggregate(spark, skewed):
    rows = table(spark, skewed)
    for found in (series.last_by(rows, ["machine"]), series.first_by(rows, ["machine"]), series.legend(rows, ["machine"], "_value")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan


@pytest.mark.parametrize("newest", [False, True])
def test_limits_beyond_what_spark_ranks_by_itself(spark, skewed, newest, monkeypatch):
    monkeypatch.setattr(series, "OPTIMIZED_LIMIT", 4)
    expected = []
    for group in by_machine(skewed).values():
        expected += [r[0] for r in (group[-7:] if newest else group[:7])]
    found = series.limit_per_series(table(spark, skewed), ["machine"], 7, newest=newest)
    assert sorted(r["event_id"] for r in found.collect()) == sorted(expected)


def test_rows_of_equal_time_and_missing_tags(spark):
    rows = table(spark, [(1, at(5), None, 1.0), (2, at(5), None, 2.0), (3, at(4), None, 3.0), (4, at(5), "a", 4.0)])
    assert sorted(r["event_id"] for r in series.last_by(rows, ["machine"]).collect()) == [2, 4]
    assert sorted(r["event_id"] for r in series.first_by(rows, ["machine"]).collect()) == [3, 4]
    assert sorted((r["machine"] or "", r["last_value"]) for r in series.legend(rows, ["machine"], "_value").collect()) == [("", 2.0), ("a", 4.0)]


def test_long_rows_of_undeclared_fields(spark):
    rows = spark.createDataFrame(
        [(1, 2.0, {"coolant": 5.0, "none": None}), (2, None, None)], "event_id bigint, temperature double, extra_fields map<string,double>")
    found = series.to_long(rows, ["event_id"], ["temperature"], "extra_fields")
    assert sorted(found.collect()) == [(1, "coolant", 5.0), (1, "temperature", 2.0)]


def test_pairs_need_the_same_piece_and_tool(spark):
    rows = table(spark, [
        (1, at(0), "A", "processing_start", "PZ001", "TM10"), (2, at(5), "A", "processing_start", "PZ001", "TM25"),
        (3, at(60), "A", "processing_end", "PZ001", "TM10"), (4, at(90), "A", "processing_end", "PZ001", "TM25"),
        (5, at(100), "S", "processing_start", "PZ002", None), (6, at(130), "S", "processing_end", "PZ002", None),
        (7, at(140), "S", "processing_end", "PZ002", None),
    ], "event_id bigint, _time timestamp, machine string, event_type string, piece_id string, tool string")
    found = neighbours.start_end_pairs(rows, ["machine", "piece_id", "tool"], "processing_start", "processing_end")
    assert sorted((r["event_id"], r["seconds"]) for r in found.collect()) == [(3, 60.0), (4, 85.0), (6, 30.0)]


def test_elapsed_units(spark):
    rows = table(spark, [(1, at(0), "a", 1.0), (2, at(59.9), "a", 1.0), (3, at(3660), "a", 1.0)])
    assert sorted(r["elapsed"] for r in neighbours.elapsed(rows, ["machine"]).collect()) == [59, 3600]
    assert sorted(r["elapsed"] for r in neighbours.elapsed(rows, ["machine"], "MINUTE").collect()) == [0, 60]


def test_first_last_and_limits(spark, skewed):
    rows, groups = table(spark, skewed), by_machine(skewed)
    last = {r["machine"]: r["event_id"] for r in series.last_by(rows, ["machine"]).collect()}
    first = {r["machine"]: r["event_id"] for r in series.first_by(rows, ["machine"]).collect()}
    assert last == {m: g[-1][0] for m, g in groups.items()}
    assert first == {m: g[0][0] for m, g in groups.items()}
    for newest in (False, True):
        found = series.limit_per_series(rows, ["machine"], 50, newest=newest).collect()
        wanted = [r[0] for g in groups.values() for r in (g[-50:] if newest else g[:50])]
        assert sorted(r["event_id"] for r in found) == sorted(wanted)


def test_equal_stamps_without_an_id_have_one_order(spark):
    rows = spark.createDataFrame(
        [(at(0), "a", float(v), {"x": 1.0}) for v in (3, 9, 1)],
        "_time timestamp, machine string, _value double, extra_fields map<string,double>")
    for shuffled in (rows, rows.orderBy("_value"), rows.orderBy(F.desc("_value"))):
        assert series.last_by(shuffled, ["machine"]).first()["_value"] == 9.0
        assert series.first_by(shuffled, ["machine"]).first()["_value"] == 1.0
        means = neighbours.moving_average(shuffled, ["machine"], 2).collect()
        assert sorted(r["_value"] for r in means) == [2.0, 6.0]


def test_aggregates_leave_out_missing_values(spark):
    rows = table(spark, [(1, at(0), "a", 1.0), (2, at(1), "a", None), (3, at(2), "a", 4.0), (4, at(3), "b", None)])
    assert series.sum_by(rows, ["machine"]).collect() == [("a", 5.0)]
    assert series.mean_by(rows, ["machine"]).collect() == [("a", 2.5)]
    assert series.count_by(rows, ["machine"], "_value").collect() == [("a", 2)]
    assert sorted(series.count_by(rows, ["machine"]).collect()) == [("a", 3), ("b", 1)]


def test_long_and_back(spark):
    wide = spark.createDataFrame(
        [(1, at(0), "a", 20.0, None), (2, at(1), "a", None, 2.0)],
        "event_id bigint, _time timestamp, machine string, temperature double, power double")
    long = series.to_long(wide, ["event_id", "_time", "machine"], ["temperature", "power"])
    assert sorted(r["_field"] for r in long.collect()) == ["power", "temperature"]
    back = series.pivot_fields(long, ["_time", "machine"], ["temperature", "power"])
    assert sorted(back.collect()) == [(at(0), "a", 20.0, None), (at(1), "a", None, 2.0)]


def test_pivot_takes_the_later_of_equal_points(spark):
    rows = spark.createDataFrame(
        [(2, at(0), "t", 7.0), (1, at(0), "t", 9.0)], "event_id bigint, _time timestamp, _field string, _value double")
    assert series.pivot_fields(rows, ["_time"], ["t"]).collect() == [(at(0), 7.0)]


def test_collapse_keeps_the_last_present_value_of_each_field(spark):
    rows = spark.createDataFrame(
        [("a", at(0), 1, 5.0, "x"), ("a", at(0), 2, None, "y"), ("a", at(1), 1, 1.0, None)],
        "machine string, _time timestamp, arrived int, power double, status string")
    found = series.collapse_points(rows, ["machine", "_time"], ["arrived"]).collect()
    assert sorted(found, key=lambda r: r["_time"]) == [("a", at(0), 5.0, "y"), ("a", at(1), 1.0, None)]


def test_window_ends_are_cut_by_the_range(spark):
    rows = table(spark, [(1, at(10), "a", 1.0), (2, at(3500), "a", 3.0), (3, at(3600), "a", 5.0), (4, at(5000), "b", None)])
    stop = F.lit("2024-01-01 01:20:00").cast("timestamp")
    found = series.window_value(rows, ["machine"], "1 hour", F.avg, stop).collect()
    assert sorted(found) == [("a", at(3600), 2.0), ("a", at(4800), 5.0)]


def test_ranges_include_the_start_and_not_the_stop(spark):
    rows = table(spark, [(i, at(s), "a", 1.0) for i, s in enumerate([0, 1799, 1800, 3599, 3600])])
    for zone in ("timestamp", "timestamp_ntz"):
        typed = rows.withColumn("_time", F.col("_time").cast(zone))
        found = tables.recent(typed, "2024-01-01 01:00:00", "30 minutes")
        assert sorted(r["event_id"] for r in found.collect()) == [2, 3]
        start, stop = tables.bounds(typed, "2024-01-01 01:00:00", "60 minutes", "30 minutes")
        assert sorted(r["event_id"] for r in tables.time_range(typed, start, stop).collect()) == [0, 1]


def test_selection(spark):
    rows = table(spark, [(1, at(0), "a", 1.0), (2, at(0), "b", 1.0)])
    assert series.selected(rows, "machine", "All").count() == 2
    assert series.selected(rows, "machine", ["b", "c"]).count() == 1
