"""Streams give what the batch operators give, over several batches, restarts and late rows."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from plantspark.operators import alerts as alert_ops, neighbours, quality, rollups, series
from plantspark.sources import benchmark_views as views, messages as bus, tables
from plantspark.streaming import closed_ranges, ingest, windows

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)
COLUMNS = "event_id bigint, _time timestamp, machine string, event_type string, _value double"


def store(rows, path, batch):
    """One more file of a growing table, in the order of the calls."""
    rows.coalesce(1).write.mode("append").parquet(path)


def grow(spark, path, batch):
    return spark.createDataFrame([(i, T0 + timedelta(seconds=s), m, e, float(v)) for i, s, m, e, v in batch], COLUMNS)


def stream_of(spark, path, schema, max_files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ingest_over_batches_and_a_restart_equals_batch(spark, root):
    source = views.messages(views.events(spark, SF))
    parts = [source.where(F.pmod(F.xxhash64("payload", "arrived_at"), F.lit(3)) == i) for i in range(3)]
    stored, checkpoint = f"{root}/tables", f"{root}/checkpoint"
    for part in parts[:2]:
        store(part, f"{root}/in", 0)
    first = ingest.ingest(bus.message_stream(spark, f"{root}/in", max_files=1), stored, checkpoint, every=None)
    first.awaitTermination()
    counts = [p["observedMetrics"].get("ingest") for p in map(lambda p: json.loads(p.json), first.recentProgress) if p["numInputRows"]]
    store(parts[2], f"{root}/in", 0)
    second = ingest.ingest(bus.message_stream(spark, f"{root}/in", max_files=1), stored, checkpoint, every=None)
    second.awaitTermination()
    counts += [p["observedMetrics"].get("ingest") for p in map(lambda p: json.loads(p.json), second.recentProgress) if p["numInputRows"]]

    rows = ingest.checked(source)
    for name, expected, _ in ingest.outputs(rows):
        found = tables.read_table(spark, stored, name).select(*expected.columns)
        if name == "sensor_data":
            as_text = lambda df: df.withColumn("extra_fields", F.to_json("extra_fields"))
            found, expected = as_text(found), as_text(expected)
        assert same(found, expected), name
    assert len(counts) == 3
    assert sum(c["processed"] for c in counts) == rows.where("reason is null").count()
    assert sum(c["errors"] for c in counts) == rows.where("reason = 'missing_data'").count()


def test_a_batch_run_twice_is_stored_once(spark, root):
    rows = ingest.checked(views.messages(views.events(spark, SF)))
    for _ in range(2):
        for name, part, time in ingest.outputs(rows):
            tables.append_batch(part, root, name, 0, time)
    stored = sum(tables.read_table(spark, root, n).count() for n in ("sensor_data", "machine_events", "piece_tracking", "rejects"))
    assert stored == 1000


def test_alerts_arrive_with_their_readings(spark, root):
    source = views.view(views.events(spark, SF), views.SENSOR_WIDE)
    for i in range(2):
        store(source.where(F.col("event_id") % 2 == i), f"{root}/in", i)
    rows = alert_ops.with_anomalies(stream_of(spark, f"{root}/in", source.schema))
    ingest.alerts_stream(rows, f"{root}/alerts", f"{root}/checkpoint", every=None).awaitTermination()
    expected = alert_ops.alerts(alert_ops.with_anomalies(source))
    assert same(spark.read.parquet(f"{root}/alerts").select(*expected.columns), expected)


def test_windows_close_after_the_delay_and_leave_out_what_is_later(spark, root):
    batches = [
        [(1, 100, "a", "x", 1), (2, 3000, "a", "x", 3)],
        [(3, 9000, "a", "x", 5), (4, 3500, "a", "x", 8)],
        [(5, 20000, "a", "x", 7)],
        [(6, 200, "a", "x", 100), (7, 20001, "a", "x", 7)],
        [(8, 40000, "a", "x", 7)],
    ]
    for i, batch in enumerate(batches):
        store(grow(spark, root, batch), f"{root}/in", i)
        rows = stream_of(spark, f"{root}/in", COLUMNS)
        windows.window_stream(
            rows, ["machine"], "1 hour", [F.avg("_value").alias("_value")], f"{root}/out", f"{root}/checkpoint", every=None,
        ).awaitTermination()
    found = spark.read.parquet(f"{root}/out").collect()
    assert sorted((r["_time"], r["_value"]) for r in found) == [
        (T0 + timedelta(hours=1), 4.0), (T0 + timedelta(hours=3), 5.0), (T0 + timedelta(hours=6), 7.0)]
    # The row that came too late is in the table, so the batch result has it.
    table = spark.read.parquet(f"{root}/in")
    again = series.window_value(table, ["machine"], "1 hour", F.avg).orderBy("_time").first()
    assert again["_value"] == 28.0


def test_copies_of_a_point_are_stored_once(spark, root):
    batches = [
        [(1, 100, "a", "x", 1)] * 50 + [(2, 200, "a", "x", 1)], [(1, 100, "a", "x", 1)] * 50 + [(3, 100, "b", "x", 1)],
        [(4, 2000, "a", "x", 1), (2, 200, "a", "x", 1)],
    ]
    for i, batch in enumerate(batches):
        grow(spark, root, batch).repartition(3).write.mode("append").parquet(f"{root}/in")
        once = windows.distinct_points(stream_of(spark, f"{root}/in", COLUMNS), ["machine", "_time"])
        ingest.start(
            once.writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/checkpoint", every=None,
        ).awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{root}/out").collect()) == [1, 2, 3, 4]


def readings(n):
    """Rows of three machines, one of them dense, out of order by up to half an hour."""
    rows = []
    for i in range(n):
        machine = ["hot", "hot", "hot", "cold", "rare"][i % 5] if i % 35 else "rare"
        second = i * 97 + (i * 7919) % 1700
        rows.append((i, second, machine, ["start", "end", "x"][i % 3], i % 11))
    return rows


def follow(spark, root, start):
    """Feeds four files in portions with a new start of the stream for each."""
    rows, path = readings(400), f"{root}/in"
    for k in range(4):
        store(grow(spark, root, rows[k * 100:(k + 1) * 100]), path, k)
        start(stream_of(spark, path, COLUMNS), lambda: spark.read.schema(COLUMNS).parquet(path), f"{root}/out",
              f"{root}/checkpoint").awaitTermination()
    table = spark.read.schema(COLUMNS).parquet(path)
    upto = max(r[1] for r in rows) - 3600
    closed = F.col("_time") < F.lit(T0 + timedelta(seconds=upto // 3600 * 3600))
    return table, closed, closed_ranges.results(f"{root}/out", table)


def test_gaps_over_closed_ranges(spark, root):
    table, closed, found = follow(
        spark, root, lambda s, t, out, cp: closed_ranges.gap_stream(s, t, ["machine"], out, cp, longer_than=60, every=None))
    expected = quality.gaps(table, ["machine"], longer_than=60).where(closed)
    assert expected.count() > 100 and same(found.select(*expected.columns), expected)


def test_moving_average_over_closed_ranges(spark, root):
    table, closed, found = follow(
        spark, root, lambda s, t, out, cp: closed_ranges.moving_average_stream(s, t, ["machine"], 10, out, cp, every=None))
    expected = neighbours.moving_average(table, ["machine"], 10).where(closed)
    assert expected.count() > 100
    figure = lambda df: df.select("event_id", F.round("_value", 9).alias("v"))
    assert same(figure(found), figure(expected))


def test_pairs_over_closed_ranges(spark, root):
    table, closed, found = follow(
        spark, root, lambda s, t, out, cp: closed_ranges.pair_stream(s, t, ["machine"], "start", "end", out, cp, every=None))
    expected = neighbours.start_end_pairs(table, ["machine"], "start", "end").where(closed)
    assert expected.count() > 20 and same(found.select(*expected.columns), expected)


def test_finished_ranges_equal_the_batch(spark, root):
    by = ["machine"]
    table, _, _ = follow(spark, root, lambda s, t, out, cp: closed_ranges.gap_stream(s, t, by, out, cp, longer_than=60, every=None))
    expected = quality.gaps(table, by, longer_than=60)
    for _ in range(2):
        closed_ranges.finish(lambda: table, closed_ranges.gaps_over(by, 60), f"{root}/out", f"{root}/checkpoint")
        assert same(closed_ranges.results(f"{root}/out", table).select(*expected.columns), expected)


def test_only_the_newest_history_is_kept_and_silent_series_are_forgotten(spark, root):
    by = ["machine"]
    follow(spark, root, lambda s, t, out, cp: closed_ranges.gap_stream(
        s, t, by, out, cp, longer_than=60, every=None, forget_after="1 hour"))
    kept = spark.read.parquet(f"{root}/out/history")
    assert kept.select("batch").distinct().count() <= 2 and kept.count() <= 6


def test_statistics_of_ingestion_are_stored(spark, root):
    rows = [("/plant/data/Saw1", '{"entity":"Saw1","data":{"temperature":1}}', T0), ("/plant/data/Saw1", "{", T0), ("/plant/x", "{}", T0)]
    for k in range(2):
        part = spark.createDataFrame([(t, p, at + timedelta(seconds=k)) for t, p, at in rows], "topic string, payload string, arrived_at timestamp")
        store(part, f"{root}/in", k)
        ingest.ingest(bus.message_stream(spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint", every=None).awaitTermination()
    stats = tables.read_table(spark, f"{root}/out", "pipeline_stats")
    found = rollups.pipeline_totals(stats).first()
    assert stats.count() == 2 and (found["messages_received"], found["messages_processed"], found["unknown_topics"]) == (4, 2, 2)
    assert found["processing_rate"] == 2.0


def test_a_backlog_in_one_file_is_decoded_by_many_tasks(spark, root, monkeypatch):
    rows = [(f"/plant/data/Saw{i}", '{"entity":"Saw1","data":{"temperature":1}}', T0) for i in range(200)]
    store(spark.createDataFrame(rows, "topic string, payload string, arrived_at timestamp").coalesce(1), f"{root}/in", 0)
    tasks, append = [], ingest.append_batch

    def noted(batch, path, name, *rest):
        if name == "sensor_data":
            tasks.append(batch.rdd.getNumPartitions())
        append(batch, path, name, *rest)

    monkeypatch.setattr(ingest, "append_batch", noted)
    ingest.ingest(bus.message_stream(spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint", every=None).awaitTermination()
    assert tasks == [ingest.TASKS_A_CORE * spark.sparkContext.defaultParallelism]
    assert tables.read_table(spark, f"{root}/out", "sensor_data").count() == 200
