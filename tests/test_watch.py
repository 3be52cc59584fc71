"""The log of streams, limits over time, and what ingestion takes."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from plantspark.functions.rules import Thresholds
from plantspark.operators import alerts as alert_ops
from plantspark.operators.limits import limit_problems
from plantspark.sources import messages as bus, tables
from plantspark.streaming import ingest, watch

T0 = datetime(2024, 1, 1)
READING = "event_id bigint, _time timestamp, machine string, machine_type string, temperature double, power double, vibration_level double, rpm_spindle double"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def test_a_failing_sink_leaves_a_counted_error(spark, root):
    for k in range(3):
        spark.createDataFrame([(at(k), "Saw1", float(k))], "_time timestamp, machine string, temperature double").coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema("_time timestamp, machine string, temperature double").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    seen = []

    def fails_at_last(batch, number):
        seen.append(number)
        batch.count()  # rows that nobody reads are not counted
        if number == 2:
            raise OSError("no room")

    observer = watch.Watch(spark, root).attach()
    for _ in range(2):
        query = ingest.start(stream.writeStream.foreachBatch(fails_at_last).queryName("q"), f"{root}/checkpoint", every=None)
        with pytest.raises(StreamingQueryException):
            query.awaitTermination()
        assert observer.wait_for(query.runId)
    good = ingest.store_stream(stream, root, "sensor_data", f"{root}/other", every=None, name="good")
    good.awaitTermination()
    observer.wait_for(good.runId)
    observer.detach()
    log = tables.read_table(spark, root, "stream_log")
    report = {r["query"]: r.asDict() for r in watch.write_report(log).collect()}
    assert seen == [0, 1, 2, 2]
    assert (report["q"]["batches"], report["q"]["rows_written"], report["q"]["write_errors"]) == (2, 2, 2)
    assert "no room" in report["q"]["last_error"] and report["q"]["last_write_time"] is not None
    assert (report["good"]["batches"], report["good"]["rows_written"], report["good"]["write_errors"], report["good"]["last_error"]) == (3, 3, 0, None)
    assert log.where("kind = 'ended'").count() == 1
    assert tables.read_table(spark, root, "sensor_data").count() == 3


def test_events_are_written_together(spark, root, monkeypatch):
    monkeypatch.setattr(watch, "TOGETHER", 3)
    observer = watch.Watch(spark, root)
    for k in range(7):
        observer._add("q", "r", "batch", k, 1, 1.0, 5, None)
    assert tables.read_table(spark, root, "stream_log").count() == 6
    observer.write()
    observer.write()
    assert tables.read_table(spark, root, "stream_log").count() == 7 and observer.number == 3


def test_topics_that_are_not_asked_for_are_dropped_unread(spark, root):
    rows = [("/plant/data/Saw1", '{"entity":"Saw1","data":{"temperature":1}}', T0), ("/plant/x", "{}", T0), ("/plant/alerts/a", "{}", T0), ("/plant/data/Saw1", "{", T0)]
    spark.createDataFrame(rows, "topic string, payload string, arrived_at timestamp").coalesce(1).write.parquet(f"{root}/in")
    for name, topics in (("all", None), ("plant", bus.TOPICS), ("data", ["/plant/data/+"])):
        ingest.ingest(bus.message_stream(spark, f"{root}/in"), f"{root}/{name}", f"{root}/cp-{name}", every=None, topics=topics).awaitTermination()
    reasons = {n: sorted(r["reason"] for r in tables.read_table(spark, f"{root}/{n}", "rejects").collect()) for n in ("all", "plant", "data")}
    assert reasons == {"all": ["bad_json", "unknown_topic", "unknown_topic"], "plant": ["bad_json", "unknown_topic"], "data": ["bad_json"]}
    assert tables.read_table(spark, f"{root}/data", "sensor_data").count() == 1


def plain_limits(changes, machine, when, name, default):
    known = sorted((c for c in changes if c["machine"] == machine and c["valid_from"] is not None and c["valid_from"] <= when), key=lambda c: c["valid_from"])
    return known[-1].get(name) if known and known[-1].get(name) is not None else default


@pytest.mark.parametrize("few", [True, False])
def test_limits_in_force_at_the_time_of_a_reading(spark, few, monkeypatch):
    monkeypatch.setattr("plantspark.operators.limits.BROADCAST_LIMITS", 100 if few else 0)
    draw = random.Random(2)
    changes = [{"machine": m, "valid_from": at(draw.randrange(1000)), "temperature_warning": draw.choice([None, 10.0, 20.0]), "power_low": draw.choice([None, 3.0])}
               for m in ("a", "a", "a", "b", None)] + [{"machine": "a", "valid_from": None, "temperature_warning": 0.5, "power_low": None}]
    limits = spark.createDataFrame([tuple(c.values()) for c in changes], "machine string, valid_from timestamp, temperature_warning double, power_low double")
    rows = [(i, at(draw.randrange(1100)), draw.choice(["a", "b", "c", None]), "Saw", draw.uniform(5, 95), draw.uniform(0, 6), None, None) for i in range(200)]
    found = alert_ops.with_anomalies_over_time(spark.createDataFrame(rows, READING), limits)
    got = sorted((r["event_id"], a["rule"], a["severity"]) for r in found.collect() for a in r["anomalies"])
    want = []
    for i, t, m, _, temperature, power, *_ in rows:
        if temperature > 90:
            want.append((i, "temperature", "critical"))
        elif temperature > plain_limits(changes, m, t, "temperature_warning", 80.0):
            want.append((i, "temperature", "warning"))
        if power > 5 or power < plain_limits(changes, m, t, "power_low", 0.1):
            want.append((i, "power", "warning"))
    assert got == sorted(want)


def test_no_limits_are_the_defaults_and_bad_ones_are_named(spark):
    rows = spark.createDataFrame([(1, T0, "a", "Milling", 85.0, 9.0, 2.6, 10.0), (2, T0, None, None, None, None, None, None)], READING)
    names = "machine string, valid_from timestamp, temperature_warning double, temperature_critical double, milling_rpm_low double, milling_rpm_high double"
    none = spark.createDataFrame([], names)
    as_text = lambda df: sorted(map(str, df.collect()))
    assert as_text(alert_ops.with_anomalies_over_time(rows, none)) == as_text(alert_ops.with_anomalies(rows))
    own = Thresholds(temperature_warning=84.0, temperature_critical=84.5)
    assert as_text(alert_ops.with_anomalies_over_time(rows, none, own)) == as_text(alert_ops.with_anomalies(rows, own))
    bad = spark.createDataFrame([("a", T0, 5.0, 4.0, None, None), ("b", T0, -1.0, 4.0, 9.0, 2.0), (None, None, 1.0, 2.0, 1.0, 2.0)], names)
    problems = sorted((r["machine"] or "", r["problem"]) for r in limit_problems(bad).collect())
    assert problems == [
        ("", "machine is missing"), ("", "valid_from is missing"), ("a", "temperature critical must be higher than warning"),
        ("b", "milling rpm limits must be in order"), ("b", "temperature warning must be positive")]
