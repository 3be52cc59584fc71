"""Quality jobs, rollups, retention and storage."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plantspark.operators import quality, rollups
from plantspark.plans import reports
from plantspark.sources import tables

T0 = datetime(2024, 1, 1)
SENSOR = "event_id bigint, _time timestamp, machine string, machine_type string, location string, temperature double, power double"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def sensor(spark, *rows):
    return spark.createDataFrame(
        [(i, at(s), m, m.rstrip("0123456789"), "workshop_A", t, p) for i, (s, m, t, p) in enumerate(rows)], SENSOR)


def test_counts_are_field_values_and_expected_names_stay(spark):
    rows = sensor(spark, (0, "Saw1", 20.0, None), (1, "Saw1", None, None))
    counts = quality.measurement_counts({"sensor_data": (rows, ["temperature", "power"])}, ["sensor_data", "alerts"])
    assert sorted(counts.collect()) == [("alerts", 0), ("sensor_data", 1)]
    assert quality.volume_report(counts).first() == (1, 1, "increase frequency")


@pytest.mark.parametrize("records, advice", [(999, "increase frequency"), (1000, "ok"), (100_000, "ok"), (100_001, "retention")])
def test_volume_limits(spark, records, advice):
    counts = spark.createDataFrame([("a", records), ("b", -1)], "_measurement string, records bigint")
    assert quality.volume_report(counts).first() == (records, 0, advice)


def test_gaps_are_longer_than_ten_seconds(spark):
    rows = sensor(spark, (0, "Saw1", 1.0, 1.0), (10, "Saw1", 1.0, 1.0), (21, "Saw1", 1.0, 1.0), (0, "Lathe1", 1.0, 1.0))
    gaps = quality.gaps(rows, ["machine"])
    assert [(r["machine"], r["elapsed"]) for r in gaps.collect()] == [("Saw1", 11)]
    assert quality.gap_summary(gaps, ["machine"]).collect() == [("Saw1", 1, 11)]


def test_declared_domains(spark):
    rows = spark.createDataFrame(
        [("Milling1", "Milling", 50.0, 4001.0), ("Saw1", "Saw", 100.5, 1000.0), ("Drill9", None, None, None)],
        "machine string, machine_type string, temperature double, rpm_spindle double")
    found = {(r["column"], r["rule"]): r["violations"] for r in quality.schema_violations(rows, "sensor_data").collect()}
    assert found == {
        ("machine", "allowed_values"): 1, ("machine_type", "allowed_values"): 0, ("temperature", "range"): 1,
        ("rpm_spindle", "range"): 1, ("rpm_spindle", "machine_type"): 1}
    listed = {r["machine"]: r["violations"] for r in quality.violating_rows(rows, "sensor_data").collect()}
    assert listed == {
        "Milling1": ["rpm_spindle:range"], "Saw1": ["temperature:range", "rpm_spindle:machine_type"],
        "Drill9": ["machine:allowed_values"]}


def test_missing_names_and_tag_combinations(spark):
    found = spark.createDataFrame([("alerts",), ("alerts",)], "name string")
    assert quality.missing_names(spark, ["alerts", "industrial_data"], found, "name").collect() == [("industrial_data",)]
    rows = spark.createDataFrame([("a", None), ("a", None), ("b", "Saw")], "machine string, machine_type string")
    assert sorted(quality.tag_combinations(rows, ["machine", "machine_type"]).collect()) == [
        ("a", None, True), ("b", "Saw", False)]


def test_default_ranges_of_reports(spark):
    rows = sensor(spark, (0, "Milling1", 50.0, 1.0), (3599, "Milling1", 81.0, 6.0), (7199, "Milling2", 90.0, 1.0))
    now = "2024-01-01 02:00:00"
    assert [r["temperature"] for r in reports.machine_temperature(rows, "2024-01-01 01:00:00").collect()] == [50.0, 81.0]
    assert [r["machine"] for r in reports.high_temperature(rows, now).collect()] == ["Milling2"]
    assert reports.distinct_machines(rows, now).count() == 2
    assert [r["_time"] for r in reports.temperature_panel(rows, "2024-01-01 01:59:59.500000").collect()][-1] == at(7199.5)


def test_hourly_rollup_leaves_an_hour_for_late_rows(spark):
    rows = sensor(spark, (0, "Saw1", 1.0, None), (3600, "Saw1", 2.0, None), (5000, "Saw1", 4.0, 3.0), (7200, "Saw1", 9.0, 9.0))
    found = rollups.hourly_means(rows, "2024-01-01 03:00:00", fields=["temperature", "power"])
    assert found.select("_time", "temperature", "power").collect() == [(at(7200), 3.0, 3.0)]


def test_rollup_store_replaces_only_its_range(spark, root):
    rows = sensor(spark, *[(h * 3600 + 60, "Saw1", float(h), 1.0) for h in range(30)])
    for now in ("2024-01-01 06:00:00", "2024-01-01 07:00:00", "2024-01-01 07:00:00", "2024-01-02 02:00:00"):
        start, stop = tables.bounds(rows, now, "2 hours", "1 hour")
        tables.merge_windows(rollups.hourly_means(rows, now, fields=["temperature"]), root, "sensor_data_1h", start, stop)
    stored = tables.read_windows(spark, root, "sensor_data_1h")
    assert sorted((r["_time"], r["temperature"]) for r in stored.collect()) == [
        (at(5 * 3600), 4.0), (at(6 * 3600), 5.0), (at(25 * 3600), 24.0)]
    start, stop = tables.bounds(rows, "2024-01-02 06:00:00", "30 hours")
    tables.merge_windows(
        rollups.hourly_means(rows, "2024-01-02 06:00:00", "30 hours", "0 hours", fields=["temperature"]),
        root, "sensor_data_1h", start, stop)
    assert tables.read_windows(spark, root, "sensor_data_1h").count() == 30


def test_daily_rollup(spark):
    rows = spark.createDataFrame(
        [(at(60), "a", "processing_end", "PZ1", None, 2.0), (at(90), "a", "processing_end", "PZ1", None, 3.0),
         (at(90), "a", "processing_start", "PZ1", None, 9.0), (at(86400), "a", "processing_end", "PZ1", None, 7.0)],
        "_time timestamp, machine string, event_type string, piece_id string, tool string, cycle_time double")
    assert rollups.daily_cycle_time(rows, "2024-01-03 00:00:00").select("_time", "cycle_time").collect() == [(at(86400), 5.0)]
    assert rollups.hourly_efficiency(rows, "2024-01-01 02:00:00").collect() == [("a", at(3600), 5.0, 2)]


def test_retention(spark, root):
    rows = sensor(spark, *[(d * 86400, "Saw1", float(d), 1.0) for d in range(10)])
    kept = tables.retained(rows, "industrial_data", "2024-01-10 00:00:00")
    assert sorted(r["temperature"] for r in kept.collect()) == [2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]
    tables.append_batch(rows, root, "sensor_data", 0)
    stored = tables.retained(tables.read_table(spark, root, "sensor_data"), "industrial_data", "2024-01-10 00:00:00")
    assert stored.count() == 8
    assert "event_date" in stored._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:120]


def test_a_repeated_batch_replaces_itself(spark, root):
    rows = sensor(spark, (0, "Saw1", 1.0, 1.0), (90000, "Saw1", 2.0, 1.0))
    for batch in (0, 1, 1):
        tables.append_batch(rows, root, "sensor_data", batch)
    assert tables.read_table(spark, root, "sensor_data").count() == 4
    assert tables.read_table(spark, root, "alerts").count() == 0


def test_time_ranges_reach_the_scan(spark, root):
    tables.append_batch(sensor(spark, (0, "Saw1", 1.0, 1.0), (90000, "Saw1", 2.0, 1.0)), root, "sensor_data", 0)
    found = reports.machine_temperature(tables.read_table(spark, root, "sensor_data"), "2024-01-01 12:00:00", "12 hours", "Saw1")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_time,2024-01-01" in plan and "event_date" in plan.split("PartitionFilters")[1][:200]
    assert "power" not in plan.split("ReadSchema")[1]
    assert found.count() == 1


def test_points(spark):
    rows = tables.points(spark, "piece_tracking", [{
        "time": T0, "tags": {"piece_id": "PZ001", "event_type": "move_start", "from_station": "Saw1"},
        "fields": {"duration": 2.5, "distance": 50.0}}])
    assert rows.first()["distance"] == 50.0 and rows.first()["to_station"] is None


def test_last_of_those_over_the_limit(spark):
    rows = spark.createDataFrame(
        [(1, at(0), "a", "T", 0.9), (2, at(5), "a", "T", 0.7), (3, at(3), "a", None, 0.85)],
        "event_id bigint, _time timestamp, machine string, tool string, tool_wear double")
    found = reports.tool_wear_last(rows, "2024-01-01 01:00:00").collect()
    assert sorted(r["event_id"] for r in found) == [1, 3]


def test_availability_is_a_share_of_the_range(spark):
    rows = spark.createDataFrame(
        [(1, at(0), "a", "processing_start", "P", None), (2, at(3600), "a", "processing_end", "P", None)],
        "event_id bigint, _time timestamp, machine string, event_type string, piece_id string, tool string")
    assert reports.availability(rows, "2024-01-02 00:00:00").first()["availability_pct"] == pytest.approx(100 / 24)


def test_message_statistics(spark):
    rows = spark.createDataFrame(
        [(None, at(0)), (None, at(4)), ("bad_json", at(5)), ("missing_data", at(6)), ("unknown_topic", at(8))],
        "reason string, arrived_at timestamp")
    found = rollups.message_stats(rows).first()
    assert (found["messages_received"], found["messages_processed"], found["errors"], found["unknown_topics"]) == (4, 2, 1, 1)
    assert found["processing_rate"] == 0.25 and found["last_message_at"] == at(8)
    assert rollups.message_stats(rows, uptime_seconds=0.5).first()["processing_rate"] == 2.0


def test_system_samples_fill_what_was_not_taken(spark):
    from plantspark.operators.normalise import system_samples

    rows = spark.createDataFrame(
        [(T0, 12.345, 8 * 1024**3, None, None, 50.126, None)],
        "_time timestamp, cpu double, memory_total bigint, memory_available bigint, errors int, memory_used_percent double, uptime_seconds double")
    found = system_samples(rows).first()
    assert (found["cpu"], found["ram"], found["free_memory"], found["errors"], found["memory_used_percent"]) == (12.35, 8.0, 0.0, 0, 50.13)


def test_presets_name_ranges(spark):
    rows = sensor(spark, (0, "Saw1", 1.0, 1.0), (1800, "Saw1", 1.0, 1.0))
    assert [tables.recent(rows, "2024-01-01 01:00:00", p).count() for p in ("30m", "1h", "6h", "24h")] == [1, 2, 2, 2]


def test_stored_tables(spark, root):
    tables.append_batch(sensor(spark, (0, "Saw1", 1.0, 1.0)), root, "sensor_data", 0)
    found = tables.stored_names(spark, root, ["sensor_data", "alerts"])
    assert quality.missing_names(spark, ["sensor_data", "alerts"], found, "name").collect() == [("alerts",)]


def test_expired_days_are_dropped(spark, root):
    rows = sensor(spark, *[(d * 86400, "Saw1", float(d), 1.0) for d in range(10)])
    spark.sql(f"create database plant location '{root}/plant'")
    try:
        rows.withColumn("event_date", F.to_date("_time")).write.partitionBy("event_date").saveAsTable("plant.sensor_data")
        days = tables.expire_days(spark, "plant.sensor_data", "industrial_data", datetime(2024, 1, 10).date())
        assert days == ["2024-01-01", "2024-01-02"]
        assert sorted(r["temperature"] for r in spark.table("plant.sensor_data").collect()) == [float(d) for d in range(2, 10)]
    finally:
        spark.sql("drop database plant cascade")


def test_expired_days_of_stored_tables_are_deleted(spark, root):
    rows = sensor(spark, *[(d * 86400, "Saw1", float(d), 1.0) for d in range(10)])
    for batch in (0, 1):
        tables.append_batch(rows, root, "sensor_data", batch)
    gone = tables.expire_stored_days(spark, root, "sensor_data", "industrial_data", datetime(2024, 1, 10).date())
    assert gone == ["2024-01-01", "2024-01-02"]
    assert tables.read_table(spark, root, "sensor_data").count() == 16
    assert tables.days_of(spark, f"{root}/sensor_data", "event_date")[0] == "2024-01-03"


def test_a_fresh_checkpoint_is_a_new_run(spark, root):
    first, second = (tables.run_of(spark, f"{root}/{name}") for name in ("a", "b"))
    assert first != second and tables.run_of(spark, f"{root}/a") == first
    tables.append_batch(sensor(spark, (0, "Saw1", 1.0, 1.0)), root, "sensor_data", 0, run=first)
    tables.append_batch(sensor(spark, (0, "Lathe1", 2.0, 1.0)), root, "sensor_data", 0, run=second)
    tables.append_batch(sensor(spark, (0, "Lathe1", 3.0, 1.0)), root, "sensor_data", 0, run=second)
    assert sorted(r["temperature"] for r in tables.read_table(spark, root, "sensor_data").collect()) == [1.0, 3.0]


def test_stored_and_empty_tables_have_one_layout(spark, root):
    empty = tables.read_table(spark, root, "sensor_data")
    tables.append_batch(sensor(spark, (0, "Saw1", 1.0, 1.0)), root, "sensor_data", 0)
    assert tables.read_table(spark, root, "sensor_data").schema == empty.schema


def merge(spark, root, rows, now="2024-01-04 00:00:00", lookback="3 days"):
    start, stop = tables.bounds(rows, now, lookback)
    tables.merge_windows(rollups.hourly_means(rows, now, lookback, "0 hours", fields=["temperature"]), root, "h", start, stop)
    stored = tables.read_windows(spark, root, "h")
    return sorted(r["_time"] for r in stored.collect()) if stored else []


def test_a_merge_that_yields_less_leaves_nothing_behind(spark, root):
    rows = sensor(spark, *[(d * 86400 + h * 3600, "Saw1", 1.0, 1.0) for d in range(3) for h in (1, 5)])
    assert len(merge(spark, root, rows)) == 6
    assert merge(spark, root, rows.where("_time < '2024-01-02'")) == [at(2 * 3600), at(6 * 3600)]
    assert merge(spark, root, rows.where("temperature > 5")) == []
    assert len(merge(spark, root, rows)) == 6
    assert len(merge(spark, root, rows.limit(0), "2024-01-02 00:00:00", "1 day")) == 4


def test_a_second_merge_is_refused_while_one_runs(spark, root):
    rows = sensor(spark, (0, "Saw1", 1.0, 1.0))
    folder, files = tables._folder(spark, f"{root}/h.lock")
    files.createNewFile(folder)
    with pytest.raises(RuntimeError):
        merge(spark, root, rows)
    files.delete(folder, False)
    assert len(merge(spark, root, rows)) == 1


def test_processing_that_reaches_over_the_edges_counts(spark):
    columns = "event_id bigint, _time timestamp, machine string, event_type string, piece_id string, tool string"
    rows = spark.createDataFrame(
        [(0, at(-7200), "a", "processing_start", "P", None), (1, at(3600), "a", "processing_end", "P", None),
         (2, at(7200), "a", "processing_start", "Q", None), (3, at(100_000), "a", "processing_end", "Q", None)], columns)
    found = reports.availability(rows, "2024-01-02 00:00:00").first()["availability_pct"]
    assert found == pytest.approx(100 * 23 / 24)


def test_counts_include_text_and_undeclared_fields(spark):
    rows = spark.createDataFrame(
        [(1.0, "ok", {"x": 1.0, "y": None}), (None, None, None)], "temperature double, status string, extra_fields map<string,double>")
    counts = quality.measurement_counts({"sensor_data": (rows, ["temperature", "status", "extra_fields"])}, ["sensor_data"])
    assert counts.collect() == [("sensor_data", 3)]


def test_gaps_of_one_field(spark):
    rows = sensor(spark, (0, "Saw1", 1.0, 1.0), (8, "Saw1", None, 1.0), (16, "Saw1", 2.0, 1.0))
    assert quality.gaps(rows, ["machine"]).count() == 0
    assert [r["elapsed"] for r in quality.gaps(rows, ["machine"], field="temperature").collect()] == [16]


def test_limits_are_checked_however_they_are_made():
    from plantspark.functions.rules import Thresholds

    for wrong in ({"temperature_warning": -1.0}, {"power_critical": 1.0}, {"milling_rpm": (5.0, 1.0)}):
        with pytest.raises(ValueError):
            Thresholds(**wrong)


def test_hourly_means_of_every_field(spark):
    rows = spark.createDataFrame(
        [(at(10), "Saw1", 1.0, {"coolant": 4.0}), (at(20), "Saw1", 3.0, {"coolant": 6.0})],
        "_time timestamp, machine string, temperature double, extra_fields map<string,double>")
    found = rollups.hourly_means_long(rows, "2024-01-01 02:00:00", by=["machine"], fields=["temperature"])
    assert sorted((r["_field"], r["_value"]) for r in found.collect()) == [("coolant", 5.0), ("temperature", 2.0)]
