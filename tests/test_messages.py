"""Decoding, routing, normalising and refusing single messages."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plantspark.operators import normalise
from plantspark.sources import messages as bus
from plantspark.streaming.ingest import checked, outputs

ARRIVED = datetime(2025, 6, 2, 15, 0)
STAMP = "2025-06-02T14:30:00"


def batch(spark, *pairs):
    rows = [(topic, body if isinstance(body, str) else json.dumps(body), ARRIVED) for topic, body in pairs]
    return spark.createDataFrame(rows, bus.MESSAGE)


def reasons(spark, *pairs, **options):
    rows = checked(batch(spark, *pairs), **options).select("payload", "kind", "reason").collect()
    return [(r["kind"], r["reason"]) for r in rows]


def sensor(data, **envelope):
    return "/plant/data/Milling1", {"entity": "Milling1", "data": data, "timestamp": STAMP, **envelope}


def event(name, data=None, entity="Milling1", **envelope):
    body = {"entity": entity, "event": name, "timestamp": STAMP, **envelope}
    return "/plant/tracking/x", body if data is None else {**body, "data": data}


def piece(name, data, **envelope):
    return event(name, data, entity="piece", **envelope)


def test_topics(spark):
    topics = ["/plant/data/a", "/plant/data/a/b", "/plant/tracking/x", "/plant/other/x", "x/plant/data/a"]
    rows = spark.createDataFrame([(t, "", ARRIVED) for t in topics], bus.MESSAGE)
    assert [r["topic"] for r in bus.subscribed(rows).collect()] == ["/plant/data/a", "/plant/tracking/x"]


def test_bus_records(spark):
    rows = spark.createDataFrame([(bytearray(b"/plant/data/a"), bytearray(b"{}"), ARRIVED)], "key binary, value binary, timestamp timestamp")
    assert bus.from_bus_records(rows).first() == ("/plant/data/a", "{}", ARRIVED)


def test_routing(spark):
    assert reasons(
        spark, sensor({"temperature": 1}), event("setup_start"), piece("move_start", {"piece_id": "PZ001"}),
        event("deposit", {"piece_id": "PZ001"}, entity="Warehouse_01"), event("deposit", {}, entity="Warehouse_01"),
        ("/plant/alerts/x", {"entity": "a"}), ("/plant/data/a", "{bad"), ("/plant/data/a", ""),
    ) == [
        ("sensor", None), ("machine", None), ("piece", None), ("piece", None), ("machine", None),
        ("unknown", "unknown_topic"), ("bad_json", "bad_json"), ("bad_json", "bad_json"),
    ]
    strict = reasons(spark, event("deposit", {"piece_id": "PZ001"}, entity="Warehouse_01"), deposit_as_piece=False)
    assert strict == [("machine", None)]


@pytest.mark.parametrize("message, reason", [
    (("/plant/data/a", [1]), "not_object"),
    (("/plant/data/a", '"text"'), "not_object"),
    (sensor({"a": 1}, entity=None), "missing_entity"),
    (sensor({"a": 1}, entity=""), "missing_entity"),
    (sensor({"a": 1}, entity=5), "bad_entity"),
    (sensor({}), "missing_data"),
    (sensor(None), "missing_data"),
    (sensor([1]), "bad_data"),
    (sensor("text"), "bad_data"),
    (sensor({"a": 1}, timestamp=5), "bad_timestamp"),
    (sensor({"a": 1}, timestamp=0), None),
    (sensor({"a": 1}, timestamp=None), None),
    (event("setup_end", {}), None),
    (event("setup_end"), None),
    (event(None, {}), "missing_event"),
    (event("x", {}, entity=""), "missing_entity"),
    (event(7, {}), "bad_event"),
    (event("x", {"duration": "3.5"}), None),
    (event("x", {"duration": "abc"}), "bad_duration"),
    (event("x", {"duration": None}), "bad_duration"),
    (event("x", {"duration": True}), None),
    (event("x", {"tool_wear": "worn"}), "bad_tool_wear"),
    (event("processing_end", {"cycle_time": "x"}), "bad_cycle_time"),
    (event("processing_start", {"cycle_time": "x"}), None),
    (piece("move_start", {}), "missing_data"),
    (piece("move_start", {"from": "Saw1"}), "missing_piece_id"),
    (piece("move_start", {"piece_id": 5}), "bad_piece_id"),
    (piece("move_start", {"piece_id": "PZ001", "duration": "x"}), None),
    (piece("move_end", {"piece_id": "PZ001", "duration": "x"}), "bad_duration"),
])
def test_refusals(spark, message, reason):
    assert reasons(spark, message)[0][1] == reason


def test_numeric_fields_keep_json_types_apart(spark):
    rows = checked(batch(spark, sensor({"a": True, "b": "5", "c": None, "d": 1, "e": {"x": 1}, "f": [1], "g": 91.0})))
    found = {r["_field"]: r["_value"] for r in normalise.numeric_fields_long(rows).collect()}
    assert found == {"a": 1.0, "d": 1.0, "g": 91.0}


def test_repeated_key_keeps_the_last_value(spark):
    rows = checked(batch(spark, ("/plant/data/a", '{"entity":"a","data":{"power":1,"power":2}}')))
    assert normalise.sensor_readings(rows).first()["power"] == 2.0


def test_sensor_row(spark):
    data = {"temperature": 95.5, "power": 0.05, "rpm_spindle": 2800, "vibration_level": 1.8, "spare": 7, "note": "x"}
    row = normalise.sensor_readings(checked(batch(spark, sensor(data)))).first()
    assert (row["_time"], row["machine"], row["machine_type"], row["location"]) == (
        datetime(2025, 6, 2, 14, 30), "Milling1", "Milling", "workshop_A")
    assert (row["temperature"], row["rpm_spindle"], row["feed_rate"], row["extra_fields"]) == (95.5, 2800.0, None, {"spare": 7.0})
    assert [a["rule"] for a in row["anomalies"]] == ["temperature", "power"]
    assert row["ts_defaulted"] is False


def test_time_defaults_to_arrival(spark):
    rows = normalise.sensor_readings(checked(batch(
        spark, sensor({"a": 1}, timestamp="2025-06-02"), sensor({"a": 1}, timestamp=None),
        sensor({"a": 1}, timestamp="2025-06-02 14:30:10"))))
    assert [(r["_time"], r["ts_defaulted"]) for r in rows.collect()] == [
        (ARRIVED, True), (ARRIVED, True), (datetime(2025, 6, 2, 14, 30, 10), False)]


@pytest.mark.parametrize("name, data, expected", [
    ("setup_start", {"tool": "TM10"}, (0.0, "active", "TM10", None)),
    ("setup_end", {}, (None, "completed", None, None)),
    ("restart_check", {}, (0.0, "unknown", None, None)),
    ("check", {"status": "error", "duration": 2}, (2.0, "error", None, None)),
    ("check", {"status": None}, (None, None, None, None)),
    ("processing_end", {"cycle_time": "4.5", "tool": None}, (None, "completed", None, 4.5)),
    ("processing_start", {"cycle_time": 4.5, "tool": 7}, (0.0, "active", "7", None)),
])
def test_machine_event_fields(spark, name, data, expected):
    row = normalise.machine_events(checked(batch(spark, event(name, data)))).first()
    assert (row["duration"], row["status"], row["tool"], row["cycle_time"]) == expected


def test_null_tags_can_be_written_out(spark):
    rows = checked(batch(spark, event("x", {"tool": None}), event("x", {})))
    assert [r["tool"] for r in normalise.machine_events(rows, null_text="None").collect()] == ["None", None]


@pytest.mark.parametrize("name, data, expected", [
    ("move_start", {"from": "Warehouse", "to": "Saw1", "duration": 9}, (0.0, 30.0, 3)),
    ("move_end", {"from": "Milling1", "to": "Saw1", "duration": "2.5", "priority": 1}, (2.5, 25.0, 1)),
    ("move_end", {"from": None, "to": "Saw1"}, (None, 30.0, 3)),
    ("move_end", {"from": "Saw1"}, (None, None, 3)),
    ("deposit", {"priority": None}, (None, None, None)),
])
def test_piece_fields(spark, name, data, expected):
    row = normalise.piece_movements(checked(batch(spark, piece(name, {"piece_id": "PZ010", **data})))).first()
    assert (row["duration"], row["distance"], row["priority"]) == expected
    assert row["material"] == "alu"


def test_round_trip_of_readings(spark):
    from plantspark.sources import benchmark_views as views

    source = views.view(views.events(spark, "/root/testdata/sf0.001"), views.SENSOR_WIDE)
    messages = source.select(
        F.concat(F.lit("/plant/data/"), "machine").alias("topic"),
        F.expr("""to_json(named_struct('entity', machine, 'data', named_struct('temperature', temperature,
          'power', power), 'timestamp', date_format(_time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))""").alias("payload"),
        F.current_timestamp().alias("arrived_at"),
    )
    fields = ["_time", "machine", "temperature", "power"]
    back = normalise.sensor_readings(checked(messages)).select(*fields)
    sent = source.withColumn("_time", F.col("_time").cast("timestamp")).select(*fields)
    assert back.exceptAll(sent).count() == 0 and back.count() == sent.count() == 1000


def test_every_message_leads_to_one_row_or_one_refusal(spark):
    from plantspark.sources import benchmark_views as views

    rows = checked(views.messages(views.events(spark, "/root/testdata/sf0.001")))
    counts = {name: part.count() for name, part, _ in outputs(rows)}
    assert sum(n for name, n in counts.items() if name != "alerts") == 1000
    assert all(counts.values())


def test_numbers_that_json_lacks_are_read_as_null(spark):
    payloads = ['{"entity":"a","data":{"power":NaN,"temperature":5,"note":"NaN, Infinity"}}', '{"entity":"a","data":{"power":-Infinity}}', '{"entity":NaNs}']
    rows = batch(spark, *[("/plant/data/a", p) for p in payloads])
    found = checked(rows).select("reason", F.expr(bus.numeric_fields()).alias("numbers"), F.expr("try_variant_get(body['note'], '$', 'string')").alias("note"))
    assert [tuple(r) for r in found.collect()] == [(None, {"temperature": 5.0}, "NaN, Infinity"), (None, {}, None), ("bad_json", None, None)]


def test_bus_reader_takes_a_backlog_in_portions():
    options = bus.bus_options("host:1", "plant", max_offsets=10)
    assert options["subscribe"] == "plant" and options["maxOffsetsPerTrigger"] == "10"
