"""Boundary values of the anomaly rules and the small derivations."""

import pytest
from pyspark.sql import functions as F

from plantspark.functions import numbers, panels, plant, rules
from plantspark.functions.stamps import parse_timestamp
from plantspark.operators.alerts import alerts, anomaly_stats, with_anomalies


def evaluate(spark, expression, values, schema):
    rows = spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], schema)
    return [r[0] for r in rows.select(F.expr(expression).alias("x")).collect()]


@pytest.mark.parametrize("rule, cases", [
    (rules.temperature_rule("v"), {80.0: None, 80.01: "warning", 90.0: "warning", 90.01: "critical"}),
    (rules.vibration_rule("v"), {2.5: None, 2.51: "warning", 3.0: "warning", 3.01: "critical"}),
    (rules.power_rule("v"), {0.09: "warning", 0.1: None, 5.0: None, 5.01: "warning", 8.0: "warning", 8.01: "critical"}),
])
def test_limits_are_strict(spark, rule, cases):
    found = evaluate(spark, rule, list(cases), "v double")
    assert [f and f["severity"] for f in found] == list(cases.values())


def test_rpm_depends_on_machine_type(spark):
    cases = [
        ("Milling", 4000.0, None), ("Milling", 4001.0, "warning"), ("Milling", 999.0, "warning"),
        ("Milling", 1000.0, None), ("Lathe", 499.0, "warning"), ("Lathe", 500.0, None), ("Lathe", 3001.0, "warning"),
        ("Lathe", 3000.0, None), ("Saw", 99999.0, None), ("Unknown", 0.0, None),
    ]
    found = evaluate(spark, rules.rpm_rule("v", "t"), [c[:2] for c in cases], "t string, v double")
    assert [f and f["severity"] for f in found] == [c[2] for c in cases]


def test_missing_and_nan_readings_are_silent(spark):
    for rule in (rules.temperature_rule("v"), rules.vibration_rule("v"), rules.power_rule("v")):
        assert evaluate(spark, rule, [None, float("nan")], "v double") == [None, None]


def test_messages(spark):
    def stored(rule, values):
        return evaluate(spark, f"transform(array({rule}), a -> {rules.described('a')})[0]", values, "v double")

    assert stored(rules.temperature_rule("v"), [95.5, 85.0]) == [
        ("temperature", "critical", "Critical temperature: 95.5°C", 95.5),
        ("temperature", "warning", "High temperature: 85.0°C", 85.0),
    ]
    assert [a["message"] for a in stored(rules.power_rule("v"), [9.0, 6.0, 0.0002, 0.00001])] == [
        "Critical power consumption: 9.0kW", "High power consumption: 6.0kW",
        "Suspiciously low power: 0.0002kW", "Suspiciously low power: 1e-05kW"]


@pytest.mark.parametrize("value", [
    0.0, -0.0, 1.0, 85.25, 0.001, 0.0002, -0.00025, 1e-5, 1.5e-7, 12345678.9, 1e7, 123456789012345.0, 1e15,
    1e16, 1e22, -3.5e300,
])
def test_number_text_is_shortest_form(spark, value):
    assert evaluate(spark, numbers.number_text("v"), [value], "v double") == [repr(value)]


def test_numbers_from_text(spark):
    texts = ["3.5", " 3.5 ", "1e3", "-.5", "abc", "3.5d", "", "1_0", "0x10", "5."]
    assert evaluate(spark, numbers.number_from_text("v"), texts, "v string") == [
        3.5, 3.5, 1000.0, -0.5, None, None, None, None, None, 5.0]


def test_stamps(spark):
    cases = {
        "2025-06-02T14:30:00Z": "2025-06-02 14:30:00", "2025-06-02T14:30:00+02:00": "2025-06-02 12:30:00",
        "2025-06-02T14:30:00.25": "2025-06-02 14:30:00.25", "2025-06-02T14:30": "2025-06-02 14:30:00",
        "20250602T143000": "2025-06-02 14:30:00", "2025-06-02 14:30:10": "2025-06-02 14:30:10",
        "2025-06-02T14:30:00,5": "2025-06-02 14:30:00.5", "2025-06-02": None, "2025-06-02 14:30:10.5": None,
        "T14:30:00": None, "Tuesday": None, "2025-6-2T1:2:3": None, "2025-13-02T14:30:00": None, "": None,
    }
    found = evaluate(spark, f"cast({parse_timestamp('v')} as string)", list(cases), "v string")
    assert dict(zip(cases, found)) == cases


def test_names(spark):
    assert evaluate(spark, plant.machine_type("v"), ["MILLING_7", "xLathe", "saw-milling", "Drill"], "v string") == [
        "Milling", "Lathe", "Milling", "Unknown"]
    assert evaluate(spark, plant.piece_material("v"), ["PZ009", "PZ010", "PZ100"], "v string") == ["steel", "alu", None]
    pairs = [("Milling1", "Saw1"), ("Saw1", "Milling1"), ("Lathe1", "Milling1"), ("None", "Saw1"), ("Warehouse", "Lathe1")]
    assert evaluate(spark, plant.station_distance("a", "b"), pairs, "a string, b string") == [25.0, 25.0, 30.0, 30.0, 55.0]


def test_bands_apply_from_their_value(spark):
    assert evaluate(spark, panels.threshold_band("v", "temperature"), [69.9, 70.0, 85.0, None], "v double") == [
        "green", "yellow", "red", None]
    assert evaluate(spark, panels.threshold_band("v"), [79.0, 80.0], "v double") == ["green", "red"]
    assert evaluate(spark, panels.severity_label("v"), ["critical", "warning", "info"], "v string") == [
        "🔴 CRITICAL", "🟡 WARNING", "info"]


def test_thresholds_are_checked():
    assert rules.Thresholds.from_settings().power_critical == 7.5
    assert rules.DEFAULTS.power_critical == 8.0
    for wrong in ((0.0, 90.0), (80.0, 80.0)):
        with pytest.raises(ValueError):
            rules.Thresholds.from_settings(temperature=wrong)


def test_alerts_and_statistics(spark):
    readings = with_anomalies(spark.createDataFrame(
        [("2024-01-01 00:00:00", "Milling1", "Milling", 95.0, 0.05, 500.0), ("2024-01-01 00:00:03", "Saw1", "Saw", 20.0, 1.0, None)],
        "_time string, machine string, machine_type string, temperature double, power double, rpm_spindle double",
    ))
    found = alerts(readings).collect()
    assert [(a["_measurement"], a["severity"], a["rule"], a["resolved"]) for a in found] == [
        ("temperature_alerts", "critical", "temperature", False), ("system_alerts", "warning", "power", False),
        ("system_alerts", "warning", "rpm", False)]
    assert readings.where("machine = 'Saw1'").first()["anomalies"] == []
    assert anomaly_stats(readings, readings).first().asDict() == {
        "processed_count": 4, "anomaly_count": 1, "anomaly_rate": 0.25}
    assert anomaly_stats(readings.limit(0)).first()["anomaly_rate"] == 0.0
