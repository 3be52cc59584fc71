"""Anomaly rules: each gives a struct (rule, severity, label, value, unit), or NULL when it is silent.

The message is made of label, value and unit. Writing the number costs more than all the rules, so
it is only done where a message is asked for.
"""

from __future__ import annotations

from dataclasses import dataclass

from plantspark.functions.numbers import number_text


@dataclass(frozen=True)
class Thresholds:
    """Limits of the rules; every comparison is strict. The defaults are fixed values."""

    temperature_warning: float = 80.0
    temperature_critical: float = 90.0
    vibration_warning: float = 2.5
    vibration_critical: float = 3.0
    power_warning: float = 5.0
    power_critical: float = 8.0
    power_low: float = 0.1
    milling_rpm: tuple[float, float] = (1000.0, 4000.0)
    lathe_rpm: tuple[float, float] = (500.0, 3000.0)

    @classmethod
    def from_settings(cls, temperature: tuple[float, float] = (80.0, 90.0),
                      vibration: tuple[float, float] = (2.5, 3.0), power_warning: float = 5.0) -> Thresholds:
        """Limits as an operator configures them: power turns critical at 1.5 times its warning."""
        return cls(*temperature, *vibration, power_warning, power_warning * 1.5)

    def __post_init__(self) -> None:
        self.validate()

    def validate(self) -> None:
        """Refuse limits that could never make sense."""
        problems = []
        for name in ("temperature", "vibration", "power"):
            warning, critical = getattr(self, f"{name}_warning"), getattr(self, f"{name}_critical")
            if warning <= 0:
                problems.append(f"{name} warning must be positive")
            if critical <= warning:
                problems.append(f"{name} critical must be higher than warning")
        for name in ("milling", "lathe"):
            low, high = getattr(self, f"{name}_rpm")
            if low >= high:
                problems.append(f"{name} rpm limits must be in order")
        if problems:
            raise ValueError("; ".join(problems))


DEFAULTS = Thresholds()


def _anomaly(rule: str, value: str, unit: str, *cases: tuple[str, str, str]) -> str:
    """Struct of the first (condition, severity, label) whose condition holds."""
    found = " ".join(
        f"when {condition} then named_struct('rule', '{rule}', 'severity', '{severity}', 'label', '{label}',"
        f" 'value', {value}, 'unit', '{unit}')"
        for condition, severity, label in cases
    )
    return f"case {found} end"


def _sql(limit: float | str) -> str:
    """A limit as SQL: a number, or an expression where limits come from a table."""
    return limit if isinstance(limit, str) else f"{limit}d"


def _above(value: str, limit: float | str) -> str:
    # Spark orders NaN above every number; a NaN reading must not trip a rule.
    return f"({value} > {_sql(limit)} and not isnan({value}))"


# The label texts and units of the rules below.


def temperature_rule(value: str = "temperature", limits: Thresholds = DEFAULTS) -> str:
    return _anomaly(
        "temperature", value, "°C",
        (_above(value, limits.temperature_critical), "critical", "Critical temperature: "),
        (_above(value, limits.temperature_warning), "warning", "High temperature: "),
    )


def vibration_rule(value: str = "vibration_level", limits: Thresholds = DEFAULTS) -> str:
    return _anomaly(
        "vibration", value, "g",
        (_above(value, limits.vibration_critical), "critical", "Critical vibration: "),
        (_above(value, limits.vibration_warning), "warning", "High vibration: "),
    )


def power_rule(value: str = "power", limits: Thresholds = DEFAULTS) -> str:
    return _anomaly(
        "power", value, "kW",
        (_above(value, limits.power_critical), "critical", "Critical power consumption: "),
        (_above(value, limits.power_warning), "warning", "High power consumption: "),
        (f"{value} < {_sql(limits.power_low)}", "warning", "Suspiciously low power: "),
    )


def rpm_rule(value: str = "rpm_spindle", kind: str = "machine_type", limits: Thresholds = DEFAULTS) -> str:
    def outside(name: str, bounds: tuple[float, float]) -> str:
        return f"({kind} = '{name}' and ({_above(value, bounds[1])} or {value} < {_sql(bounds[0])}))"

    return _anomaly(
        "rpm", value, "",
        (outside("Milling", limits.milling_rpm), "warning", "Abnormal RPM for milling: "),
        (outside("Lathe", limits.lathe_rpm), "warning", "Abnormal RPM for lathe: "),
    )


def anomalies(temperature: str = "temperature", vibration: str = "vibration_level", power: str = "power",
              rpm: str = "rpm_spindle", kind: str = "machine_type", limits: Thresholds = DEFAULTS) -> str:
    """All anomalies of one reading, in rule order; an empty array when there are none."""
    found = ", ".join([
        temperature_rule(temperature, limits), vibration_rule(vibration, limits),
        power_rule(power, limits), rpm_rule(rpm, kind, limits),
    ])
    return f"array_compact(array({found}))"


def message(anomaly: str) -> str:
    """Text of an anomaly."""
    return f"concat({anomaly}.label, {number_text(f'{anomaly}.value')}, {anomaly}.unit)"


def described(anomaly: str) -> str:
    """An anomaly as it is stored: rule, severity, message, value."""
    return (
        f"named_struct('rule', {anomaly}.rule, 'severity', {anomaly}.severity,"
        f" 'message', {message(anomaly)}, 'value', {anomaly}.value)"
    )


def alert_table(rule: str) -> str:
    """Measurement an alert is stored under."""
    return (
        f"case {rule} when 'temperature' then 'temperature_alerts'"
        f" when 'vibration' then 'vibration_alerts' else 'system_alerts' end"
    )
