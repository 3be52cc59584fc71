"""Labels and colour bands shown next to values."""

from __future__ import annotations

# Fixed values: (yellow from, red from) per panel, and red from for any other panel.
BANDS = {"temperature": (70.0, 85.0), "power": (5.0, 8.0), "critical_alerts": (5.0, 10.0)}
DEFAULT_RED = 80.0

# How severities are written out.
SEVERITY_LABELS = {"critical": "🔴 CRITICAL", "warning": "🟡 WARNING"}

# The ranges a viewer can choose.
RANGE_PRESETS = {"30m": "30 minutes", "1h": "1 hour", "6h": "6 hours", "24h": "24 hours"}


def threshold_band(value: str, panel: str = "") -> str:
    """green / yellow / red; a step applies from its own value upwards."""
    yellow, red = BANDS.get(panel, (DEFAULT_RED, DEFAULT_RED))
    return f"case when {value} >= {red}d then 'red' when {value} >= {yellow}d then 'yellow' when {value} is not null then 'green' end"


def severity_label(severity: str = "severity") -> str:
    """Display text of a severity; unknown ones stay as they are."""
    cases = " ".join(f"when '{name}' then '{text}'" for name, text in SEVERITY_LABELS.items())
    return f"case {severity} {cases} else {severity} end"
