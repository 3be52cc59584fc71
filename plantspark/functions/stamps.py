"""Time stamps as messages carry them."""

from __future__ import annotations

# Extended ISO 8601; the offset may be Z, +hh, +hhmm or +hh:mm.
_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)?$"
_PLAIN = r"^\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}$"


def parse_timestamp(text: str) -> str:
    """Stamp of an ISO text with `T`, or of a plain `date time` text; NULL for anything else."""
    return (
        f"case when {text} rlike r'{_ISO}' then try_cast(replace({text}, ',', '.') as timestamp)"
        rf" when {text} rlike r'^\d{{8}}T\d{{6}}$' then try_to_timestamp({text}, 'yyyyMMdd\'T\'HHmmss')"
        f" when {text} rlike r'{_PLAIN}' then try_to_timestamp(regexp_replace({text}, r'\\s+', ' '), 'yyyy-M-d H:m:s') end"
    )
