"""Numbers and their text forms."""

from __future__ import annotations

_NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def number_from_text(text: str) -> str:
    """Double read from text; NULL unless the whole text is a number."""
    return f"if({text} rlike r'{_NUMBER_TEXT}', try_cast({text} as double), null)"


def number_text(value: str) -> str:
    """Shortest text of a double: plain digits from 1e-4 up to 1e16, exponent form outside."""
    raw = f"cast({value} as string)"
    digits = f"cast(try_cast({raw} as decimal(38,18)) as string)"
    plain = f"regexp_replace(regexp_replace({digits}, '0+$', ''), r'\\.$', '.0')"
    mantissa = f"regexp_replace(split_part({raw}, 'E', 1), r'\\.0$', '')"
    power = f"cast(split_part({raw}, 'E', 2) as int)"
    exponent = (
        f"concat({mantissa}, 'e', if({power} < 0, '-', '+'), if(abs({power}) < 10, '0', ''), abs({power}))"
    )
    return (
        f"case when not contains({raw}, 'E') then {raw}"
        f" when abs({value}) >= 1e-4d and abs({value}) < 1e16d then {plain} else {exponent} end"
    )


def gibibytes(size: str) -> str:
    """Bytes as GiB with two decimals."""
    return f"round({size} / 1073741824d, 2)"
