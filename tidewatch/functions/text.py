"""SQL for number and record formats in reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MISSING = "n/a"


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(name: str) -> str:
    """A column name in SQL, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def _or_missing(value: str, text: str) -> str:
    return f"CASE WHEN {value} IS NOT NULL THEN {text} ELSE '{MISSING}' END"


def signed_percent(value: str) -> str:
    """``+12.3%``."""
    return _or_missing(value, f"format_string('%+.1f%%', ({value}) * 100)")


def percent(value: str, digits: int) -> str:
    return _or_missing(value, f"format_string('%.{digits}f%%', ({value}) * 100)")


def whole(value: str) -> str:
    """``1,234``."""
    return _or_missing(value, f"format_number({value}, 0)")


def grouped(value: str) -> str:
    """``1,234.50``."""
    return _or_missing(value, f"format_number({value}, 2)")


def money(value: str) -> str:
    return _or_missing(value, f"concat('$', format_number({value}, 2))")


def four_places(value: str) -> str:
    return _or_missing(value, f"format_string('%.4f', {value})")


STYLES = {"count": whole, "money": money, "ratio": four_places}


def record_json(df: DataFrame) -> str:
    """A row as indented JSON: NULL fields left out, fractions rounded to 4 places."""
    fields = [
        f"round({quoted(field.name)}, 4) AS {quoted(field.name)}"
        if isinstance(field.dataType, T.FractionalType)
        else quoted(field.name)
        for field in df.schema
    ]
    return f"to_json(struct({', '.join(fields)}), map('pretty', 'true'))"
