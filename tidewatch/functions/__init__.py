"""Column expressions shared by the operators. All are built-in Spark functions."""

from tidewatch.functions.dates import DateWindow, as_date, business_date, day_start_utc
from tidewatch.functions.numbers import (
    missing_if_nan,
    pct_change,
    relative_difference,
    safe_ratio,
)

__all__ = [
    "DateWindow",
    "as_date",
    "business_date",
    "day_start_utc",
    "missing_if_nan",
    "pct_change",
    "relative_difference",
    "safe_ratio",
]
