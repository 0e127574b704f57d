"""SQL for ratios and changes. A missing value is always NULL, never NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _double(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def missing_if_nan(column: Column, dtype: T.DataType) -> Column:
    """NULL for NaN in floating columns; other types pass through."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(column), column)
    return column


def safe_ratio(numerator: str, denominator: str) -> str:
    """``numerator / denominator`` where the denominator is positive, else NULL."""
    return f"CASE WHEN {denominator} > 0 THEN {_double(numerator)} / {_double(denominator)} END"


def pct_change(current: str, prior: str) -> str:
    """``(current - prior) / prior``; NULL when the prior is missing or 0.

    The divisor keeps its sign, so growth from a negative base looks negative (T7).
    """
    return f"({_double(current)} - {_double(prior)}) / nullif({_double(prior)}, 0D)"


def relative_difference(ours: str, theirs: str) -> str:
    """``abs(ours - theirs) / abs(theirs)``; NULL when theirs is 0."""
    return f"abs({_double(ours)} - {_double(theirs)}) / nullif(abs({_double(theirs)}), 0D)"
