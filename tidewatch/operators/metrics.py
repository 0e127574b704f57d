"""Ratio metrics (M4)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewatch.config import MonitorConfig
from tidewatch.functions import safe_ratio
from tidewatch.functions.text import quoted


def add_ratio_metrics(daily: DataFrame, config: MonitorConfig) -> DataFrame:
    """Add every ratio whose two columns the frame has; others are skipped."""
    have = set(daily.columns)
    ratios = [
        f"{safe_ratio(quoted(m.numerator), quoted(m.denominator))} AS {quoted(m.key)}"
        for m in config.metrics
        if m.numerator in have and m.denominator in have
    ]
    return daily.selectExpr("*", *ratios)
