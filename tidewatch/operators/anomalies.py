"""Anomaly rules on year-over-year changes of ratio metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import MonitorConfig, RatioMetric
from tidewatch.functions.text import literal, quoted
from tidewatch.operators.ranking import add_global_rank

HIGH, MEDIUM = "high", "medium"
ANOMALY_COLUMNS = (
    "rank",
    "metric",
    "metric_label",
    "dimension",
    "comparison",
    "current_value",
    "prior_value",
    "pct_change",
    "threshold",
    "severity",
    "direction",
    "dim_type",
)


def by_metric(detail: DataFrame, config: MonitorConfig, by: Sequence[str] = ()) -> DataFrame:
    """The detail frame with one row per dimension value and ratio metric; keeps the columns ``by``."""
    have = set(detail.columns)

    def number(column: str, name: str) -> str:
        return f"CAST({quoted(column) if column in have else 'NULL'} AS DOUBLE) AS {name}"

    def row(position: int, metric: RatioMetric) -> str:
        fields = [
            f"{position} AS metric_order",
            f"{literal(metric.key)} AS metric",
            f"{literal(metric.label)} AS metric_label",
            number(metric.key, "current_value"),
            number(f"{metric.key}_yoy_prior", "prior_value"),
            number(f"{metric.key}_yoy", "pct_change"),
            number(metric.denominator, "denominator"),
            f"{literal(metric.direction)} AS direction",
        ]
        return f"struct({', '.join(fields)})"

    # Without ratio metrics there is nothing to flag: an empty frame of the usual shape.
    nothing = RatioMetric("", "", "", "")
    rows = ", ".join(row(i, m) for i, m in enumerate(config.metrics or (nothing,)))
    spread = detail if config.metrics else detail.limit(0)
    return spread.selectExpr(*by, "metric_date", "dim_type", "dimension", f"inline(array({rows}))")


def detect_anomalies(
    detail: DataFrame, config: MonitorConfig, by: Sequence[str] = ()
) -> DataFrame:
    """Harmful moves beyond the threshold, with their ``rank``: high first, then the largest.

    Ties keep metric order, then level order, then dimension. Without ``yoy`` among the
    comparisons there is nothing to flag (T13); volumes and week-over-week moves are never
    flagged (T12). Ranks start anew for every value of the columns ``by``.
    """
    threshold = float(config.rules.yoy_threshold)
    flagged = by_metric(detail, config, by).filter(
        f"(denominator IS NULL OR denominator >= {config.rules.min_denominator})"
        f" AND abs(pct_change) > {threshold!r}D"
        " AND CASE direction WHEN 'up' THEN pct_change < 0 ELSE pct_change > 0 END"
    )
    high = f"abs(pct_change) > {2 * threshold!r}D"
    levels = ", ".join(literal(level) for level in config.dimensions)
    keyed = flagged.selectExpr(
        "*",
        "'yoy' AS comparison",
        f"{threshold!r}D AS threshold",
        f"CASE WHEN {high} THEN '{HIGH}' ELSE '{MEDIUM}' END AS severity",
        f"CASE WHEN {high} THEN 0 ELSE 1 END AS severity_order",
        f"array_position(array({levels}), dim_type) AS level_order",
    )
    size = (-F.abs("pct_change")).alias("size")
    order = [F.col("severity_order"), size, *map(F.col, ("metric_order", "level_order", "dimension"))]
    ranked = add_global_rank(keyed, order, by=by)
    return ranked.select(*by, *ANOMALY_COLUMNS)


def anomaly_counts(anomalies: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``anomaly_count, high_count, medium_count`` in one row, or one per value of ``by`` that has any
    anomaly (A6)."""
    return anomalies.groupBy(*by).agg(
        F.count("*").alias("anomaly_count"),
        F.count_if(F.col("severity") == HIGH).alias("high_count"),
        F.count_if(F.col("severity") == MEDIUM).alias("medium_count"),
    )


def small_denominators(detail: DataFrame, config: MonitorConfig) -> DataFrame:
    """Whether each ratio rests on fewer than ``min_denominator`` cases."""
    return by_metric(detail, config).select(
        "dim_type",
        "dimension",
        "metric",
        "denominator",
        (F.col("denominator") < config.rules.min_denominator).alias("small_denominator"),
    )
