"""Why revenue moved: drivers and channels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import COMPARISON_DAYS, GrowthModel
from tidewatch.functions import pct_change, safe_ratio
from tidewatch.functions.text import quoted

DRIVERS = ("top_of_funnel", "conversion", "monetization")


def _factors(growth: GrowthModel, suffix: str) -> dict[str, str]:
    visitors, orders, revenue = (
        quoted(name + suffix) for name in (growth.visitors, growth.orders, growth.revenue)
    )
    return {
        "top_of_funnel": f"CAST({visitors} AS DOUBLE)",
        "conversion": safe_ratio(orders, visitors),
        "monetization": safe_ratio(revenue, orders),
    }


def growth_decomposition(summary: DataFrame, growth: GrowthModel) -> DataFrame:
    """One row per driver of ``revenue = visitors * conversion * monetization``.

    ``share`` is the driver's part of the logarithm of revenue growth and ``contribution`` that
    share of the year-over-year change, so contributions add up to the change. Both are NULL
    unless every factor is positive on both days and revenue moved.
    """
    now, then = _factors(growth, ""), _factors(growth, "_yoy_prior")
    rows = [
        f"struct({i + 1} AS position, '{driver}' AS driver, {now[driver]} AS factor_current,"
        f" {then[driver]} AS factor_prior)"
        for i, driver in enumerate(DRIVERS)
    ]
    now_revenue, then_revenue = quoted(growth.revenue), quoted(f"{growth.revenue}_yoy_prior")
    revenue, prior = f"CAST({now_revenue} AS DOUBLE)", f"CAST({then_revenue} AS DOUBLE)"
    positive = " AND ".join(f"({factor}) > 0" for factor in [*now.values(), *then.values()])
    unpivoted = summary.selectExpr(
        f"CASE WHEN {positive} AND {revenue} <> {prior} THEN ln({revenue} / {prior}) END AS log_growth",
        f"{pct_change(now_revenue, then_revenue)} AS revenue_yoy",
        f"inline(array({', '.join(rows)}))",
    )
    share = "CASE WHEN log_growth IS NOT NULL THEN ln(factor_current / factor_prior) / log_growth END"
    return unpivoted.selectExpr(
        "position",
        "driver",
        "factor_current",
        "factor_prior",
        f"{pct_change('factor_current', 'factor_prior')} AS factor_yoy",
        f"{share} AS share",
        f"{share} * revenue_yoy AS contribution",
        "revenue_yoy",
    )


def channel_contribution(
    daily: DataFrame, anchor: dt.date, revenue: str = "revenue", level: str = "channel"
) -> DataFrame:
    """Each channel's part of the overall year-over-year change of revenue.

    Works on the daily frame, not on detail, because channels seen only a year ago count as
    well. A channel absent on one of the days has revenue 0 there.
    """
    prior_day = anchor - dt.timedelta(days=COMPARISON_DAYS["yoy"])

    def on_day(day: dt.date) -> Column:
        return F.sum(F.when(F.col("metric_date") == F.lit(day), F.col(revenue)))

    zero = F.lit(0)
    channels = (
        daily.filter(
            (F.col("dim_type") == level) & F.col("metric_date").isin(F.lit(anchor), F.lit(prior_day))
        )
        .groupBy("dimension")
        .agg(
            F.coalesce(on_day(anchor), zero).cast("double").alias("revenue"),
            F.coalesce(on_day(prior_day), zero).cast("double").alias("revenue_yoy_prior"),
        )
    )
    overall_prior = (
        daily.filter(
            (F.col("dim_type") == "overall") & (F.col("metric_date") == F.lit(prior_day))
        )
        .agg(F.sum(revenue).cast("double"))
        .scalar()
    )
    moved = F.col("revenue") - F.col("revenue_yoy_prior")
    return channels.withColumn("contribution", moved / F.nullif(overall_prior, F.lit(0.0)))
