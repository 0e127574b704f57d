"""Missing values and unusual monitors: NaN, odd column names, no ratio metrics, no mapped totals."""

from __future__ import annotations

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.config import (
    REVENUE_FUNNEL,
    AnomalyRules,
    ConfigError,
    MonitorConfig,
    MonitorRegistry,
    RatioMetric,
)
from tidewatch.operators.combine import ordered_daily
from tidewatch.plans.engine import Binding, MonitorEngine
from tidewatch.sources import SqlSource

DAY = dt.date(2024, 6, 3)
EARLIER = DAY - dt.timedelta(days=364)

CONFIG = MonitorConfig(
    key="odd",
    name="Odd",
    dimensions=("overall",),
    metrics=(RatioMetric("errors-per-view", "Errors", "errors seen", "views", "down"),),
    volume_metrics=("errors seen", "views"),
    rules=AnomalyRules(yoy_threshold=0.1, min_denominator=1),
    comparisons=("yoy",),
    sot_columns={"views": "total views"},
)


def result_of(spark, rows, config=CONFIG, sot=None):
    data = spark.createDataFrame(rows, "metric_date date, `errors seen` double, views double")
    text = "SELECT metric_date, {dimension} AS dimension, `errors seen`, views FROM {data}"
    source = SqlSource(spark, text, {"overall": {"dimension": "overall"}}, {"data": data})
    return MonitorEngine(MonitorRegistry(config), {config.key: Binding(source, sot)}).run(config.key, DAY)


def test_nan_is_missing_and_never_an_anomaly(spark):
    nan = float("nan")
    found = result_of(spark, [(DAY, nan, 10.0), (EARLIER, 1.0, 10.0)])
    row = found.detail.first()
    assert row["errors seen"] is None and row["errors-per-view"] is None
    assert found.anomalies.count() == 0
    flagged = result_of(spark, [(DAY, 5.0, 10.0), (EARLIER, 1.0, 10.0)]).anomalies.collect()
    assert [(r["metric"], r["severity"]) for r in flagged] == [("errors-per-view", "high")]


@pytest.mark.parametrize(("total", "want"), [(float("nan"), []), (10.0, [True]), (11.0, [False])])
def test_nan_in_the_source_of_truth_is_skipped(spark, total, want):
    sot = spark.createDataFrame([(DAY, total)], "metric_date date, `total views` double")
    found = result_of(spark, [(DAY, 1.0, 10.0)], sot=sot).validations
    assert [r["passed"] for r in found.collect()] == want


def test_source_of_truth_for_the_date_only(spark):
    sot = spark.createDataFrame([(DAY, 1.0)], "metric_date date, other double")
    assert result_of(spark, [(DAY, 1.0, 10.0)], sot=sot).validations.count() == 0


def test_no_ratio_metrics_flag_nothing(spark):
    config = dataclasses.replace(CONFIG, metrics=())
    assert result_of(spark, [(DAY, 1.0, 10.0)], config).anomalies.count() == 0


def test_growth_needs_its_comparison_and_ratio():
    assert dataclasses.replace(REVENUE_FUNNEL, comparisons=("wow",)).growth is None
    with pytest.raises(ConfigError, match="revenue per order"):
        dataclasses.replace(REVENUE_FUNNEL, metrics=REVENUE_FUNNEL.metrics[:1])


def test_a_result_lets_go_of_what_it_kept(spark):
    with result_of(spark, [(DAY, 1.0, 10.0)]) as found:
        assert found.summary.count() == 1


def test_daily_frame_is_handed_out_in_order(spark):
    rows = [(DAY, "b"), (EARLIER, "z"), (DAY, "a")]
    frame = spark.createDataFrame(rows, "metric_date date, dimension string").repartition(3)
    assert [tuple(r) for r in ordered_daily(frame).collect()] == [(EARLIER, "z"), (DAY, "a"), (DAY, "b")]
    assert ordered_daily(frame.where(F.lit(False))).count() == 0
