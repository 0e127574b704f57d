"""Registry, date resolution, runs and SQL sources."""

import dataclasses
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewatch import Binding, MonitorEngine, MonitorRegistry, default_registry, resolve_report_date
from tidewatch.config import REVENUE_FUNNEL, ConfigError, MonitorConfig, parse_keys
from tidewatch.plans.engine import stack_anomalies, stack_details
from tidewatch.sources import SqlSource, run_sql
from tidewatch.functions import DateWindow

DAY = dt.date(2024, 6, 15)


def sot_of(spark, *days):
    rows = [(d, 1, 1, 1, 1.0) for d in days]
    return spark.createDataFrame(
        rows,
        "metric_date date, total_iv int, total_requests int, total_projects int, total_revenue double",
    )


def test_report_date(spark, caplog):
    sot = sot_of(spark, DAY, DAY - dt.timedelta(days=3))
    assert resolve_report_date(sot) == DAY
    assert resolve_report_date(sot, "") == DAY
    assert resolve_report_date(sot, "2024-06-12") == dt.date(2024, 6, 12)
    assert not caplog.records
    assert resolve_report_date(sot, "2030-01-01") == dt.date(2030, 1, 1)
    assert "not in the source of truth" in caplog.text
    with pytest.raises(ValueError):
        resolve_report_date(sot, "June")
    with pytest.raises(ValueError, match="empty"):
        resolve_report_date(sot_of(spark))
    with pytest.raises(ValueError, match="no source of truth"):
        resolve_report_date(None)


def history(daily_frame, days_ago):
    rows = []
    for n in days_ago:
        day = str(DAY - dt.timedelta(days=n))
        rows.append((day, "overall", "overall", 100 + n, 90, 80, 70, 1000.0 + n))
        rows.append((day, "channel", "SEM", 100 + n, 90, 80, 70, 1000.0 + n))
    return daily_frame(rows)


def engine_over(source, sot=None, config=REVENUE_FUNNEL):
    return MonitorEngine(MonitorRegistry(config), {config.key: Binding(source, sot)})


def test_run(spark, daily_frame, frame_source):
    source = frame_source(history(daily_frame, [0, 7, 364]))
    result = engine_over(source, sot_of(spark, DAY)).run("revenue_funnel")
    assert (result.report_date, result.anchor, result.domain) == (DAY, DAY, "revenue_funnel")
    assert result.detail.count() == 2
    assert [r.dimension for r in result.summary.collect()] == ["overall"]
    assert [r.dimension for r in result.breakdown.collect()] == ["SEM"]
    assert result.pull_sizes() == {"overall": 3, "channel": 3}
    result.unpersist()


def test_fallback_to_the_latest_day(daily_frame, frame_source):
    source = frame_source(history(daily_frame, [0, 7, 364]))
    # 16 days on, the year-ago day is the first of the pull; one day later it is out of it.
    for later, has_prior in ((16, True), (17, False)):
        asked = DAY + dt.timedelta(days=later)
        result = engine_over(source).run("revenue_funnel", asked)
        assert (result.report_date, result.anchor) == (asked, DAY)
        row = result.summary.first()
        assert row.metric_date == DAY and row.revenue_wow_prior == 1007.0
        assert (row.revenue_yoy_prior is not None) == has_prior


def test_fallback_of_a_weekly_monitor(daily_frame, frame_source):
    source = frame_source(history(daily_frame, [0, 7]))
    weekly = dataclasses.replace(REVENUE_FUNNEL, comparisons=("wow",))
    for later, has_prior in ((14, True), (15, False)):
        result = engine_over(source, config=weekly).run("revenue_funnel", DAY + dt.timedelta(days=later))
        assert (result.summary.first().revenue_wow_prior is not None) == has_prior


def test_sot_is_read_at_the_requested_date(spark, daily_frame, frame_source):
    source = frame_source(history(daily_frame, [5, 12]))
    asked_only = engine_over(source, sot_of(spark, DAY)).run("revenue_funnel", DAY)
    assert asked_only.anchor == DAY - dt.timedelta(days=5)
    assert asked_only.validations.count() == 4
    fallback_only = engine_over(source, sot_of(spark, asked_only.anchor)).run("revenue_funnel", DAY)
    assert fallback_only.validations.isEmpty()


def test_no_rows_at_all(daily_frame, frame_source):
    result = engine_over(frame_source(history(daily_frame, []))).run("revenue_funnel", DAY)
    assert result.anchor == DAY
    assert result.detail.isEmpty() and result.anomalies.isEmpty()
    assert result.validations is None


def test_several_monitors(daily_frame, frame_source, caplog):
    source = frame_source(history(daily_frame, [0, 7, 364]))
    weekly = dataclasses.replace(REVENUE_FUNNEL, key="weekly", comparisons=("wow",))
    engine = MonitorEngine(
        MonitorRegistry(REVENUE_FUNNEL, weekly),
        {"revenue_funnel": Binding(source), "weekly": Binding(source)},
    )
    results = engine.run_all(" revenue_funnel, nowhere ,weekly", DAY)
    assert [r.domain for r in results] == ["revenue_funnel", "weekly"]
    assert "nowhere" in caplog.text
    stacked = stack_details(results)
    assert {(r.domain, r["count"]) for r in stacked.groupBy("domain").count().collect()} == {
        ("revenue_funnel", 20),
        ("weekly", 20),
    }
    assert stacked.filter("domain = 'weekly' AND yoy IS NOT NULL").isEmpty()
    assert {r.domain for r in stack_anomalies(results).collect()} <= {"revenue_funnel"}


def test_registry_and_config_checks():
    registry = default_registry()
    assert list(registry) == ["revenue_funnel"] and registry["revenue_funnel"].lookback_days == 380
    with pytest.raises(ConfigError, match="already"):
        registry.register(REVENUE_FUNNEL)
    with pytest.raises(KeyError):
        registry["other"]
    assert parse_keys(" a, b ,c") == ["a", "b", "c"]
    with pytest.raises(ConfigError, match="comparison"):
        dataclasses.replace(REVENUE_FUNNEL, comparisons=("mom",))
    with pytest.raises(ConfigError, match="no dimension"):
        dataclasses.replace(REVENUE_FUNNEL, dimensions=())
    with pytest.raises(ConfigError, match="repeated"):
        dataclasses.replace(REVENUE_FUNNEL, volume_metrics=("rpp",))


def test_monitor_from_plain_config():
    raw = json.loads(
        """{"name": "Errors", "dimensions": ["overall"],
        "metrics": {"rate": {"label": "Rate", "numerator": "errors", "denominator": "views",
                             "direction": "down"}},
        "volume_metrics": ["views"], "anomaly_rules": {"yoy_threshold": 0.2}}"""
    )
    monitor = MonitorConfig.from_dict("errors", raw)
    assert monitor.comparisons == ("wow",) and monitor.lookback_days == 21
    assert monitor.rules.min_denominator == 50 and monitor.metrics[0].direction == "down"
    with pytest.raises(ConfigError):
        MonitorConfig.from_dict("broken", {"dimensions": ["overall"]})


def test_sql_source(spark):
    events = spark.createDataFrame(
        [(DAY, "x", 1), (DAY, "y", 2), (DAY - dt.timedelta(days=1), "x", 5)],
        "day date, name string, amount int",
    ).withColumn("everything", F.lit("overall"))
    source = SqlSource(
        spark,
        "SELECT day AS metric_date, {dimension} AS dimension, sum(amount) AS total FROM {events}"
        " WHERE day BETWEEN :start_date AND :end_date GROUP BY ALL",
        {"overall": {"dimension": F.col("everything")}, "name": {"dimension": F.col("name")}},
        {"events": events},
    )
    window = DateWindow(DAY, DAY)
    rows = source.daily(["overall", "name"], window).collect()
    assert {(r.dim_type, r.dimension, r.total) for r in rows} == {
        ("overall", "overall", 3),
        ("name", "x", 1),
        ("name", "y", 2),
    }
    wide = DateWindow(DAY - dt.timedelta(days=9), DAY + dt.timedelta(days=9))
    assert source.daily(["overall"], wide.only(DAY)).count() == 1
    assert source.latest_day(wide) == DAY
    assert source.has_rows_on(DAY) and not source.has_rows_on(dt.date(2020, 1, 1))
    with pytest.raises(ValueError, match="unknown dimension level"):
        source.daily(["region"], window)
    assert run_sql(spark, "SELECT :a + 1 AS b", {"a": 1}).first().b == 2
