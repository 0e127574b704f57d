"""Anomaly rules and their order."""

import dataclasses
import datetime as dt
import random

import pytest

from tidewatch.config import AnomalyRules, MonitorConfig, RatioMetric
from tidewatch.operators.anomalies import anomaly_counts, detect_anomalies, small_denominators
from tidewatch.operators.ranking import add_global_rank
from tidewatch.plans.report import anomaly_section
from pyspark.sql import functions as F

CONFIG = MonitorConfig(
    key="m",
    name="M",
    dimensions=("overall", "channel"),
    metrics=(
        RatioMetric("good", "Good", "n", "d", "up"),
        RatioMetric("bad", "Bad", "n", "d", "down"),
    ),
    rules=AnomalyRules(yoy_threshold=0.25, min_denominator=50),
    comparisons=("wow", "yoy"),
)
SCHEMA = (
    "metric_date date, dim_type string, dimension string, d double, good double,"
    " good_yoy_prior double, good_yoy double, good_wow double, bad double, bad_yoy_prior double,"
    " bad_yoy double"
)


def detail(spark, rows):
    """Rows of (level, dimension, denominator, good yoy, bad yoy)."""
    full = [
        (dt.date(2024, 1, 1), level, name, den, 1.0, 2.0, good, -0.9, 3.0, 4.0, bad)
        for level, name, den, good, bad in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def flagged(spark, rows, config=CONFIG):
    found = detect_anomalies(detail(spark, rows), config).orderBy("rank").collect()
    return [(r.metric, r.dimension, r.severity) for r in found]


def test_thresholds_are_strict(spark):
    rows = [
        ("channel", "at", 100.0, -0.25, 0.25),
        ("channel", "over", 100.0, -0.2500001, None),
        ("channel", "twice", 100.0, -0.5, None),
        ("channel", "above_twice", 100.0, -0.5000001, None),
    ]
    assert flagged(spark, rows) == [
        ("good", "above_twice", "high"),
        ("good", "twice", "medium"),
        ("good", "over", "medium"),
    ]


def test_only_harmful_moves(spark):
    rows = [
        ("channel", "up", 100.0, 0.9, 0.9),
        ("channel", "down", 100.0, -0.9, -0.9),
    ]
    assert flagged(spark, rows) == [("good", "down", "high"), ("bad", "up", "high")]


def test_denominator_floor(spark):
    rows = [
        ("channel", "below", 49.0, -0.9, None),
        ("channel", "floor", 50.0, -0.8, None),
        ("channel", "null", None, -0.7, None),
    ]
    assert flagged(spark, rows) == [("good", "floor", "high"), ("good", "null", "high")]
    flags = {
        r.dimension: r.small_denominator
        for r in small_denominators(detail(spark, rows), CONFIG).filter("metric = 'good'").collect()
    }
    assert flags == {"below": True, "floor": False, "null": None}


def test_missing_change_is_no_anomaly(spark):
    rows = [("channel", "a", 100.0, None, None)]
    assert flagged(spark, rows) == []
    counts = anomaly_counts(detect_anomalies(detail(spark, rows), CONFIG)).first()
    assert tuple(counts) == (0, 0, 0)


def test_without_yoy_nothing_is_flagged(spark):
    frame = detail(spark, [("channel", "a", 100.0, -0.9, 0.9)]).drop("good_yoy", "bad_yoy")
    assert detect_anomalies(frame, CONFIG).isEmpty()


def test_ties_keep_metric_level_and_row_order(spark):
    rows = [
        ("channel", "b", 100.0, -0.9, 0.9),
        ("channel", "a", 100.0, -0.9, 0.9),
        ("overall", "overall", 100.0, -0.9, 0.9),
    ]
    assert flagged(spark, rows) == [
        (metric, name, "high") for metric in ("good", "bad") for name in ("overall", "a", "b")
    ]


def test_fields(spark):
    row = detect_anomalies(detail(spark, [("channel", "a", 100.0, -0.5, None)]), CONFIG).first()
    assert row.asDict() == {
        "rank": 1,
        "metric": "good",
        "metric_label": "Good",
        "dimension": "a",
        "comparison": "yoy",
        "current_value": 1.0,
        "prior_value": 2.0,
        "pct_change": -0.5,
        "threshold": 0.25,
        "severity": "medium",
        "direction": "up",
        "dim_type": "channel",
    }


def test_rank_of_many_with_a_large_group_of_ties(spark):
    rng = random.Random(0)
    rows = [
        (
            "channel",
            f"d{i:04}",
            100.0,
            -1.0 if rng.random() < 0.4 else -rng.uniform(0, 3),
            10 ** rng.uniform(-2, 6),
        )
        for i in range(700)
    ]
    expected = []
    for order, (metric, column) in enumerate((("good", 3), ("bad", 4))):
        for row in rows:
            pct = row[column]
            if abs(pct) > 0.25:
                expected.append((0 if abs(pct) > 0.5 else 1, -abs(pct), order, row[1], metric))
    expected.sort()
    found = detect_anomalies(detail(spark, rows), CONFIG).orderBy("rank").collect()
    assert [r["rank"] for r in found] == list(range(1, len(expected) + 1))
    assert [(r.dimension, r.metric) for r in found] == [(e[3], e[4]) for e in expected]


def test_global_rank_over_buckets(spark):
    df = spark.range(100).withColumn("b", (F.col("id") / 10).cast("int"))
    ranked = add_global_rank(df, [F.col("b"), -F.col("id")])
    assert {r.id: r["rank"] for r in ranked.collect()}[0] == 10
    assert {r.id: r["rank"] for r in ranked.collect()}[99] == 91
    anew = add_global_rank(df, [-F.col("id")], by=["b"], ranges=7)
    assert all(r["rank"] == 10 - r.id % 10 for r in anew.collect())
    assert add_global_rank(df.limit(0), [F.col("id")]).isEmpty()


def test_section_lists_in_rank_order(spark):
    frame = detail(spark, [("channel", "a", 100.0, -0.3, 0.9)])
    row = anomaly_section(detect_anomalies(frame, CONFIG)).first()
    assert row.anomaly_count == 2
    assert list(row["items"]) == [
        "[HIGH] Bad in a: +90.0% yoy",
        "[MEDIUM] Good in a: -30.0% yoy",
    ]
    empty = anomaly_section(detect_anomalies(frame.limit(0), CONFIG)).first()
    assert (empty.anomaly_count, list(empty["items"])) == (0, [])


def test_default_rules_apply():
    plain = dataclasses.replace(CONFIG, rules=AnomalyRules())
    assert (plain.rules.yoy_threshold, plain.rules.min_denominator) == (0.10, 50)
    with pytest.raises(ValueError):
        RatioMetric("x", "X", "n", "d", "sideways")
