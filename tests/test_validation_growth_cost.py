"""Source-of-truth checks, growth drivers and token cost."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewatch.config import REVENUE_FUNNEL, GrowthModel
from tidewatch.operators.cost import cost_by_model, run_costs
from tidewatch.operators.deltas import add_deltas
from tidewatch.operators.growth import channel_contribution, growth_decomposition
from tidewatch.operators.validation import validate_against_sot, validation_verdict

DAY, YEAR_AGO = dt.date(2024, 6, 15), dt.date(2023, 6, 17)
COLUMNS = REVENUE_FUNNEL.sot_columns
SOT = "metric_date date, total_iv bigint, total_requests bigint, total_projects bigint, total_revenue double"
OURS = "intentful_visitors bigint, requests bigint, projects bigint, revenue double"


def validate(spark, ours, theirs):
    summary = spark.createDataFrame(ours, OURS)
    sot = spark.createDataFrame(theirs, SOT)
    return validate_against_sot(summary, sot, DAY, COLUMNS)


def test_tolerance_and_skips(spark):
    ours = [(1002, 10, 5, None)]
    checks = validate(spark, ours, [(DAY, 1000, 11, 0, 7.0), (YEAR_AGO, 1, 1, 1, 1.0)])
    rows = {r.metric: r for r in checks.collect()}
    # The difference of exactly 0.2% passes; a 0 there and a NULL here are left out.
    assert rows["intentful_visitors"].passed and rows["intentful_visitors"].pct_diff == 0.002
    assert not rows["requests"].passed
    assert set(rows) == {"intentful_visitors", "requests"}
    assert tuple(validation_verdict(checks).first()) == (2, 1, False)


def test_negative_totals_compare_by_size(spark):
    row = validate(spark, [(1, 1, 1, -100.1)], [(DAY, 1, 1, 1, -100.0)]).filter(
        "metric = 'revenue'"
    ).first()
    assert row.passed and abs(row.pct_diff - 0.001) < 1e-12


@pytest.mark.parametrize(
    "ours, theirs",
    [([(1, 1, 1, 1.0)], [(YEAR_AGO, 1, 1, 1, 1.0)]), ([], [(DAY, 1, 1, 1, 1.0)])],
    ids=["date not there", "no summary"],
)
def test_nothing_to_compare_has_no_verdict(spark, ours, theirs):
    assert tuple(validation_verdict(validate(spark, ours, theirs)).first()) == (0, 0, None)


def test_repeated_sot_date_takes_the_smallest(spark):
    checks = validate(spark, [(5, 1, 1, 1.0)], [(DAY, 9, 1, 1, 1.0), (DAY, 5, 2, 2, 2.0)])
    rows = {r.metric: r.sot_value for r in checks.collect()}
    assert rows == {"intentful_visitors": 5.0, "requests": 2.0, "projects": 2.0, "revenue": 2.0}


def test_unmapped_monitor_compares_nothing(spark):
    frame = spark.createDataFrame([(DAY, 1)], "metric_date date, x int")
    found = validate_against_sot(frame, frame, DAY, COLUMNS)
    assert found.columns == ["metric", "our_value", "sot_value", "pct_diff", "passed"]
    assert found.count() == 0


def summary_of(daily_frame, now, then):
    daily = daily_frame(
        [
            (str(DAY), "overall", "overall", now[0], 1, now[1], 1, now[2]),
            (str(YEAR_AGO), "overall", "overall", then[0], 1, then[1], 1, then[2]),
        ]
    )
    return add_deltas(daily, REVENUE_FUNNEL, DAY)


def test_contributions_add_up_to_growth(daily_frame):
    summary = summary_of(daily_frame, (120, 30, 900.0), (100, 20, 700.0))
    rows = growth_decomposition(summary, GrowthModel()).collect()
    assert [r.driver for r in sorted(rows, key=lambda r: r.position)] == [
        "top_of_funnel",
        "conversion",
        "monetization",
    ]
    assert abs(sum(r.contribution for r in rows) - rows[0].revenue_yoy) < 1e-12
    assert abs(sum(r.share for r in rows) - 1) < 1e-12
    assert abs(rows[0].revenue_yoy - 2 / 7) < 1e-12


@pytest.mark.parametrize(
    "now, then",
    [
        ((100, 20, 700.0), (50, 10, 700.0)),
        ((0, 20, 700.0), (50, 10, 600.0)),
        ((10, 20, -700.0), (50, 10, 600.0)),
        ((10, 20, 700.0), (50, 0, 600.0)),
    ],
    ids=["revenue unchanged", "no visitors", "negative revenue", "no orders then"],
)
def test_no_decomposition_without_positive_factors(daily_frame, now, then):
    rows = growth_decomposition(summary_of(daily_frame, now, then), GrowthModel()).collect()
    assert len(rows) == 3
    assert all(r.share is None and r.contribution is None for r in rows)


def test_channels_add_up_and_lost_channels_count(daily_frame):
    daily = daily_frame(
        [
            (str(DAY), "channel", "new", 1, 1, 1, 1, 30.0),
            (str(DAY), "channel", "kept", 1, 1, 1, 1, 70.0),
            (str(YEAR_AGO), "channel", "kept", 1, 1, 1, 1, 50.0),
            (str(YEAR_AGO), "channel", "lost", 1, 1, 1, 1, 30.0),
            (str(DAY), "overall", "overall", 1, 1, 1, 1, 100.0),
            (str(YEAR_AGO), "overall", "overall", 1, 1, 1, 1, 80.0),
            ("2024-06-08", "overall", "overall", 1, 1, 1, 1, 999.0),
        ]
    )
    got = {r.dimension: r.contribution for r in channel_contribution(daily, DAY).collect()}
    assert got == {"new": 0.375, "kept": 0.25, "lost": -0.375}
    assert sum(got.values()) == (100 - 80) / 80


def test_no_prior_year_gives_no_contribution(daily_frame):
    daily = daily_frame([(str(DAY), "channel", "new", 1, 1, 1, 1, 30.0)])
    assert channel_contribution(daily, DAY).first().contribution is None


def test_token_cost(spark):
    usage = spark.createDataFrame(
        [
            (1, "o3", 1000, 400, 10),
            (2, "o3", 1, None, 1),
            (3, "never heard of", 1_000_000, 0, 0),
            (4, None, 0, 0, 1_000_000),
        ],
        "run_id bigint, model string, input_tokens bigint, cached_tokens bigint, output_tokens bigint",
    )
    costs = run_costs(usage)
    rows = {r.run_id: r for r in costs.collect()}
    assert rows[1].cost_input == Decimal("0.006000")
    assert rows[1].cost_cached == Decimal("0.001000")
    assert rows[1].total_cost == Decimal("0.007400")
    assert (rows[2].cached_tokens, rows[2].total_cost) == (0, Decimal("0.000050"))
    assert rows[3].total_cost == Decimal("1.750000")
    assert rows[4].total_cost == Decimal("14.000000")
    total = cost_by_model(costs).filter(F.col("model") == "o3").first()
    assert (total.runs, total.total_cost) == (2, Decimal("0.007450"))
