"""Comparison with earlier days."""

import dataclasses
import datetime as dt

import pytest

from tidewatch.config import REVENUE_FUNNEL
from tidewatch.operators.deltas import FORMS, add_deltas
from tidewatch.operators.metrics import add_ratio_metrics

DAY = dt.date(2024, 6, 15)


def ago(days):
    return str(DAY - dt.timedelta(days=days))


def rows_for(**dimensions):
    """Per dimension: days ago to (iv, req, prj, con, rev)."""
    rows = []
    for name, days in dimensions.items():
        level = "overall" if name == "overall" else "channel"
        rows += [(ago(n), level, name, *values) for n, values in days.items()]
    return rows


@pytest.fixture
def sample(daily_frame):
    return daily_frame(
        rows_for(
            overall={0: (10, 5, 4, 8, 200.0), 7: (8, 0, 4, 8, -100.0), 364: (20, 5, 0, 8, 0.0)},
            gap={0: (1, 1, 1, 1, 1.0), 6: (9, 9, 9, 9, 9.0), 8: (9, 9, 9, 9, 9.0)},
            gone={7: (5, 5, 5, 5, 5.0), 364: (5, 5, 5, 5, 5.0)},
        )
    )


def detail_of(daily, form="pivot", config=REVENUE_FUNNEL):
    return add_deltas(add_ratio_metrics(daily, config), config, DAY, form)


def by_dimension(df):
    return {r.dimension: r for r in df.collect()}


def test_values_priors_and_changes(sample):
    detail = detail_of(sample)
    assert len(detail.columns) == 53
    assert detail.columns[:3] == ["dimension", "metric_date", "iv_to_request"]
    assert detail.columns[-1] == "dim_type"
    rows = by_dimension(detail)
    assert set(rows) == {"overall", "gap"}
    row = rows["overall"]
    assert row.metric_date == DAY
    assert (row.rpp, row.iv_to_request) == (50.0, 0.5)
    # Requests were 0 a week ago: the ratio is missing, the change of the count as well.
    assert (row.ppr_wow_prior, row.ppr_wow) == (None, None)
    assert (row.requests_wow_prior, row.requests_wow) == (0, None)
    # From a negative base growth looks negative.
    assert row.revenue_wow == -3.0
    assert (row.revenue_yoy_prior, row.revenue_yoy) == (0.0, None)
    assert row.intentful_visitors_yoy == -0.5
    assert row.rpp_yoy_prior is None


def test_neighbouring_days_are_not_priors(sample):
    row = by_dimension(detail_of(sample))["gap"]
    assert row.revenue_wow_prior is None and row.revenue_wow is None


@pytest.mark.parametrize("form", FORMS)
def test_forms_agree(sample, form):
    expected, got = detail_of(sample), detail_of(sample, form)
    assert got.columns == expected.columns
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_window_follows_the_date_gap(daily_frame):
    """Days 1, 7, 8, 14: the prior of 8 is day 1, that of 14 is day 7, the others have none."""
    days = [1, 7, 8, 14]
    daily = daily_frame([(f"2024-01-{d:02}", "overall", "overall", d, 1, 1, 1, 1.0) for d in days])
    config = dataclasses.replace(REVENUE_FUNNEL, comparisons=("wow",))
    for form in FORMS:
        priors = {}
        for d in days:
            detail = add_deltas(daily, config, dt.date(2024, 1, d), form)
            priors[d] = detail.first().intentful_visitors_wow_prior
        assert priors == {1: None, 7: None, 8: 1, 14: 7}


def test_missing_columns_are_skipped(sample):
    detail = detail_of(sample.drop("contacts"))
    assert "cpp" not in detail.columns and "contacts_yoy" not in detail.columns
    assert "rpp" in detail.columns


def test_only_the_configured_comparisons(sample):
    config = dataclasses.replace(REVENUE_FUNNEL, comparisons=("wow",))
    columns = detail_of(sample, config=config).columns
    assert len(columns) == 33 and not any("yoy" in c for c in columns)


def test_ratio_needs_a_positive_denominator(daily_frame):
    daily = daily_frame(
        [
            (ago(0), "channel", "zero", 0, 1, 0, 0, 5.0),
            (ago(0), "channel", "null", None, 1, None, None, 5.0),
            (ago(0), "channel", "negative", -1, 1, -2, -3, 5.0),
        ]
    )
    for row in add_ratio_metrics(daily, REVENUE_FUNNEL).collect():
        assert row.iv_to_request is None and row.rpp is None and row.rpc is None
