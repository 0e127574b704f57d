"""One monitor on many report dates from one plan (M8, M9)."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import MonitorConfig
from tidewatch.functions import DateWindow, as_date
from tidewatch.operators.anomalies import anomaly_counts, detect_anomalies
from tidewatch.operators.combine import OVERALL
from tidewatch.operators.deltas import CURRENT, add_deltas_by_date
from tidewatch.operators.metrics import add_ratio_metrics
from tidewatch.operators.validation import validate_by_date, validation_verdict
from tidewatch.plans.engine import DailySource, MonitorEngine

log = logging.getLogger(__name__)

BY_DATE = ("report_date",)


@dataclass(frozen=True)
class NeededDay:
    """A day that a report date is compared on: as ``current``, or as the prior of a comparison."""

    report_date: dt.date
    part: str
    day: dt.date


def needed_days(config: MonitorConfig, anchors: Mapping[dt.date, dt.date]) -> list[NeededDay]:
    """Days of every report date; a prior day before the lookback of the report date is left out."""
    found = []
    for report_date, anchor in anchors.items():
        first = report_date - dt.timedelta(days=config.lookback_days)
        for part, days in {CURRENT: 0, **config.offsets}.items():
            day = anchor - dt.timedelta(days=days)
            if day >= first:
                found.append(NeededDay(report_date, part, day))
    return found


def anchors_of(
    source: DailySource, report_dates: Sequence[dt.date], lookback_days: int
) -> dict[dt.date, dt.date]:
    """For each report date the day to report: itself, or the latest day before that has rows.

    One small action looks for all dates at once, and one more for each that has no rows.
    """
    present = source.days_with_rows(DateWindow.always().only(*report_dates))
    anchors = {}
    for day in report_dates:
        latest = day
        if day not in present:
            latest = source.latest_day(DateWindow.lookback(day, lookback_days)) or day
            log.warning("no data for %s, using the latest day %s", day, latest)
        anchors[day] = latest
    return anchors


@dataclass(frozen=True)
class Backfill:
    """A monitor's frames for all report dates, each with a ``report_date`` column; all lazy."""

    config: MonitorConfig
    anchors: Mapping[dt.date, dt.date]
    sot: DataFrame | None
    comparison: DataFrame

    @property
    def report_dates(self) -> list[dt.date]:
        return list(self.anchors)

    @cached_property
    def days(self) -> DataFrame:
        """``report_date, part, day``: literals of the program, at most three per report date."""
        rows = ", ".join(
            f"(DATE '{d.report_date}', '{d.part}', DATE '{d.day}')"
            for d in needed_days(self.config, self.anchors)
        )
        spark = self.comparison.sparkSession
        return spark.sql(f"SELECT * FROM VALUES {rows} AS days(report_date, part, day)")

    @cached_property
    def dates(self) -> DataFrame:
        """``report_date``, one row per date asked for."""
        return self.days.select("report_date").distinct()

    @cached_property
    def detail(self) -> DataFrame:
        daily = add_ratio_metrics(self.comparison, self.config)
        return add_deltas_by_date(daily, self.config, self.days)

    @cached_property
    def summary(self) -> DataFrame:
        return self.detail.filter((F.col("dim_type") == OVERALL) & (F.col("dimension") == OVERALL))

    @cached_property
    def breakdown(self) -> DataFrame:
        return self.detail.filter(F.col("dim_type") != OVERALL)

    @cached_property
    def anomalies(self) -> DataFrame:
        return detect_anomalies(self.detail, self.config, BY_DATE)

    @cached_property
    def validations(self) -> DataFrame | None:
        if self.sot is None:
            return None
        return validate_by_date(self.summary, self.sot, self.report_dates, self.config.sot_columns)

    def _for_every_date(self, counted: DataFrame, counts: Sequence[str]) -> DataFrame:
        """Dates without a row count 0."""
        filled = self.dates.join(counted, "report_date", "left")
        return filled.fillna(0, list(counts)).select(*counted.columns)

    @cached_property
    def anomaly_counts(self) -> DataFrame:
        counted = anomaly_counts(self.anomalies, BY_DATE)
        return self._for_every_date(counted, counted.columns[1:])

    @cached_property
    def verdicts(self) -> DataFrame | None:
        if self.validations is None:
            return None
        return self._for_every_date(
            validation_verdict(self.validations, BY_DATE), ["validated", "failed"]
        )


def backfill(
    engine: MonitorEngine, key: str, dates: Sequence[str | dt.date]
) -> Backfill:
    """Plan one monitor on many report dates.

    Every role is scanned once, for the union of all compared days. Two small actions settle which
    dates the source of truth and the events have.
    """
    config, binding = engine.registry[key], engine.bindings[key]
    report_dates = list(dict.fromkeys(as_date(date) for date in dates))
    if not report_dates:
        raise ValueError("give at least one report date")
    if binding.sot is not None:
        wanted = binding.sot.filter(F.col("metric_date").isin([F.lit(d) for d in report_dates]))
        known = {row[0] for row in wanted.select("metric_date").distinct().collect()}
        for day in report_dates:
            if day not in known:
                log.warning("date %s is not in the source of truth", day)
    anchors = anchors_of(binding.source, report_dates, config.lookback_days)
    days = {needed.day for needed in needed_days(config, anchors)}
    comparison = binding.source.daily(config.dimensions, DateWindow.always().only(*days))
    return Backfill(config, anchors, binding.sot, comparison)
