"""Running monitors (M2, M8, M9)."""

from __future__ import annotations

import dataclasses
import datetime as dt
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from typing import Protocol

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidewatch.config import MonitorConfig, MonitorRegistry, parse_keys
from tidewatch.functions import DateWindow, as_date
from tidewatch.operators.anomalies import detect_anomalies
from tidewatch.operators.combine import OVERALL
from tidewatch.operators.deltas import add_deltas, comparison_days
from tidewatch.operators.growth import channel_contribution, growth_decomposition
from tidewatch.operators.metrics import add_ratio_metrics
from tidewatch.operators.validation import validate_against_sot
from tidewatch.sources.shared import shared

log = logging.getLogger(__name__)


class DailySource(Protocol):
    """Where a monitor's daily frame comes from."""

    def daily(self, levels: Sequence[str], window: DateWindow) -> DataFrame: ...

    def has_rows_on(self, day: dt.date) -> bool: ...

    def latest_day(self, window: DateWindow) -> dt.date | None: ...

    def days_with_rows(self, window: DateWindow) -> set[dt.date]: ...


@dataclass(frozen=True)
class Binding:
    """The data behind one monitor; without ``sot`` it is not validated."""

    source: DailySource
    sot: DataFrame | None = None


def latest_sot_date(sot: DataFrame) -> DataFrame:
    """``latest_date`` in one row (A4)."""
    return sot.agg(F.max("metric_date").alias("latest_date"))


def sot_has_date(sot: DataFrame, day: dt.date) -> bool:
    """Whether the table has a row for ``day`` (P10)."""
    return not sot.filter(F.col("metric_date") == F.lit(day)).isEmpty()


def resolve_report_date(sot: DataFrame | None, date: str | dt.date | None = None) -> dt.date:
    """The report date: as given, or the latest complete day in the source of truth (M2)."""
    if date:
        day = as_date(date)
        if sot is not None and not sot_has_date(sot, day):
            log.warning("date %s is not in the source of truth; numbers of that day can be incomplete", day)
        return day
    if sot is None:
        raise ValueError("give a report date, there is no source of truth to take it from")
    latest = latest_sot_date(sot).first()[0]
    if latest is None:
        raise ValueError("the source of truth is empty, so there is no latest date (T23)")
    return latest


def _is_done(seen: Observation) -> bool:
    """Whether a frame with this observation has been run; asking for its values would wait for that."""
    return seen._jo is not None and seen._jo.future().isCompleted()


@dataclass(frozen=True)
class MonitorResult:
    """One monitor's frames. All are lazy; nothing is computed until one of them is used."""

    config: MonitorConfig
    report_date: dt.date
    anchor: dt.date
    source: DailySource
    sot: DataFrame | None
    comparison: DataFrame
    form: str = "pivot"
    persist: bool = False

    def _kept(self, df: DataFrame) -> DataFrame:
        return df.persist(StorageLevel.MEMORY_AND_DISK) if self.persist else df

    @property
    def domain(self) -> str:
        return self.config.key

    @property
    def name(self) -> str:
        return self.config.name

    @property
    def context(self) -> str:
        return self.config.context

    @property
    def window(self) -> DateWindow:
        return DateWindow.lookback(self.report_date, self.config.lookback_days)

    @cached_property
    def _pulls(self) -> dict[str, tuple[DataFrame, Observation]]:
        pulls = {}
        for level in self.config.dimensions:
            daily, seen = self.source.daily([level], self.window), Observation(f"pull of {level}")
            counted = daily.observe(seen, F.count(F.lit(1)).alias("n_rows"))
            pulls[level] = (counted.drop("dim_type"), seen)
        return pulls

    @property
    def raw(self) -> dict[str, DataFrame]:
        """The whole pull of every level, as daily frames."""
        return {level: df for level, (df, _) in self._pulls.items()}

    def pull_sizes(self) -> dict[str, int]:
        """Rows of every pull (A8): as observed where it has been run, otherwise counted now."""
        return {
            level: seen.get["n_rows"] if _is_done(seen) else df.count()
            for level, (df, seen) in self._pulls.items()
        }

    @cached_property
    def detail(self) -> DataFrame:
        """Current, prior and change of every column, one row per dimension value (M5)."""
        daily = add_ratio_metrics(self.comparison, self.config)
        return self._kept(add_deltas(daily, self.config, self.anchor, self.form))

    @cached_property
    def summary(self) -> DataFrame:
        """The overall row."""
        return self.detail.filter(
            (F.col("dim_type") == OVERALL) & (F.col("dimension") == OVERALL)
        )

    @cached_property
    def breakdown(self) -> DataFrame:
        """Rows of all other levels."""
        return self.detail.filter(F.col("dim_type") != OVERALL)

    @cached_property
    def anomalies(self) -> DataFrame:
        return self._kept(detect_anomalies(self.detail, self.config))

    @cached_property
    def validations(self) -> DataFrame | None:
        if self.sot is None:
            return None
        return self._kept(
            validate_against_sot(
                self.summary, self.sot, self.report_date, self.config.sot_columns
            )
        )

    @cached_property
    def growth(self) -> DataFrame:
        return growth_decomposition(self.summary, self.config.growth)

    @cached_property
    def contributions(self) -> DataFrame:
        return channel_contribution(self.comparison, self.anchor, self.config.growth.revenue)

    @cached_property
    def settled(self) -> MonitorResult:
        """The same result over frames computed once, for those who read it many times.

        The compared days, detail, anomalies and validations, all small, are written to the shared
        folder; nothing above them goes back to the events.
        """
        kept = dataclasses.replace(self, comparison=shared(self.comparison), persist=False)
        kept.__dict__["settled"] = kept
        for name in ("detail", "anomalies", "validations"):
            frame = getattr(kept, name)
            kept.__dict__[name] = None if frame is None else shared(frame)
        return kept

    def unpersist(self) -> None:
        """Let go of the frames a persisted run keeps; those never used are not built for it."""
        built = (self.__dict__.get(name) for name in ("validations", "anomalies", "detail"))
        for df in (*built, self.comparison):
            if df is not None:
                df.unpersist()

    def __enter__(self) -> MonitorResult:
        return self

    def __exit__(self, *error: object) -> None:
        self.unpersist()


class MonitorEngine:
    """Runs registered monitors over the data bound to them."""

    def __init__(self, registry: MonitorRegistry, bindings: Mapping[str, Binding]) -> None:
        self.registry = registry
        self.bindings = dict(bindings)

    def _anchor(self, source: DailySource, report_date: dt.date, window: DateWindow) -> dt.date:
        """The report date, or the latest day of the pull when that day has no rows."""
        if source.has_rows_on(report_date):
            return report_date
        latest = source.latest_day(window)
        if latest is None:
            return report_date
        log.warning("no data for %s, using the latest day %s", report_date, latest)
        return latest

    def run(
        self,
        key: str,
        date: str | dt.date | None = None,
        persist: bool = False,
        form: str = "pivot",
    ) -> MonitorResult:
        """Plan one monitor (M8).

        Two small driver actions settle the dates; everything else stays lazy. With the dates
        known, only the compared days are read, not the whole lookback. ``persist`` keeps the
        small frames that summary, breakdown and report start from, once they are first used.
        """
        config = self.registry[key]
        binding = self.bindings[key]
        report_date = resolve_report_date(binding.sot, date)
        window = DateWindow.lookback(report_date, config.lookback_days)
        anchor = self._anchor(binding.source, report_date, window)
        days = window.only(*comparison_days(config, anchor))
        comparison = binding.source.daily(config.dimensions, days)
        if persist:
            comparison = comparison.persist(StorageLevel.MEMORY_AND_DISK)
        return MonitorResult(
            config, report_date, anchor, binding.source, binding.sot, comparison, form, persist
        )

    def run_all(
        self,
        keys: str | Sequence[str],
        date: str | dt.date | None = None,
        persist: bool = False,
    ) -> list[MonitorResult]:
        """Plan several monitors; unknown keys are skipped with a warning (M9)."""
        results = []
        for key in parse_keys(keys):
            if key not in self.registry:
                log.warning("monitor %r is not registered, skipping it", key)
                continue
            results.append(self.run(key, date, persist))
        return results


def long_detail(result: MonitorResult) -> DataFrame:
    """Detail with one row per dimension value and column, the shape all monitors share."""
    detail, config = result.detail, result.config
    columns = config.compared_columns(detail.columns)

    def change(column: str, name: str):
        full = f"{column}_{name}"
        return (F.col(full) if full in detail.columns else F.lit(None)).cast("double").alias(name)

    rows = [
        F.struct(
            F.lit(c).alias("metric"),
            F.col(c).cast("double").alias("value"),
            change(c, "wow"),
            change(c, "yoy"),
        )
        for c in columns
    ]
    return detail.select(
        F.lit(result.domain).alias("domain"),
        F.lit(result.report_date).alias("report_date"),
        "metric_date",
        "dim_type",
        "dimension",
        F.inline(F.array(*rows)),
    )


def stack_details(results: Sequence[MonitorResult]) -> DataFrame:
    """Long detail of several monitors, told apart by ``domain``."""
    return reduce(DataFrame.unionByName, [long_detail(r) for r in results])


def stack_anomalies(results: Sequence[MonitorResult]) -> DataFrame:
    """Anomalies of several monitors, told apart by ``domain``."""
    return reduce(
        DataFrame.unionByName,
        [r.anomalies.select(F.lit(r.domain).alias("domain"), "*") for r in results],
    )
