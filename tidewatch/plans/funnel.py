"""The daily frame of a funnel monitor (M3)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import DateWindow, business_date
from tidewatch.operators.combine import combine_by_outer_join, combine_counts
from tidewatch.operators.stages import COUNT, DISTINCT, SUM, Lookup, Stage, StageReader, stage_rows
from tidewatch.sources.channels import MARKETING_CHANNELS, ChannelMap

REVENUE_FUNNEL_STAGES = (
    Stage("intentful_visitors", COUNT, "visits", "visit_date", segment="segment"),
    Stage(
        "requests", DISTINCT, "requests", "request_created_time", "request_pk", segment="segment"
    ),
    Stage(
        "projects",
        DISTINCT,
        "projects",
        "project_created_time",
        "request_pk",
        lookup_key="request_pk",
    ),
    Stage(
        "contacts",
        DISTINCT,
        "contacts",
        "contact_created_time",
        "contact_pk",
        lookup_key="request_pk",
    ),
    Stage(
        "revenue", SUM, "rev_a", "transaction_timestamp", "gross_revenue", lookup_key="request_pk"
    ),
    # A missing adjustment is 0, but a missing net amount leaves the row without revenue.
    Stage(
        "revenue",
        SUM,
        "rev_b",
        "ts",
        "net_revenue + coalesce(refund, 0) + coalesce(payout, 0)"
        " + coalesce(transfer_reversal, 0) + coalesce(cancellation_revenue, 0)",
        lookup_key="request_pk",
    ),
)
REVENUE_FUNNEL_LOOKUP = Lookup("requests", "request_pk", "segment")


class FunnelSource:
    """Daily frames over event roles: ``metric_date, dim_type, dimension`` and the measures."""

    def __init__(
        self,
        roles: Mapping[str, DataFrame],
        stages: Sequence[Stage] = REVENUE_FUNNEL_STAGES,
        lookup: Lookup | None = REVENUE_FUNNEL_LOOKUP,
        channels: ChannelMap = MARKETING_CHANNELS,
        sum_type: str | None = None,
    ) -> None:
        """Sums have the scale of what they sum, or are ``sum_type``, if given."""
        missing = {s.role for s in stages} - set(roles)
        if missing:
            raise ValueError(f"no data given for roles {sorted(missing)}")
        if lookup is None and any(s.lookup_key for s in stages):
            raise ValueError("stages use a lookup key but no lookup is given")
        self.roles = dict(roles)
        self.stages = tuple(stages)
        self.channels = channels
        self._reader = StageReader(self.roles, channels, lookup, self.stages)
        self.result_types = {
            s.measure: sum_type if s.kind == SUM else "bigint" for s in self.stages
        }

    @cached_property
    def _stages_by_measure(self) -> dict[str, list[Stage]]:
        grouped: dict[str, list[Stage]] = {}
        for stage in self.stages:
            grouped.setdefault(stage.measure, []).append(stage)
        return grouped

    def daily(self, levels: Sequence[str], window: DateWindow) -> DataFrame:
        """All measures at all ``levels`` from one pass over the roles (A5)."""
        levels = self._reader.check_levels(levels)
        counts = [
            self._reader.counts(stages, window, levels)
            for stages in self._stages_by_measure.values()
        ]
        return combine_counts(counts, self.result_types)

    def measure(self, measure: str, level: str, window: DateWindow) -> DataFrame:
        """One stage at one level: ``metric_date, dimension`` and the measure."""
        levels = self._reader.check_levels([level])
        counts = self._reader.counts(self._stages_by_measure[measure], window, levels)
        daily = combine_counts([counts], self.result_types)
        return daily.select("metric_date", "dimension", f"`{measure}`")

    def daily_by_outer_join(self, level: str, window: DateWindow) -> DataFrame:
        """One level through chained full outer joins, the reference form of the combination."""
        stages = [self.measure(m, level, window) for m in self._stages_by_measure]
        return combine_by_outer_join(stages, self.result_types)

    def has_rows_on(self, day: dt.date) -> bool:
        """Whether any stage has a row on ``day``; stops at the first row it finds."""
        window = DateWindow(day, day)
        return any(not stage_rows(self.roles, s, window).isEmpty() for s in self.stages)

    def days_with_rows(self, window: DateWindow) -> set[dt.date]:
        """Days in the window on which any stage has a row: a scan of the time columns alone."""
        days = [
            stage_rows(self.roles, s, window).select("metric_date").distinct() for s in self.stages
        ]
        found = reduce(DataFrame.unionByName, days).distinct()
        return {row[0] for row in found.collect()}  # one row per day asked for

    def rows_by_day(self, window: DateWindow) -> DataFrame:
        """``metric_date, source_rows``: rows of all stages per day, from the time columns alone."""
        days = [stage_rows(self.roles, s, window).select("metric_date") for s in self.stages]
        stacked = reduce(DataFrame.unionByName, days)
        return stacked.groupBy("metric_date").agg(F.count("*").alias("source_rows"))

    def latest_day(self, window: DateWindow) -> dt.date | None:
        """The last day with a row in the window: a scan of the time columns alone (A4).

        The latest raw time is found first, and only that is turned into a date.
        """
        latest = []
        for stage in self.stages:
            df = self.roles[stage.role]
            if stage.where is not None:
                df = df.filter(stage.where)
            dtype = df.schema[stage.time].dataType
            inside = df.filter(window.covers(stage.time, dtype))
            last = inside.agg(F.max(stage.time).alias("last"))
            latest.append(last.selectExpr(f"{business_date('last', dtype)} AS metric_date"))
        days = reduce(DataFrame.unionByName, latest)
        return days.agg(F.max("metric_date")).first()[0]
