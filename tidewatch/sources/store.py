"""Daily frames kept by day, so that a day is computed once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import DateWindow

DAY = "metric_date"


class DailyStore:
    """A daily source in front of another one, which it asks only for days it has not kept yet.

    Below ``location`` are two Parquet tables partitioned by day: ``daily``, the daily frame at all
    ``levels``, and ``days``, one row per computed day with the number of source rows it was computed
    from; a day without rows is in ``days`` only. Days are replaced one by one by dynamic partition
    overwrite. ``days`` is written last, so a run that breaks off leaves days that are computed anew.

    Rows that come late to a day already kept are found by :meth:`late_days`, which counts source rows
    by the time columns alone. Changes that leave these counts as they are, and changes of the lookup,
    are not seen; name such days to :meth:`compute`.
    """

    def __init__(self, source, location: str, levels: Sequence[str]) -> None:
        self.source = source
        self.location = location.rstrip("/")
        self.levels = tuple(levels)

    @cached_property
    def _daily_schema(self) -> T.StructType:
        return self.source.daily(self.levels, DateWindow.always().only(dt.date(2000, 1, 1))).schema

    @cached_property
    def _spark(self):
        return self.source.daily(self.levels, DateWindow.always().only(dt.date(2000, 1, 1))).sparkSession

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self._spark.read.schema(schema).parquet(f"{self.location}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self._spark.createDataFrame([], schema)

    def _write(self, df: DataFrame, name: str) -> None:
        # Rebalancing gives a day few files, and splits a day of very many dimension values.
        (
            df.hint("rebalance", DAY)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAY)
            .parquet(f"{self.location}/{name}")
        )

    @property
    def days(self) -> DataFrame:
        """``source_rows, metric_date`` of every day kept."""
        schema = T.StructType().add("source_rows", T.LongType()).add(DAY, T.DateType())
        return self._read("days", schema)

    def kept(self, days: Iterable[dt.date]) -> dict[dt.date, int]:
        """Source rows of those of ``days`` that are kept."""
        wanted = self.days.filter(F.col(DAY).isin([F.lit(day) for day in days]))
        return {row[DAY]: row["source_rows"] for row in wanted.collect()}  # one row per day

    def compute(self, days: Iterable[dt.date]) -> list[dt.date]:
        """Compute days and keep them in place of what was kept of them; nothing else is touched."""
        days = sorted(set(days))
        if not days:
            return days
        window = DateWindow.always().only(*days)
        counted = {day: 0 for day in days}
        rows = self.source.rows_by_day(window).collect()  # one row per day
        counted.update({row[DAY]: row["source_rows"] for row in rows})
        self._write(self.source.daily(self.levels, window), "daily")
        entries = self._spark.createDataFrame(
            [(day, n) for day, n in counted.items()], f"{DAY} date, source_rows bigint"
        )
        self._write(entries.coalesce(1), "days")
        return days

    def missing_days(self, days: Iterable[dt.date]) -> list[dt.date]:
        days = sorted(set(days))
        return sorted(set(days) - set(self.kept(days)))

    def late_days(self, days: Iterable[dt.date]) -> list[dt.date]:
        """Kept days whose number of source rows is another one now."""
        kept = self.kept(days)
        if not kept:
            return []
        now = self.source.rows_by_day(DateWindow.always().only(*kept)).collect()
        found = {row[DAY]: row["source_rows"] for row in now}
        return sorted(day for day, n in kept.items() if found.get(day, 0) != n)

    def refresh(self, days: Iterable[dt.date], late: bool = True) -> list[dt.date]:
        """Compute the missing days among ``days``, and with ``late`` those with late rows."""
        days = sorted(set(days))
        return self.compute([*self.missing_days(days), *(self.late_days(days) if late else [])])

    # --- as a daily source ----------------------------------------------------------------

    def daily(self, levels: Sequence[str], window: DateWindow) -> DataFrame:
        """Kept days of a window; those missing are computed first. An open window is not kept."""
        if unknown := [level for level in levels if level not in self.levels]:
            raise ValueError(f"unknown dimension level {unknown}; the store has {list(self.levels)}")
        days = window.all_days()
        if days is None:
            return self.source.daily(levels, window)
        self.refresh(days, late=False)
        # Days that lost all their rows still have an old partition; they are left out by their count.
        with_rows = [F.lit(day) for day, n in self.kept(days).items() if n]
        daily = self._read("daily", self._daily_schema)
        return daily.filter(F.col(DAY).isin(with_rows) & F.col("dim_type").isin(list(levels)))

    def days_with_rows(self, window: DateWindow) -> set[dt.date]:
        days = window.all_days()
        if days is None:
            return self.source.days_with_rows(window)
        self.refresh(days, late=False)
        return {day for day, n in self.kept(days).items() if n}

    def has_rows_on(self, day: dt.date) -> bool:
        return bool(self.days_with_rows(DateWindow(day, day)))

    def latest_day(self, window: DateWindow) -> dt.date | None:
        """Asks the source: a scan of time columns, where the store would compute every day."""
        return self.source.latest_day(window)
