"""SQL text as a source."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import DateWindow, missing_if_nan
from tidewatch.functions.dates import day_start_utc
from tidewatch.functions.text import literal, quoted


def run_sql(
    spark: SparkSession,
    text: str,
    args: Mapping[str, object] | None = None,
    **fields: Column | DataFrame | str,
) -> DataFrame:
    """Run SQL and get a lazy frame. ``:name`` markers take ``args``, ``{name}`` fields take
    DataFrames (as relations), plain columns or strings (as literals)."""
    return spark.sql(text, args=dict(args or {}), **fields)


def _instant(day: dt.date) -> Column:
    """The instant at which a business day starts, as a literal."""
    return F.expr(f"TIMESTAMP '{day_start_utc(day).isoformat(' ')}'")


def _utc(day: dt.date) -> Column:
    """The same as a time without zone that holds UTC."""
    return F.expr(f"TIMESTAMP_NTZ '{day_start_utc(day).replace(tzinfo=None).isoformat(' ')}'")


def _measures(pulled: DataFrame, *others: str) -> list[Column]:
    """All columns but ``others``, NaN as missing."""
    return [
        missing_if_nan(F.col(quoted(f.name)), f.dataType).alias(f.name)
        for f in pulled.schema
        if f.name not in others
    ]


class SqlSource:
    """A metric source given as a SQL query per dimension level.

    The query returns ``metric_date``, ``dimension`` and measures. It marks the pull with
    ``:start_date`` and ``:end_date``, or, for a raw time column, which Parquet can then skip by, with
    the instants ``:start_instant`` (inclusive) and ``:end_instant`` (exclusive), or ``:start_utc`` and
    ``:end_utc`` where the column has no zone and holds UTC. What differs between levels it marks with ``{name}``
    fields: ``level_columns`` gives their values per level, a plain column reference or a
    string, which becomes a literal. ``relations`` are DataFrames the query names as ``{name}``.
    """

    def __init__(
        self,
        spark: SparkSession,
        text: str,
        level_columns: Mapping[str, Mapping[str, Column | str]],
        relations: Mapping[str, DataFrame] | None = None,
    ) -> None:
        self.spark = spark
        self.text = text
        self.level_columns = {level: dict(c) for level, c in level_columns.items()}
        self.relations = dict(relations or {})

    def _level(self, level: str, window: DateWindow) -> DataFrame:
        if level not in self.level_columns:
            raise ValueError(
                f"unknown dimension level {level!r}; known levels are {list(self.level_columns)}"
            )
        pulled = self._pull(window, self.level_columns[level])
        measures = _measures(pulled, "metric_date", "dimension")
        return pulled.select(
            "metric_date", F.lit(level).alias("dim_type"), "dimension", *measures
        )

    def _pull(self, window: DateWindow, fields: Mapping[str, Column | str]) -> DataFrame:
        """One run of the query over a window."""
        first, last = window.start or dt.date(1, 1, 1), window.end or dt.date(9999, 12, 30)
        # As SQL literals: an open window reaches to years that plain dates cannot carry over.
        args = {"start_date": F.expr(f"DATE '{first}'"), "end_date": F.expr(f"DATE '{last}'")}
        if ":start_instant" in self.text:
            args["start_instant"] = _instant(first)
            args["end_instant"] = _instant(last + dt.timedelta(days=1))
        if ":start_utc" in self.text:
            args["start_utc"], args["end_utc"] = _utc(first), _utc(last + dt.timedelta(days=1))
        pulled = run_sql(self.spark, self.text, args, **self.relations, **fields)
        if window.days is not None:
            pulled = pulled.filter(F.col("metric_date").isin([F.lit(d) for d in window.days]))
        return pulled

    def daily(self, levels: Sequence[str], window: DateWindow) -> DataFrame:
        """All levels stacked; each is one run of the query."""
        return reduce(DataFrame.unionByName, [self._level(level, window) for level in levels])

    def _any_level(self) -> str:
        return next(iter(self.level_columns))

    def has_rows_on(self, day: dt.date) -> bool:
        return not self._level(self._any_level(), DateWindow(day, day)).isEmpty()

    def days_with_rows(self, window: DateWindow) -> set[dt.date]:
        days = self._level(self._any_level(), window).select("metric_date").distinct()
        return {row[0] for row in days.collect()}

    def latest_day(self, window: DateWindow) -> dt.date | None:
        return self._level(self._any_level(), window).agg(F.max("metric_date")).first()[0]


class GroupedSqlSource(SqlSource):
    """A metric source whose one query gives all levels, so that it scans its tables once.

    The query groups by ``GROUPING SETS`` and returns ``metric_date``, the columns it groups by,
    ``level_id``, which is ``grouping_id`` over these columns, and measures. ``levels`` maps each level
    to its column, or to None for the level over everything. Each column not given a level is an error.
    """

    LEVEL_ID = "level_id"

    def __init__(
        self,
        spark: SparkSession,
        text: str,
        levels: Mapping[str, str | None],
        relations: Mapping[str, DataFrame] | None = None,
    ) -> None:
        super().__init__(spark, text, {level: {} for level in levels}, relations)
        self.levels = dict(levels)
        #: In the order in which the query names them to ``grouping_id``.
        self.columns = [column for column in levels.values() if column is not None]

    def level_id(self, level: str) -> int:
        """Bits of the columns that the level leaves out; the first column has the highest bit."""
        column = self.levels[level]
        bits = range(len(self.columns) - 1, -1, -1)
        return sum(1 << bit for bit, name in zip(bits, self.columns, strict=True) if name != column)

    def daily(self, levels: Sequence[str], window: DateWindow) -> DataFrame:
        """All levels from one run of the query."""
        if unknown := [level for level in levels if level not in self.levels]:
            raise ValueError(
                f"unknown dimension level {unknown}; known levels are {list(self.levels)}"
            )
        pulled = self._pull(window, {})
        if missing := {*self.columns, self.LEVEL_ID, "metric_date"} - set(pulled.columns):
            raise ValueError(f"the query does not return {sorted(missing)}")
        which = F.col(self.LEVEL_ID)
        ids = {level: self.level_id(level) for level in levels}
        places = [
            f"WHEN {i} THEN struct({literal(level)} AS dim_type, {self._value(level)} AS dimension)"
            for level, i in ids.items()
        ]
        place = F.expr(f"CASE {self.LEVEL_ID} {' '.join(places)} END")
        placed = pulled.filter(which.isin(list(ids.values()))).withColumn("_place", place)
        measures = _measures(pulled, "metric_date", self.LEVEL_ID, *self.columns)
        return placed.select("metric_date", "_place.dim_type", "_place.dimension", *measures)

    def _value(self, level: str) -> str:
        column = self.levels[level]
        return literal(level) if column is None else f"CAST({quoted(column)} AS STRING)"

    def _level(self, level: str, window: DateWindow) -> DataFrame:
        return self.daily([level], window)
