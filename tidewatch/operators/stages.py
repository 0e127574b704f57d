"""Daily stages of a funnel: scan, attribute, count.

Each stage yields rows ``metric_date, dim_type, dimension`` and its measure, one row per level for
every row or entity that counts there. Levels may be any number, and have any number of values.

A distinct count drops repeats of (day, entity, values of all levels) first, so an entity with very
many rows is collapsed before it is shuffled. What is left is brought together by (day, entity), and
only there spread into levels: dropping repeats per level needs no shuffle then, and the number of
levels does not change how many rows are shuffled.

Tasks sort and hash what they are given, and a shuffled byte takes ten in memory. Adaptive execution
merges partitions up to its advisory size, so that size is lowered to ``PARTITION_BYTES`` if it is larger.
Scans drop repeats in hash tables too, so the size of a file split is lowered to ``SPLIT_BYTES``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import DateWindow, business_date, missing_if_nan
from tidewatch.functions.text import literal
from tidewatch.operators.prefilter import key_filter, might_match
from tidewatch.sources.channels import ChannelMap

COUNT, DISTINCT, SUM = "count", "distinct", "sum"
OVERALL, CHANNEL = "overall", "channel"

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: Shuffled bytes up to which adaptive execution merges partitions for one task.
PARTITION_BYTES = 16 << 20
SPLIT = "spark.sql.files.maxPartitionBytes"
#: Bytes of files that one task of a scan is given; of Parquet, whole row groups.
SPLIT_BYTES = 32 << 20


@dataclass(frozen=True)
class Stage:
    """One measure taken from one role.

    ``value`` is the SQL expression counted distinctly or summed. The segment, which makes the
    ``channel`` level, comes from the role's own ``segment`` column, or from the lookup role through
    ``lookup_key``. ``levels`` names further levels and the expressions that give their values;
    a level it does not name comes from the lookup role. Several ``sum`` stages may share a
    measure; their rows are added up.
    """

    measure: str
    kind: str
    role: str
    time: str
    value: str | None = None
    segment: str | None = None
    lookup_key: str | None = None
    where: str | None = None
    levels: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind not in (COUNT, DISTINCT, SUM):
            raise ValueError(f"stage {self.measure!r}: unknown kind {self.kind!r}")
        if self.kind != COUNT and self.value is None:
            raise ValueError(f"stage {self.measure!r}: a {self.kind} stage needs a value")
        if (self.segment is None) == (self.lookup_key is None):
            raise ValueError(f"stage {self.measure!r}: give a segment or a lookup key, not both")

    @property
    def counts_its_key(self) -> bool:
        """Whether the entity counted is the lookup key itself."""
        return self.kind == DISTINCT and self.value == self.lookup_key

    def own_levels(self) -> dict[str, str]:
        """Levels that the role's own rows give, with their expressions."""
        own = dict(self.levels)
        if self.segment is not None:
            own[CHANNEL] = self.segment
        return own


@dataclass(frozen=True)
class Lookup:
    """The role that knows the segment of a key, and the values of further ``levels``.

    When a key repeats there, each copy is joined: sums grow with the copies and a key may
    count in several channels. Declare ``unique`` if keys never repeat, and the step that
    counts copies is left out.
    """

    role: str
    key: str
    segment: str
    unique: bool = False
    levels: Mapping[str, str] = field(default_factory=dict)

    def own_levels(self) -> dict[str, str]:
        return {**self.levels, CHANNEL: self.segment}


def small_partitions(spark: SparkSession) -> None:
    """Give a task ``PARTITION_BYTES`` shuffled and ``SPLIT_BYTES`` of files at most, or less if the session says so."""
    for name, default, most in ((ADVISORY, "64m", PARTITION_BYTES), (SPLIT, "128m", SPLIT_BYTES)):
        size, unit = re.fullmatch(r"(\d+)\s*([a-z]?)b?", spark.conf.get(name, default).strip().lower()).groups()
        if int(size) << 10 * " kmgtp".index(unit or " ") > most:
            spark.conf.set(name, str(most))


def level_column(level: str) -> str:
    return f"`level {level}`"


def first_column(level: str) -> str:
    return f"`first {level}`"


def stage_rows(
    roles: Mapping[str, DataFrame],
    stage: Stage,
    window: DateWindow,
    levels: Sequence[str] = (),
) -> DataFrame:
    """Rows of a stage inside the window: ``metric_date, value``, lookup key and own level values."""
    df = roles[stage.role]
    if stage.where is not None:
        df = df.filter(stage.where)
    dtype = df.schema[stage.time].dataType
    columns = [f"{business_date(stage.time, dtype)} AS metric_date"]
    own = stage.own_levels()
    columns += [f"{own[level]} AS {level_column(level)}" for level in levels if level in own]
    if stage.lookup_key is not None:
        columns.append(f"{stage.lookup_key} AS lookup_key")
    if stage.value is not None and not stage.counts_its_key:
        columns.append(f"{stage.value} AS value")
    inside = f"{stage.time} IS NOT NULL AND ({window.covers(stage.time, dtype)})"
    rows = df.filter(inside).selectExpr(*columns)
    if stage.kind == SUM:
        value_type = rows.schema["value"].dataType
        rows = rows.withColumn("value", missing_if_nan(F.col("value"), value_type))
    return rows


class StageReader:
    """Turns stages into daily counts by level for one set of roles."""

    def __init__(
        self,
        roles: Mapping[str, DataFrame],
        channels: ChannelMap,
        lookup: Lookup | None,
        stages: Sequence[Stage],
    ) -> None:
        self.roles = roles
        self.channels = channels
        self.lookup = lookup
        self.stages = tuple(stages)
        self._lookup_relations: dict[tuple, DataFrame] = {}
        self._key_filters: dict[DateWindow, DataFrame] = {}

    def check_levels(self, levels: Sequence[str]) -> tuple[str, ...]:
        """The levels as a tuple; one that a stage cannot give is an error."""
        for stage in self.stages:
            known = {OVERALL, *stage.own_levels()}
            if stage.lookup_key is not None:
                known |= set(self.lookup.own_levels())
            if unknown := [level for level in levels if level not in known]:
                raise ValueError(
                    f"unknown dimension level {unknown}; stage {stage.measure!r} knows {sorted(known)}"
                )
        if not levels:
            raise ValueError("unknown dimension level: give at least one")
        return tuple(levels)

    def _named(self, df: DataFrame, levels: Sequence[str]) -> DataFrame:
        """Level values as they are reported: mapped, if the level has a map, and never NULL."""
        for level in levels:
            name = level_column(level)
            if level == CHANNEL:
                mapped = self.channels.join(df, name, "channel_name")
                df = mapped.drop(name.strip("`")).withColumnRenamed("channel_name", name.strip("`"))
            else:
                value = F.coalesce(F.col(name).cast("string"), F.lit(ChannelMap.OTHER))
                df = df.withColumn(name.strip("`"), value)
        return df

    def _wanted_keys(self, window: DateWindow) -> DataFrame:
        """A filter of fixed size over the keys that any stage looks up in the window."""
        if window not in self._key_filters:
            keys = [
                stage_rows(self.roles, stage, window).select("lookup_key")
                for stage in self.stages
                if stage.lookup_key is not None
            ]
            self._key_filters[window] = key_filter(reduce(DataFrame.union, keys), "lookup_key")
        return self._key_filters[window]

    def _looked_up(self, levels: tuple[str, ...], window: DateWindow) -> DataFrame:
        """``lookup_key, copies`` and level values: how often each key occurs with each of them.

        Repeats of a key are counted before the shuffle, and the shuffle by key lies directly below
        the facts' join, so that adaptive execution can split a hot key there. A run over single days
        needs few of all keys ever seen: a filter of their hashes, the same for every stage, keeps
        the others out of the shuffle.
        """
        wanted = (levels, window if window.days is not None else None)
        if wanted not in self._lookup_relations:
            lookup, own = self.lookup, self.lookup.own_levels()
            named = [f"{own[level]} AS {level_column(level)}" for level in levels]
            role = self.roles[lookup.role].filter(f"{lookup.key} IS NOT NULL")
            known = role.selectExpr(f"{lookup.key} AS lookup_key", *named)
            if window.days is not None:
                known = might_match(known, "lookup_key", self._wanted_keys(window))
            known = self._named(known, levels)
            if lookup.unique:
                known = known.withColumn("copies", F.lit(1).cast("bigint"))
            else:
                known = known.groupBy(*[F.col(f"`{c}`") for c in known.columns]).agg(
                    F.count("*").alias("copies")
                )
            self._lookup_relations[wanted] = known
        return self._lookup_relations[wanted]

    def _key_type(self) -> T.DataType:
        key = self.roles[self.lookup.role].selectExpr(f"{self.lookup.key} AS lookup_key")
        return key.schema["lookup_key"].dataType

    def _attribute(
        self, rows: DataFrame, stage: Stage, levels: tuple[str, ...], window: DateWindow, mark: bool
    ) -> DataFrame:
        """Add level values and ``copies`` to stage rows; marks of a key's first rows, if asked for."""
        own = tuple(level for level in levels if level in stage.own_levels())
        other = tuple(level for level in levels if level not in own and level != OVERALL)
        rows = self._named(rows, own)
        # Without levels only the number of copies matters, and only to a sum.
        needs_copies = stage.kind != DISTINCT and stage.lookup_key and not self.lookup.unique
        if other or needs_copies:
            known = self._looked_up(other, window)
            if mark:
                # Above the shuffle by key, so that the other stages share it; the join uses the sort.
                known = mark_first(known, ["lookup_key"], levels)
            rows = rows.join(known, "lookup_key", "left")
            for level in other:
                name = level_column(level).strip("`")
                value = F.coalesce(F.col(f"`{name}`"), F.lit(ChannelMap.OTHER))
                rows = rows.withColumn(name, value)
        if stage.counts_its_key:
            # Taken from the key after the join, which leaves the rows of a key together.
            rows = rows.withColumn("value", F.col("lookup_key"))
        copies = F.coalesce("copies", F.lit(1)) if "copies" in rows.columns else F.lit(1)
        return rows.withColumn("copies", copies.cast("bigint"))

    def counts(
        self, stages: list[Stage], window: DateWindow, levels: tuple[str, ...]
    ) -> DataFrame:
        """``metric_date, dim_type, dimension`` and the measure that all of ``stages`` feed.

        A row with a NULL value is kept, as it still says that the day has data.
        """
        first = stages[0]
        if len({(s.kind, s.segment is None) for s in stages}) > 1:
            raise ValueError(f"measure {first.measure!r} mixes kinds of stages")
        small_partitions(self.roles[first.role].sparkSession)
        rows = reduce(
            DataFrame.unionByName,
            [stage_rows(self.roles, stage, window, levels) for stage in stages],
        )
        if first.counts_its_key:
            # Collapse repeats of a key before the join, however many rows one key has.
            rows = rows.distinct()
        # Rows that are distinct by day and key meet rows of the lookup, so what is first for a key
        # there is first for the entity. Where types differ, an entity could meet several keys.
        keyed = (
            first.counts_its_key
            and not any(level in first.own_levels() for level in levels)
            and rows.schema["lookup_key"].dataType == self._key_type()
        )
        mark = keyed and (len(levels) > 1 or self.lookup.unique)
        found = self._attribute(rows, first, levels, window, mark)
        if first.kind == DISTINCT:
            return self._first_counts(found, first, levels, keyed)
        spread = f"inline(array({', '.join(level_entry(level) for level in levels)}))"
        measure = "copies"
        if first.kind == SUM:
            measure = _times_copies("value", found.schema["value"].dataType)
        return found.selectExpr("metric_date", spread, f"{measure} AS `{first.measure}`")

    def _first_counts(
        self, found: DataFrame, stage: Stage, levels: tuple[str, ...], keyed: bool
    ) -> DataFrame:
        """Rows of a distinct count: 1 where an entity is first seen on its day at a level, else 0."""
        levels = tuple(dict.fromkeys(levels))
        values = [level_column(level) for level in levels if level != OVERALL]
        marks = [first_column(level) for level in levels if first_column(level).strip("`") in found.columns]
        # Copies are always positive. Naming them keeps the lookup the same for every stage,
        # so that Spark builds and shuffles it once.
        entities = found.filter("copies > 0").select("metric_date", "value", *values, *marks)
        if not keyed:
            entities = entities.distinct()
            if len(levels) > 1:
                entities = entities.repartition("metric_date", "value")
                entities = mark_first(entities, ["metric_date", "value"], levels)
                marks = [first_column(level) for level in levels]
        # A key that the lookup does not know has no marks, and one row.
        counted = {level: f"coalesce({first_column(level)}, true)" if marks else "true" for level in levels}
        spread = ", ".join(level_entry(level, f"{counted[level]} AS first") for level in levels)
        measure = f"CAST(first AND value IS NOT NULL AS BIGINT) AS `{stage.measure}`"
        seen = entities.selectExpr("metric_date", "value", f"inline(array({spread}))")
        return seen.selectExpr("metric_date", "dim_type", "dimension", measure)


def mark_first(df: DataFrame, group: Sequence[str], levels: Sequence[str]) -> DataFrame:
    """Per level, whether a row is the first of its group with its value there.

    Level values are not NULL. One sort serves the group as a whole and the first level; each further
    level takes a sort of its own.
    """
    named = [level_column(level) for level in levels if level != OVERALL]
    for level in levels:
        name = level_column(level)
        order = [name, *named] if name in named else named or [F.lit(0)]
        rows = Window.partitionBy(*group).orderBy(*dict.fromkeys(order))
        if level == OVERALL:
            first = F.row_number().over(rows) == 1
        else:
            first = ~F.lag(name).over(rows).eqNullSafe(F.col(name))
        df = df.withColumn(first_column(level).strip("`"), first)
    return df


def level_entry(level: str, *more: str) -> str:
    """SQL struct of a row's place in a level (P4), and what else it is to hold."""
    value = literal(OVERALL) if level == OVERALL else level_column(level)
    return f"struct({', '.join([f'{literal(level)} AS dim_type', f'{value} AS dimension', *more])})"


def _times_copies(value: str, dtype: T.DataType) -> str:
    product = f"{value} * copies"
    # Whole copies add no decimals, so the product keeps the scale of the value.
    return f"CAST({product} AS decimal(38,{dtype.scale}))" if isinstance(dtype, T.DecimalType) else product
