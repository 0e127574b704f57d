"""Combining daily stages into one frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.stages import CHANNEL, OVERALL

__all__ = ["CHANNEL", "OVERALL", "combine_by_outer_join", "combine_counts", "ordered_daily"]

KEYS = ("metric_date", "dim_type", "dimension")


def sum_of(measure: str, dtype: T.DataType, result_type: str | None) -> Column:
    """Total of a measure, 0 where a stage has no rows; decimals keep their scale."""
    column = F.coalesce(F.sum(f"`{measure}`"), F.lit(0))
    if result_type is None and isinstance(dtype, T.DecimalType):
        result_type = f"decimal(38,{dtype.scale})"
    elif result_type is None:
        result_type = "double" if isinstance(dtype, (T.FloatType, T.DoubleType)) else "bigint"
    return column.cast(result_type).alias(measure)


def combine_counts(
    counts: Sequence[DataFrame], result_types: Mapping[str, str | None]
) -> DataFrame:
    """One row per day, level and dimension value; a stage without rows there counts 0.

    The stages are padded with NULL columns, stacked and grouped, which gives the rows of a
    chain of full outer joins without its shuffles. Sums are taken before the shuffle.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
    types = {f.name: f.dataType for f in stacked.schema}
    totals = [sum_of(m, types[m], kind) for m, kind in result_types.items() if m in types]
    daily = stacked.groupBy(*KEYS).agg(*totals)
    return daily.filter(F.col("metric_date").isNotNull())


def ordered_daily(daily: DataFrame) -> DataFrame:
    """A daily frame in the order in which it is handed out: by date, then dimension (O1)."""
    order = [F.col("metric_date"), *[F.col(c) for c in ("dim_type", "dimension") if c in daily.columns]]
    return daily.orderBy(*order)


def combine_by_outer_join(
    stages: Sequence[DataFrame], result_types: Mapping[str, str | None]
) -> DataFrame:
    """The same for one level, as chained full outer joins of ``metric_date, dimension`` frames.

    Costs a shuffle of both sides per stage. Kept as the second form that tests and the
    benchmark hold against :func:`combine_counts`.
    """
    keys = ["metric_date", "dimension"]
    joined = reduce(lambda a, b: a.join(b, keys, "full_outer"), stages)
    types = {f.name: f.dataType for f in joined.schema}
    measures = [
        F.coalesce(F.col(f"`{m}`"), F.lit(0)).cast(kind or types[m]).alias(m)
        for m, kind in result_types.items()
        if m in types
    ]
    return joined.select(*keys, *measures).filter(F.col("metric_date").isNotNull())
