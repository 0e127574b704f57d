"""Helpers shared by the operators: reading tables, cutting lineage, counting in parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.sources.shared import checkpoint_folder

#: ASCII white space that parts words: space and \x09 to \x0D, what ``bytes.split()`` parts on.
SPACES = " \t\n\r\x0b\x0c"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of one group that one task numbers.
ROWS_PER_BUCKET = 5_000

#: Rows of whole texts that one Arrow batch holds, so that a batch of long texts stays small.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small, whatever the length of the texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def cut(df: DataFrame) -> DataFrame:
    """Write a frame to the checkpoint folder and go on from there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def word_count(text: str | Column) -> Column:
    """Words of a text as SQL; NULL has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    bucket: str,
    totals: dict[str, str],
) -> DataFrame:
    """Add exclusive running totals inside a group, without gathering the group in one task.

    ``bucket`` is a column that grows with ``order``: rows are ordered inside a bucket, and the
    totals of earlier buckets come from one row per bucket. ``totals`` maps new columns to the
    columns they sum. The number of buckets per group bounds what one task sees of a group.
    """
    group = list(group)
    sums = df.groupBy(*group, bucket).agg(
        *[F.sum(column).alias(f"{name}_sum") for name, column in totals.items()]
    )
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *[F.col(key).alias(f"{key}_key") for key in [*group, bucket]],
        *[
            F.coalesce(F.sum(f"{name}_sum").over(before), F.lit(0)).alias(f"{name}_before")
            for name in totals
        ],
    )
    inside = (
        Window.partitionBy(*group, bucket)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = df.withColumns(
        {
            name: F.coalesce(F.sum(column).over(inside), F.lit(0))
            for name, column in totals.items()
        }
    )
    same = [rows[key].eqNullSafe(sums[f"{key}_key"]) for key in [*group, bucket]]
    joined = rows.join(sums, same)
    return joined.withColumns(
        {name: (F.col(name) + F.col(f"{name}_before")).cast("long") for name in totals}
    ).select(*df.columns, *totals)


def numbered(df: DataFrame, group: Sequence[str], group_rows: str, number: str) -> DataFrame:
    """Number the rows of each group from 0, without gaps; ``group_rows`` has the group's size.

    Equal rows are counted first and spread out again at the end, and different ones are dealt into
    buckets by hash, so neither a large group nor a row repeated very often lands in one task.
    """
    columns = df.columns
    buckets = F.ceil(F.col(group_rows) / ROWS_PER_BUCKET)
    counted = (
        df.groupBy(*columns)
        .agg(F.count("*").alias("equal_rows"))
        .withColumn("number_bucket", F.pmod(F.xxhash64(*columns), buckets))
    )
    ahead = running_totals(counted, group, columns, "number_bucket", {number: "equal_rows"})
    spread = ahead.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("equal_rows") - 1)))
    return spread.select(*columns, (F.col(number) + F.col("copy")).alias(number))
