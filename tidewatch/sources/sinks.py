"""Report archive and run payload.

An archive is either a log, to which every run adds a row, or keeps one row per run: partitioned by
report date and monitors asked for, of which a rerun replaces its own and touches no other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARCHIVE_SCHEMA = T.StructType(
    [
        T.StructField("report_date", T.DateType()),
        T.StructField("created_timestamp", T.TimestampType()),
        T.StructField("headline", T.StringType()),
        T.StructField("markdown_report", T.StringType()),
        T.StructField("findings_json", T.StringType()),
        T.StructField("anomaly_count", T.LongType()),
        T.StructField("monitors_run", T.StringType()),
        T.StructField("token_cost_usd", T.DoubleType()),
    ]
)


def append_archive(row: DataFrame, location: str) -> None:
    """Append an archive row to a Parquet path (anything with a slash) or a catalog table."""
    ordered = row.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ARCHIVE_SCHEMA])
    if "/" in location:
        ordered.write.mode("append").parquet(location)
    else:
        ordered.write.mode("append").saveAsTable(location)


ARCHIVE_KEYS = ("report_date", "monitors_run")


def replace_in_archive(row: DataFrame, location: str) -> None:
    """Write archive rows in place of those of the same report date and monitors, if there are any.

    ``location`` is a Parquet path (anything with a slash) or a catalog table.
    """
    values = [f for f in ARCHIVE_SCHEMA if f.name not in ARCHIVE_KEYS]
    keys = [f for f in ARCHIVE_SCHEMA if f.name in ARCHIVE_KEYS]
    ordered = row.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in [*values, *keys]]
    )
    writer = ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if "/" in location:
        writer.partitionBy(*ARCHIVE_KEYS).parquet(location)
    elif row.sparkSession.catalog.tableExists(location):
        writer.insertInto(location, overwrite=True)
    else:
        writer.format("parquet").partitionBy(*ARCHIVE_KEYS).saveAsTable(location)


def read_archive(spark: SparkSession, location: str) -> DataFrame:
    """An archive written by :func:`replace_in_archive`, columns in their order."""
    names = [f.name for f in ARCHIVE_SCHEMA]
    if "/" in location:
        return spark.read.schema(ARCHIVE_SCHEMA).parquet(location).select(*names)
    return spark.table(location).select(*names)


def exit_payload(archive: DataFrame) -> DataFrame:
    """The run result as JSON text: ``report``, ``headline``, ``report_date``."""
    fields = F.struct(
        F.col("markdown_report").alias("report"),
        "headline",
        F.date_format("report_date", "yyyy-MM-dd").alias("report_date"),
    )
    return archive.select(F.to_json(fields).alias("payload"))
