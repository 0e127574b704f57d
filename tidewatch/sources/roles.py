"""Source roles: which columns each stage reads, with declared types.

A role is any DataFrame with at least these columns. Reading selects them and nothing
else, so a columnar source is scanned for them only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MONEY = T.DecimalType(18, 4)
_MOMENT = T.TimestampNTZType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


REVENUE_FUNNEL_ROLES: dict[str, T.StructType] = {
    "visits": _schema(visit_date=T.DateType(), segment=T.StringType()),
    "requests": _schema(
        request_pk=T.LongType(), request_created_time=_MOMENT, segment=T.StringType()
    ),
    "projects": _schema(request_pk=T.LongType(), project_created_time=_MOMENT),
    "contacts": _schema(
        contact_pk=T.LongType(), request_pk=T.LongType(), contact_created_time=_MOMENT
    ),
    "rev_a": _schema(request_pk=T.LongType(), transaction_timestamp=_MOMENT, gross_revenue=_MONEY),
    "rev_b": _schema(
        request_pk=T.LongType(),
        ts=_MOMENT,
        net_revenue=_MONEY,
        refund=_MONEY,
        payout=_MONEY,
        transfer_reversal=_MONEY,
        cancellation_revenue=_MONEY,
    ),
}

SOT_SCHEMA = _schema(
    metric_date=T.DateType(),
    total_iv=T.LongType(),
    total_requests=T.LongType(),
    total_projects=T.LongType(),
    total_revenue=T.DecimalType(28, 4),
)


def as_role(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select a role's columns. Timestamps and keys keep their own type, the rest is cast.

    A timestamp with or without zone, or a string key, is as good as the declared type;
    casting it would only hide the column from the Parquet filter.
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    keeps_type = (T.TimestampType, T.TimestampNTZType, T.LongType, T.StringType)
    columns = []
    for field in schema:
        column = F.col(field.name)
        if df.schema[field.name].dataType != field.dataType and not isinstance(
            field.dataType, keeps_type
        ):
            column = column.cast(field.dataType).alias(field.name)
        columns.append(column)
    return df.select(*columns)


def read_role(spark: SparkSession, location: str, schema: T.StructType) -> DataFrame:
    """Read a role from a Parquet path (anything with a slash) or a catalog table."""
    df = spark.read.parquet(location) if "/" in location else spark.table(location)
    return as_role(df, schema)
