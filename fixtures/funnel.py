"""The six funnel roles and a source-of-truth table as views over ``orders`` and ``lineitem``."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.config import REVENUE_FUNNEL, AnomalyRules, MonitorConfig
from tidewatch.functions import business_date
from tidewatch.operators.stages import Lookup
from tidewatch.plans.engine import Binding
from tidewatch.plans.funnel import REVENUE_FUNNEL_STAGES, FunnelSource
from tidewatch.sources import ChannelMap, GroupedSqlSource, SqlSource

REPORT_DATE = dt.date(2000, 6, 15)
LAST_SOT_DATE = dt.date(2000, 12, 31)

PRIORITY_CHANNELS = ChannelMap(
    {
        "1-URGENT": "O&O",
        "2-HIGH": "O&O",
        "3-MEDIUM": "SEM",
        "4-NOT SPECIFIED": "SEO",
    }
)

# The fixture has about six orders a day, so its denominator floor is 3.
FUNNEL_MONITOR: MonitorConfig = dataclasses.replace(
    REVENUE_FUNNEL, rules=AnomalyRules(yoy_threshold=0.10, min_denominator=3)
)


SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table with its schema given, so that no job has to look for it."""
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


PRICE = "CAST(l_extendedprice AS decimal(18,2))"
NET = f"CAST({PRICE} * (1 - CAST(l_discount AS decimal(4,2))) AS decimal(18,4))"
MONEY = "decimal(18,4)"
#: A further level with 150 values.
BUYER = "concat('b', o_custkey % 150) AS buyer"


def funnel_roles(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders = read(spark, sf_dir, "orders")
    lineitem = read(spark, sf_dir, "lineitem")
    return {
        "visits": orders.selectExpr(
            "o_orderdate AS visit_date", "o_orderpriority AS segment", BUYER
        ),
        "requests": orders.selectExpr(
            "o_orderkey AS request_pk",
            "CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS request_created_time",
            "o_orderpriority AS segment",
            BUYER,
        ),
        "projects": lineitem.selectExpr(
            "l_orderkey AS request_pk",
            "CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS project_created_time",
        ),
        "contacts": lineitem.selectExpr(
            "l_orderkey * 10 + l_linenumber AS contact_pk",
            "l_orderkey AS request_pk",
            "l_shipdate AS contact_created_time",
        ),
        "rev_a": lineitem.filter("l_linestatus = 'F'").selectExpr(
            "l_orderkey AS request_pk",
            "l_shipdate AS transaction_timestamp",
            f"{NET} AS gross_revenue",
        ),
        "rev_b": lineitem.filter("l_linestatus = 'O'").selectExpr(
            "l_orderkey AS request_pk",
            "l_shipdate AS ts",
            f"CASE WHEN l_quantity > 1 THEN {NET} END AS net_revenue",
            f"CASE WHEN l_returnflag = 'R' THEN CAST(-{PRICE} * 0.1BD AS {MONEY}) END AS refund",
            f"CASE WHEN l_quantity > 40 THEN CAST(-{PRICE} * 0.05BD AS {MONEY}) END AS payout",
            f"CASE WHEN l_tax = 0 THEN CAST(1 AS {MONEY}) END AS transfer_reversal",
            f"CASE WHEN l_linenumber = 7 THEN CAST(5 AS {MONEY}) END AS cancellation_revenue",
        ),
    }


def funnel_source(spark: SparkSession, sf_dir: str) -> FunnelSource:
    return FunnelSource(funnel_roles(spark, sf_dir), channels=PRIORITY_CHANNELS)


def buyer_source(
    spark: SparkSession, sf_dir: str, channels: ChannelMap = PRIORITY_CHANNELS, segment: str = "segment"
) -> FunnelSource:
    """The funnel with the level ``buyer`` besides, or with buyers as segments."""
    stages = [
        dataclasses.replace(s, levels={"buyer": "buyer"}, segment=segment) if s.segment else s
        for s in REVENUE_FUNNEL_STAGES
    ]
    lookup = Lookup("requests", "request_pk", segment, levels={"buyer": "buyer"})
    return FunnelSource(funnel_roles(spark, sf_dir), stages, lookup, channels)


def funnel_binding(spark: SparkSession, sf_dir: str, validate: bool = True) -> Binding:
    """The funnel with its source of truth, or without, where nothing is validated."""
    source = funnel_source(spark, sf_dir)
    return Binding(source, sot_of(source.roles) if validate else None)


def source_of_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sot_of(funnel_roles(spark, sf_dir))


def sot_of(roles: dict[str, DataFrame]) -> DataFrame:
    """Per-day totals without joins, distorted on set days so that every verdict occurs."""

    def per_day(role: str, time: str, *aggregates) -> DataFrame:
        df = roles[role]
        dtype = df.schema[time].dataType
        return (
            df.filter(F.col(time).isNotNull())
            .selectExpr(f"{business_date(time, dtype)} AS metric_date", "*")
            .groupBy("metric_date")
            .agg(*aggregates)
        )

    adjusted = F.expr(
        "net_revenue + coalesce(refund, 0) + coalesce(payout, 0)"
        " + coalesce(transfer_reversal, 0) + coalesce(cancellation_revenue, 0)"
    )
    parts = [
        per_day("visits", "visit_date", F.count("*").alias("total_iv")),
        per_day(
            "requests",
            "request_created_time",
            F.countDistinct("request_pk").alias("total_requests"),
        ),
        per_day(
            "projects",
            "project_created_time",
            F.countDistinct("request_pk").alias("total_projects"),
        ),
        per_day("rev_a", "transaction_timestamp", F.sum("gross_revenue").alias("total_revenue")),
        per_day("rev_b", "ts", F.sum(adjusted).alias("total_revenue")),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    totals = stacked.groupBy("metric_date").agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("total_iv", "total_requests", "total_projects", "total_revenue")
        ]
    )
    day = F.dayofmonth("metric_date")
    factor = F.when(day % 2 == 1, F.lit("1.001")).otherwise(F.lit("1.01")).cast("decimal(4,3)")
    return totals.filter(F.col("metric_date") <= F.lit(LAST_SOT_DATE)).select(
        "metric_date",
        F.when(day != 2, F.col("total_iv")).cast("bigint").alias("total_iv"),
        F.col("total_requests").cast("bigint").alias("total_requests"),
        F.when(day == 1, F.lit(0)).otherwise(F.col("total_projects")).cast("bigint").alias(
            "total_projects"
        ),
        (F.col("total_revenue").cast("decimal(24,4)") * factor)
        .cast("decimal(28,4)")
        .alias("total_revenue"),
    )


FUNNEL_SQL = """
WITH stages AS (
    SELECT visit_day AS metric_date, {dimension} AS dimension, count(*) AS intentful_visitors,
           0L AS requests, 0L AS projects, 0L AS contacts, 0 AS revenue
    FROM {visits}
    WHERE visit_day BETWEEN :start_date AND :end_date
    GROUP BY ALL
    UNION ALL
    SELECT request_date, {dimension}, 0L, count(DISTINCT request_pk), 0L, 0L, 0
    FROM {requests}
    WHERE request_date BETWEEN :start_date AND :end_date
    GROUP BY ALL
    UNION ALL
    SELECT project_date, coalesce({dimension}, {unmatched}), 0L, 0L,
           count(DISTINCT request_pk), 0L, 0
    FROM {projects} LEFT JOIN {requests} USING (request_pk)
    WHERE project_date BETWEEN :start_date AND :end_date
    GROUP BY ALL
    UNION ALL
    SELECT contact_date, coalesce({dimension}, {unmatched}), 0L, 0L, 0L,
           count(DISTINCT contact_pk), 0
    FROM {contacts} LEFT JOIN {requests} USING (request_pk)
    WHERE contact_date BETWEEN :start_date AND :end_date
    GROUP BY ALL
    UNION ALL
    SELECT revenue_date, coalesce({dimension}, {unmatched}), 0L, 0L, 0L, 0L, sum(amount)
    FROM {revenue} LEFT JOIN {requests} USING (request_pk)
    WHERE revenue_date BETWEEN :start_date AND :end_date
    GROUP BY ALL
)
SELECT metric_date, dimension, sum(intentful_visitors) AS intentful_visitors,
       sum(requests) AS requests, sum(projects) AS projects, sum(contacts) AS contacts,
       cast(sum(revenue) AS decimal(28,4)) AS revenue
FROM stages
GROUP BY metric_date, dimension
"""


#: The same for all levels at once: every stage groups by sets of its day and channel.
GROUPED_SQL = """
WITH known AS (SELECT request_pk, channel FROM {requests}),
stages AS (
    SELECT visit_day AS metric_date, channel, grouping_id() AS level_id,
           count(*) AS intentful_visitors, 0L AS requests, 0L AS projects, 0L AS contacts, 0 AS revenue
    FROM {visits}
    WHERE visit_date >= :start_utc AND visit_date < :end_utc
    GROUP BY GROUPING SETS ((visit_day), (visit_day, channel))
    UNION ALL
    SELECT request_date, channel, grouping_id(), 0L, count(DISTINCT request_pk), 0L, 0L, 0
    FROM {requests}
    WHERE request_created_time >= :start_utc AND request_created_time < :end_utc
    GROUP BY GROUPING SETS ((request_date), (request_date, channel))
    UNION ALL
    SELECT project_date, found, grouping_id(), 0L, 0L, count(DISTINCT request_pk), 0L, 0
    FROM (SELECT project_date, request_pk, coalesce(channel, 'Other') AS found
          FROM {projects} LEFT JOIN known USING (request_pk)
          WHERE project_created_time >= :start_utc AND project_created_time < :end_utc)
    GROUP BY GROUPING SETS ((project_date), (project_date, found))
    UNION ALL
    SELECT contact_date, found, grouping_id(), 0L, 0L, 0L, count(DISTINCT contact_pk), 0
    FROM (SELECT contact_date, contact_pk, coalesce(channel, 'Other') AS found
          FROM {contacts} LEFT JOIN known USING (request_pk)
          WHERE contact_created_time >= :start_utc AND contact_created_time < :end_utc)
    GROUP BY GROUPING SETS ((contact_date), (contact_date, found))
    UNION ALL
    SELECT revenue_date, found, grouping_id(), 0L, 0L, 0L, 0L, sum(amount)
    FROM (SELECT revenue_date, amount, coalesce(channel, 'Other') AS found
          FROM {revenue} LEFT JOIN known USING (request_pk)
          WHERE ts >= :start_utc AND ts < :end_utc)
    GROUP BY GROUPING SETS ((revenue_date), (revenue_date, found))
)
SELECT metric_date, channel, level_id, sum(intentful_visitors) AS intentful_visitors,
       sum(requests) AS requests, sum(projects) AS projects, sum(contacts) AS contacts,
       cast(sum(revenue) AS decimal(28,4)) AS revenue
FROM stages
GROUP BY metric_date, channel, level_id
"""


def sql_relations(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The funnel's roles as a user's SQL reads them."""
    roles = funnel_roles(spark, sf_dir)
    ntz = T.TimestampNTZType()

    def labelled(role: str) -> DataFrame:
        coded = PRIORITY_CHANNELS.join(roles[role], "segment")
        return coded.selectExpr("*", "'overall' AS everything")

    def dated(df: DataFrame, time: str, name: str) -> DataFrame:
        return df.selectExpr("*", f"{business_date(time, ntz)} AS {name}")

    revenue_b = (
        "net_revenue + ifnull(refund, 0) + ifnull(payout, 0)"
        " + ifnull(transfer_reversal, 0) + ifnull(cancellation_revenue, 0)"
    )
    revenue = (
        roles["rev_a"]
        .selectExpr("request_pk", "transaction_timestamp AS ts", "gross_revenue AS amount")
        .unionByName(roles["rev_b"].selectExpr("request_pk", "ts", f"{revenue_b} AS amount"))
    )
    return {
        "visits": dated(labelled("visits"), "visit_date", "visit_day"),
        "requests": dated(labelled("requests"), "request_created_time", "request_date"),
        "projects": dated(roles["projects"], "project_created_time", "project_date"),
        "contacts": dated(roles["contacts"], "contact_created_time", "contact_date"),
        "revenue": dated(revenue, "ts", "revenue_date"),
    }


def funnel_sql_per_level(spark: SparkSession, sf_dir: str) -> SqlSource:
    """The same funnel as one SQL query per level, the way a user brings their own metric source."""
    levels = {
        "overall": {"dimension": F.col("everything"), "unmatched": "overall"},
        "channel": {"dimension": F.col("channel"), "unmatched": "Other"},
    }
    return SqlSource(spark, FUNNEL_SQL, levels, sql_relations(spark, sf_dir))


def funnel_sql_source(spark: SparkSession, sf_dir: str) -> GroupedSqlSource:
    """The same funnel as one SQL query for all levels."""
    levels = {"overall": None, "channel": "channel"}
    return GroupedSqlSource(spark, GROUPED_SQL, levels, sql_relations(spark, sf_dir))
