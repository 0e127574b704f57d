"""A second monitor, over ``events``: week-over-week only, with request keys that repeat."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures.funnel import read
from tidewatch.config import AnomalyRules, MonitorConfig, RatioMetric
from tidewatch.functions import business_date
from tidewatch.operators.stages import COUNT, DISTINCT, SUM, Lookup, Stage
from tidewatch.plans.funnel import FunnelSource
from tidewatch.sources import ChannelMap

EVENTS_DATE = dt.date(2024, 1, 29)

EVENT_CHANNELS = ChannelMap({"s0": "O&O", "s1": "SEM", "s2": "SEO", "s3": "Partnership"})

EVENT_STAGES = (
    Stage("intentful_visitors", COUNT, "visits", "visit_date", segment="segment"),
    Stage(
        "requests", DISTINCT, "requests", "request_created_time", "request_pk", segment="segment"
    ),
    Stage(
        "projects",
        DISTINCT,
        "purchases",
        "purchase_time",
        "request_pk",
        lookup_key="request_pk",
    ),
    Stage("contacts", DISTINCT, "clicks", "click_time", "contact_pk", lookup_key="request_pk"),
    Stage("revenue", SUM, "purchases", "purchase_time", "amount", lookup_key="request_pk"),
    Stage("errors", COUNT, "errors", "error_time", segment="segment"),
)

EVENTS_MONITOR = MonitorConfig(
    key="events_health",
    name="Events Health Daily Monitor",
    title="Daily Events Health",
    dimensions=("overall", "channel"),
    metrics=(
        RatioMetric("signup_rate", "Signups per View", "requests", "intentful_visitors"),
        RatioMetric("errors_per_view", "Errors per View", "errors", "intentful_visitors", "down"),
        RatioMetric("rpp", "Revenue per Project (RPP)", "revenue", "projects"),
    ),
    volume_metrics=("intentful_visitors", "requests", "projects", "contacts", "revenue", "errors"),
    rules=AnomalyRules(yoy_threshold=0.10, min_denominator=3),
    comparisons=("wow",),
    context="Product events of one month, compared week over week.",
    sot_columns={"intentful_visitors": "total_iv"},
)


def event_roles(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = read(spark, sf_dir, "events")
    segment = "concat('s', CAST(get_json_object(props, '$.k') AS int) % 5) AS segment"
    day = business_date("ts", T.TimestampNTZType())

    def of_type(kind: str, *columns: str) -> DataFrame:
        return events.filter(f"event_type = '{kind}'").selectExpr(*columns)

    key = "user_id AS request_pk"
    return {
        "visits": of_type("view", f"{day} AS visit_date", segment),
        "requests": of_type("signup", key, "ts AS request_created_time", segment),
        "clicks": of_type("click", "event_id AS contact_pk", key, "ts AS click_time"),
        "purchases": of_type(
            "purchase", key, "ts AS purchase_time", "CAST(value AS decimal(18,2)) AS amount"
        ),
        "errors": of_type("error", "ts AS error_time", segment),
    }


def events_source(spark: SparkSession, sf_dir: str) -> FunnelSource:
    return FunnelSource(
        event_roles(spark, sf_dir),
        EVENT_STAGES,
        Lookup("requests", "request_pk", "segment"),
        EVENT_CHANNELS,
    )


def events_sot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views per day, up to the last whole day."""
    visits = event_roles(spark, sf_dir)["visits"]
    return (
        visits.filter(F.col("visit_date") <= F.lit(EVENTS_DATE))
        .groupBy(F.col("visit_date").alias("metric_date"))
        .agg(F.count("*").alias("total_iv"))
    )
