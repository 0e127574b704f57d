"""Shared Spark session and in-memory sources."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def session_zone(spark):
    """Sets the session time zone for one test."""
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda zone: spark.conf.set("spark.sql.session.timeZone", zone)
    spark.conf.set("spark.sql.session.timeZone", before)


class FrameSource:
    """A daily source over a finished frame."""

    def __init__(self, daily):
        self.frame = daily

    def daily(self, levels, window):
        df = self.frame.filter(F.col("dim_type").isin(list(levels)))
        df = df.filter(window.covers("metric_date", df.schema["metric_date"].dataType))
        return df

    def has_rows_on(self, day):
        return not self.frame.filter(F.col("metric_date") == F.lit(day)).isEmpty()

    def latest_day(self, window):
        inside = window.covers("metric_date", self.frame.schema["metric_date"].dataType)
        return self.frame.filter(inside).agg(F.max("metric_date")).first()[0]


@pytest.fixture
def frame_source():
    return FrameSource


@pytest.fixture
def daily_frame(spark):
    """Builds a daily frame from ``(date text, dim_type, dimension, iv, req, prj, con, rev)``."""
    schema = (
        "metric_date string, dim_type string, dimension string, intentful_visitors bigint,"
        " requests bigint, projects bigint, contacts bigint, revenue double"
    )

    def build(rows):
        df = spark.createDataFrame(rows, schema)
        return df.withColumn("metric_date", F.to_date("metric_date"))

    return build
