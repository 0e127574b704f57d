"""Business dates and windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.config import REVENUE_FUNNEL
from tidewatch.functions import DateWindow, as_date, business_date, day_start_utc

ZONES = ["UTC", "Asia/Tokyo", "America/Chicago", "America/Los_Angeles"]
NTZ, LTZ = T.TimestampNTZType(), T.TimestampType()


@pytest.mark.parametrize("zone", ZONES)
def test_pacific_midnight(spark, session_zone, zone):
    session_zone(zone)
    cases = {
        "2024-01-01 07:59:59": dt.date(2023, 12, 31),
        "2024-01-01 08:00:00": dt.date(2024, 1, 1),
        "2024-07-01 06:59:59": dt.date(2024, 6, 30),
        "2024-07-01 07:00:00": dt.date(2024, 7, 1),
        # 01:30 in Chicago comes twice on this day; only the second is past Pacific midnight.
        "2024-11-03 06:30:00": dt.date(2024, 11, 2),
        "2024-11-03 07:30:00": dt.date(2024, 11, 3),
        "1969-12-31 23:00:00": dt.date(1969, 12, 31),
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select(
        "t",
        F.col("t").cast("timestamp_ntz").alias("ntz"),
        F.to_timestamp(F.concat("t", F.lit("+00:00"))).alias("ltz"),
    )
    got = rows.selectExpr(
        "t", f"{business_date('ntz', NTZ)} AS a", f"{business_date('ltz', LTZ)} AS b"
    ).collect()
    assert {r.t: r.a for r in got} == cases
    assert {r.t: r.b for r in got} == cases


def test_null_and_wrong_type(spark):
    got = spark.sql(f"SELECT {business_date('CAST(NULL AS TIMESTAMP_NTZ)', NTZ)} AS d").first()
    assert got.d is None
    with pytest.raises(TypeError):
        business_date("t", T.StringType())


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_raw_bounds_equal_the_date_filter_across_clock_changes(spark, session_zone, zone):
    session_zone(zone)
    hours = spark.range(0, 24 * 380 * 2).select(
        F.timestamp_add(
            "MINUTE", F.col("id") * 30, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        ).alias("ntz")
    )
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    hours = hours.withColumn("ltz", F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, "ntz")))
    zoned = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit("America/Los_Angeles"), F.col("ntz")))
    hours = hours.withColumn("expected", zoned)
    for first, last in [("2024-03-10", "2024-03-10"), ("2024-03-09", "2024-11-03"), ("2024-11-03", "2024-11-03")]:
        window = DateWindow(as_date(first), as_date(last))
        inside = F.col("expected").between(F.lit(window.start), F.lit(window.end))
        for name, dtype in (("ntz", NTZ), ("ltz", LTZ)):
            wrong = hours.filter(inside != F.expr(window.covers(name, dtype)))
            assert wrong.isEmpty()
    assert hours.filter(F.expr(business_date("ntz", NTZ)) != F.col("expected")).isEmpty()


def test_windows():
    day = as_date("2000-06-15")
    window = DateWindow.lookback(day, REVENUE_FUNNEL.lookback_days)
    assert window.start == dt.date(1999, 6, 1)
    chosen = window.only(day, day - dt.timedelta(days=364), day - dt.timedelta(days=400))
    assert chosen.days == (dt.date(1999, 6, 17), day)
    assert window.only().covers("d", T.DateType()) == "false"
    assert day_start_utc(dt.date(2024, 7, 1)).hour == 7


def test_bad_dates():
    for text in ("2024-13-01", "yesterday", "2024/01/01"):
        with pytest.raises(ValueError):
            as_date(text)
    assert as_date(dt.datetime(2024, 1, 2, 3)) == dt.date(2024, 1, 2)
