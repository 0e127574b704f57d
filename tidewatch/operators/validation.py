"""Check of overall totals against a source of truth."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import missing_if_nan, relative_difference

VALIDATION_TOLERANCE = 0.002


def _number(column: Column) -> Column:
    """A double; NaN is missing."""
    return missing_if_nan(column.cast("double"), T.DoubleType())


def _unpivot(pairs: list[tuple[str, Column]], value: str) -> Column:
    return F.inline(
        F.array(
            *[
                F.struct(F.lit(metric).alias("metric"), _number(column).alias(value))
                for metric, column in pairs
            ]
        )
    )


def validate_against_sot(
    summary: DataFrame,
    sot: DataFrame,
    report_date: dt.date,
    sot_columns: Mapping[str, str],
    tolerance: float = VALIDATION_TOLERANCE,
) -> DataFrame:
    """``metric, our_value, sot_value, pct_diff, passed`` for each mapped metric.

    The table is read at the requested report date even when the summary fell back to an
    earlier day (T8). A metric without a row: our value or theirs is NULL, or theirs is 0.
    """
    dated = summary.withColumn("report_date", F.lit(report_date))
    return validate_by_date(dated, sot, [report_date], sot_columns, tolerance).drop("report_date")


def validate_by_date(
    summary: DataFrame,
    sot: DataFrame,
    report_dates: Sequence[dt.date],
    sot_columns: Mapping[str, str],
    tolerance: float = VALIDATION_TOLERANCE,
) -> DataFrame:
    """The same for many report dates: ``report_date`` first, which the summary has as well."""
    mapped = {
        ours: theirs
        for ours, theirs in sot_columns.items()
        if ours in summary.columns and theirs in sot.columns
    }
    if not mapped:
        # Nothing to compare: the table serves for its dates only.
        return summary.limit(0).selectExpr(
            "report_date",
            "'' AS metric",
            "0D AS our_value",
            "0D AS sot_value",
            "0D AS pct_diff",
            "true AS passed",
        )
    our_values = summary.select(
        "report_date", _unpivot([(m, F.col(m)) for m in mapped], "our_value")
    )
    # One row per date even if it repeats, in which case the smallest is taken; see repeated_dates.
    their_rows = (
        sot.filter(F.col("metric_date").isin([F.lit(d) for d in report_dates]))
        .groupBy(F.col("metric_date").alias("report_date"))
        .agg(F.min(F.struct(*mapped.values())).alias("row"))
    )
    their_values = their_rows.select(
        "report_date", _unpivot([(m, F.col("row")[c]) for m, c in mapped.items()], "sot_value")
    )
    # One row per asked date and mapped metric.
    compared = our_values.join(F.broadcast(their_values), ["report_date", "metric"]).filter(
        F.col("our_value").isNotNull() & (F.col("sot_value") != 0)
    )
    difference = relative_difference("our_value", "sot_value")
    return compared.selectExpr("*", f"{difference} AS pct_diff").withColumn(
        "passed", F.col("pct_diff") <= tolerance
    )


def repeated_dates(sot: DataFrame) -> DataFrame:
    """``metric_date, n_rows`` of dates that the source of truth has more than once."""
    counted = sot.groupBy("metric_date").agg(F.count("*").alias("n_rows"))
    return counted.filter("n_rows > 1")


def failed_validations(validations: DataFrame) -> DataFrame:
    """Checks that did not pass."""
    return validations.filter(~F.col("passed"))


def validation_verdict(validations: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``validated, failed, passed`` in one row; ``passed`` is NULL when nothing was compared.

    With ``by``, one row per value of these columns that has any check.
    """
    return validations.groupBy(*by).agg(
        F.count("*").alias("validated"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.bool_and("passed").alias("passed"),
    )
