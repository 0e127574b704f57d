"""Comparison with earlier days.

Three forms give the same rows. The default groups once per dimension value and picks each
day with a conditional aggregate, so partial aggregation leaves one row per dimension value
and task before the only shuffle. The self-join and the range window are kept as forms to
check it against.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.config import MonitorConfig
from tidewatch.functions import pct_change
from tidewatch.functions.text import quoted

KEYS = ("dim_type", "dimension")
FORMS = ("pivot", "join", "window")
CURRENT = "current"


def comparison_days(config: MonitorConfig, anchor: dt.date) -> tuple[dt.date, ...]:
    """The report day and the days it is compared with."""
    return (anchor, *(anchor - dt.timedelta(days=n) for n in config.offsets.values()))


def add_deltas(
    daily: DataFrame, config: MonitorConfig, anchor: dt.date, form: str = "pivot"
) -> DataFrame:
    """One row per dimension value present on ``anchor``.

    For every metric and volume column ``c``: ``c``, ``c_wow_prior``, ``c_wow``,
    ``c_yoy_prior``, ``c_yoy``. Values seen only on an earlier day do not appear (T6).
    ``(dim_type, dimension, metric_date)`` must be a key of ``daily``.
    """
    columns = config.compared_columns(daily.columns)
    build = {"pivot": _by_pivot, "join": _by_join, "window": _by_window}[form]
    wide = build(daily, columns, config, anchor)
    return wide.selectExpr(
        "dimension", f"DATE '{anchor}' AS metric_date", *_with_changes(columns, config), "dim_type"
    )


def _with_changes(columns: Sequence[str], config: MonitorConfig) -> list[str]:
    """SQL for the compared columns, and for each comparison their prior values and changes."""
    output = [quoted(c) for c in columns]
    for name in config.offsets:
        for c in columns:
            prior = quoted(f"{c}_{name}_prior")
            output += [prior, f"{pct_change(quoted(c), prior)} AS {quoted(f'{c}_{name}')}"]
    return output


def add_deltas_by_date(daily: DataFrame, config: MonitorConfig, days: DataFrame) -> DataFrame:
    """The same for many report dates at once, told apart by ``report_date``.

    ``days`` says which ``day`` each ``report_date`` needs as what: ``part`` is ``current`` or the name of
    a comparison. It has a few rows per report date, all from the caller's program, and is broadcast;
    a day that serves several report dates fans out to them before it is grouped.
    """
    columns = config.compared_columns(daily.columns)
    needed = daily.join(F.broadcast(days), F.col("metric_date") == F.col("day"))

    def of_part(part: str, column: str, name: str):
        return F.expr(f"max({quoted(column)}) FILTER (WHERE part = '{part}') AS {quoted(name)}")

    picked = [of_part(CURRENT, c, c) for c in ("metric_date", *columns)]
    picked += [of_part(name, c, f"{c}_{name}_prior") for name in config.offsets for c in columns]
    wide = needed.groupBy("report_date", *KEYS).agg(*picked).filter("metric_date IS NOT NULL")
    return wide.selectExpr(
        "report_date", "dimension", "metric_date", *_with_changes(columns, config), "dim_type"
    )


def _by_pivot(
    daily: DataFrame, columns: Sequence[str], config: MonitorConfig, anchor: dt.date
) -> DataFrame:
    def on_day(day: dt.date, column: str, name: str):
        return F.expr(
            f"max({quoted(column)}) FILTER (WHERE metric_date = DATE '{day}') AS {quoted(name)}"
        )

    picked = [on_day(anchor, c, c) for c in columns]
    for name, offset in config.offsets.items():
        prior_day = anchor - dt.timedelta(days=offset)
        picked += [on_day(prior_day, c, f"{c}_{name}_prior") for c in columns]
    present = F.expr(f"bool_or(metric_date = DATE '{anchor}') AS present")
    rows = daily.filter(_on_days(config, anchor))
    return rows.groupBy(*KEYS).agg(present, *picked).filter("present")


def _on_days(config: MonitorConfig, anchor: dt.date) -> str:
    days = ", ".join(f"DATE '{d}'" for d in comparison_days(config, anchor))
    return f"metric_date IN ({days})"


def _by_join(
    daily: DataFrame, columns: Sequence[str], config: MonitorConfig, anchor: dt.date
) -> DataFrame:
    wide = daily.filter(F.col("metric_date") == F.lit(anchor)).select(
        "metric_date", *KEYS, *map(quoted, columns)
    )
    for name, days in config.offsets.items():
        prior = daily.select(
            F.date_add("metric_date", days).alias("metric_date"),
            *KEYS,
            *[F.col(quoted(c)).alias(f"{c}_{name}_prior") for c in columns],
        ).filter(F.col("metric_date") == F.lit(anchor))
        wide = wide.join(prior, ["metric_date", *KEYS], "left")
    return wide


def _by_window(
    daily: DataFrame, columns: Sequence[str], config: MonitorConfig, anchor: dt.date
) -> DataFrame:
    # A range of day numbers, not lag(): lag takes the previous row when days are missing.
    day_number = F.unix_date("metric_date")
    added = {}
    for name, days in config.offsets.items():
        window = Window.partitionBy(*KEYS).orderBy(day_number).rangeBetween(-days, -days)
        added |= {f"{c}_{name}_prior": F.first(quoted(c)).over(window) for c in columns}
    rows = daily.filter(_on_days(config, anchor)).withColumns(added)
    return rows.filter(F.col("metric_date") == F.lit(anchor))
