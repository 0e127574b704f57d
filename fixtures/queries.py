"""The registered queries: one per operator group, each over the whole given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures.events import EVENTS_MONITOR, events_sot, events_source
from fixtures.funnel import (
    FUNNEL_MONITOR,
    PRIORITY_CHANNELS,
    REPORT_DATE,
    buyer_source,
    funnel_binding,
    funnel_roles,
    funnel_source,
    funnel_sql_per_level,
    funnel_sql_source,
    source_of_truth,
)
from fixtures.usage import conversation_usage
from tidewatch.config import MonitorRegistry, parse_keys
from tidewatch.functions import DateWindow
from tidewatch.operators.anomalies import small_denominators
from tidewatch.operators.combine import ordered_daily
from tidewatch.operators.cost import cost_by_model, run_costs
from tidewatch.operators.metrics import add_ratio_metrics
from tidewatch.operators.validation import failed_validations
from tidewatch.plans.backfill import Backfill, backfill
from tidewatch.plans.engine import (
    Binding,
    MonitorEngine,
    MonitorResult,
    latest_sot_date,
    resolve_report_date,
    sot_has_date,
    stack_details,
)
from tidewatch.plans.report import (
    anomaly_section,
    archive_row,
    channel_table,
    findings_json,
    prompt_texts,
    report_texts,
    scorecard,
)
from tidewatch.sources import (
    ChannelMap,
    DailyStore,
    checkpoint_folder,
    exit_payload,
    load_monitor,
    read_archive,
    replace_in_archive,
    shared,
)

Query = Callable[[SparkSession, str], DataFrame]

ALL_TIME = DateWindow.always()
LEVELS = ("overall", "channel")
VALIDATION_DATES = ("2000-06-15", "2000-06-16", "2000-06-01", "2000-06-02", "2001-06-15")
ANOMALY_DATES = ("1999-06-15", "2000-06-15", "2000-12-31", "2001-06-15")
FALLBACK_DATES = ("2001-11-10", "2002-01-01")
REQUESTED = "revenue_funnel, events_health, not_registered"
#: When the archive row of the registered queries is taken to be written.
WRITTEN = "TIMESTAMP '2001-01-01 06:00:00'"


def run(
    spark: SparkSession,
    sf_dir: str,
    date=REPORT_DATE,
    form: str = "pivot",
    persist: bool = False,
    validate: bool = False,
) -> MonitorResult:
    """The funnel monitor on one date."""
    binding = funnel_binding(spark, sf_dir, validate)
    engine = MonitorEngine(MonitorRegistry(FUNNEL_MONITOR), {FUNNEL_MONITOR.key: binding})
    return engine.run(FUNNEL_MONITOR.key, date, persist, form)


def run_both(spark: SparkSession, sf_dir: str, persist: bool = False) -> list[MonitorResult]:
    """Both monitors, each on the latest date of its source of truth."""
    engine = MonitorEngine(
        MonitorRegistry(FUNNEL_MONITOR, EVENTS_MONITOR),
        {
            FUNNEL_MONITOR.key: funnel_binding(spark, sf_dir),
            EVENTS_MONITOR.key: Binding(events_source(spark, sf_dir), events_sot(spark, sf_dir)),
        },
    )
    return engine.run_all(REQUESTED, persist=persist)


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and doubles rounded to 9 places, for comparison across engines."""
    columns = []
    for field in df.schema:
        name = field.name
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType)):
            columns.append(f"round(CAST({name} AS DOUBLE), 9) AS {name}")
        else:
            columns.append(name)
    return df.selectExpr(*columns)


def _stage(measure: str) -> Query:
    return lambda spark, sf: comparable(
        funnel_source(spark, sf).measure(measure, "channel", ALL_TIME)
    )


def _level(level: str) -> Query:
    return lambda spark, sf: comparable(
        funnel_source(spark, sf).daily([level], ALL_TIME).drop("dim_type")
    )


def _delta(name: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        result = run(spark, sf)
        columns = result.config.compared_columns(result.detail.columns)
        picked = [x for c in columns for x in (c, f"{c}_{name}_prior", f"{c}_{name}")]
        return comparable(result.detail.select("dimension", "metric_date", "dim_type", *picked))

    return query


def _detail(form: str) -> Query:
    return lambda spark, sf: comparable(run(spark, sf, form=form).detail)


def _per_date(
    dates: Sequence[str], frame: Callable[[Backfill], DataFrame], validate: bool = False
) -> Query:
    """A frame of one plan over several report dates."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        binding = funnel_binding(spark, sf, validate)
        engine = MonitorEngine(MonitorRegistry(FUNNEL_MONITOR), {FUNNEL_MONITOR.key: binding})
        return comparable(frame(backfill(engine, FUNNEL_MONITOR.key, dates)))

    return query


def _of_run(frame: Callable[[MonitorResult], DataFrame]) -> Query:
    return lambda spark, sf: comparable(frame(run(spark, sf)))


def _of_both(frame: Callable[[list[MonitorResult]], DataFrame]) -> Query:
    return lambda spark, sf: frame(run_both(spark, sf))


def funnel_metrics(spark: SparkSession, sf: str) -> DataFrame:
    daily = funnel_source(spark, sf).daily(LEVELS, ALL_TIME)
    return comparable(add_ratio_metrics(daily, FUNNEL_MONITOR))


def funnel_three_levels(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(buyer_source(spark, sf).daily((*LEVELS, "buyer"), ALL_TIME))


def funnel_many_channels(spark: SparkSession, sf: str) -> DataFrame:
    """A hundred channels, by a map of the buyers."""
    channels = ChannelMap({f"b{i}": f"group {i % 100}" for i in range(150)})
    source = buyer_source(spark, sf, channels, "buyer")
    return comparable(source.daily(["channel"], ALL_TIME).drop("dim_type"))


def date_check(spark: SparkSession, sf: str) -> DataFrame:
    sot = source_of_truth(spark, sf)
    days = (dt.date(2000, 6, 15), dt.date(2001, 6, 15))
    rows = [(day, sot_has_date(sot, resolve_report_date(sot, day))) for day in days]
    return spark.createDataFrame(rows, "report_date date, in_sot boolean")


def archive(spark: SparkSession, sf: str) -> DataFrame:
    costs = run_costs(conversation_usage(spark, sf))
    results = run_both(spark, sf)
    return archive_row(results, parse_keys(REQUESTED), costs, F.expr(WRITTEN))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid4().hex}"


def detail_from_store(spark: SparkSession, sf: str) -> DataFrame:
    """Detail of a run whose days were kept one after the other; only its own day is computed for it."""
    binding = funnel_binding(spark, sf, validate=False)
    store = DailyStore(binding.source, scratch(spark, "store"), LEVELS)
    store.refresh([REPORT_DATE - dt.timedelta(days=n) for n in (1, 7, 8, 364, 365)])
    engine = MonitorEngine(MonitorRegistry(FUNNEL_MONITOR), {FUNNEL_MONITOR.key: Binding(store)})
    return comparable(engine.run(FUNNEL_MONITOR.key, REPORT_DATE).detail)


def archive_rewritten(spark: SparkSession, sf: str) -> DataFrame:
    """A run archived twice, and read: one row."""
    location = scratch(spark, "archive")
    row = shared(archive(spark, sf))
    for _ in range(2):
        replace_in_archive(row, location)
    columns = ("report_date", "anomaly_count", "monitors_run", "token_cost_usd")
    return comparable(read_archive(spark, location).select(*columns))


def from_files(spark: SparkSession, sf: str) -> MonitorResult:
    """A monitor that consists of a JSON and two SQL files."""
    folder = Path(__file__).resolve().parent
    config, source, sot = load_monitor(spark, folder / "order_health.json", {"tables": sf})
    engine = MonitorEngine(MonitorRegistry(config), {config.key: Binding(source, sot)})
    return engine.run(config.key, REPORT_DATE)


def pull_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the pulls of a run, observed while they are written."""
    result = run(spark, sf)
    for pull in result.raw.values():
        shared(pull)
    return spark.createDataFrame(list(result.pull_sizes().items()), "level string, n_rows bigint")


def channel_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Visits per segment and the channel the lookup join gives it."""
    visits = PRIORITY_CHANNELS.join(funnel_roles(spark, sf)["visits"], "segment")
    return visits.groupBy("segment", "channel").agg(
        F.count("*").alias("visits")
    )


def anomaly_items(result: MonitorResult) -> DataFrame:
    section = anomaly_section(result.anomalies)
    return section.selectExpr("anomaly_count", "posexplode(items) AS (position, item)")


def archive_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """The archive row without its texts and its time of writing."""
    columns = ("report_date", "anomaly_count", "monitors_run", "token_cost_usd")
    return comparable(archive(spark, sf).select(*columns))


def token_cost(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(cost_by_model(run_costs(conversation_usage(spark, sf))))


def registered() -> dict[str, Query]:
    return {
        "visits_daily": _stage("intentful_visitors"),
        "requests_daily": _stage("requests"),
        "projects_daily": _stage("projects"),
        "contacts_daily": _stage("contacts"),
        "revenue_daily": _stage("revenue"),
        "funnel_overall": _level("overall"),
        "funnel_channel": _level("channel"),
        "funnel_channel_outer_join": lambda spark, sf: comparable(
            funnel_source(spark, sf).daily_by_outer_join("channel", ALL_TIME)
        ),
        "funnel_levels": lambda spark, sf: comparable(
            funnel_source(spark, sf).daily(LEVELS, ALL_TIME)
        ),
        "funnel_sql_source": lambda spark, sf: comparable(
            funnel_sql_source(spark, sf).daily(LEVELS, ALL_TIME)
        ),
        "funnel_sql_per_level": lambda spark, sf: comparable(
            funnel_sql_per_level(spark, sf).daily(LEVELS, ALL_TIME)
        ),
        "funnel_metrics": funnel_metrics,
        "funnel_three_levels": funnel_three_levels,
        "funnel_many_channels": funnel_many_channels,
        "delta_wow": _delta("wow"),
        "delta_yoy": _delta("yoy"),
        "detail": _detail("pivot"),
        "detail_window": _detail("window"),
        "detail_self_join": _detail("join"),
        "detail_fallback": _per_date(FALLBACK_DATES, lambda r: r.detail),
        "detail_from_store": detail_from_store,
        "detail_from_files": lambda spark, sf: comparable(from_files(spark, sf).detail),
        "validation_from_files": lambda spark, sf: comparable(from_files(spark, sf).validations),
        "pull_sizes": pull_sizes,
        "summary": _of_run(lambda r: r.summary),
        "breakdown": _of_run(lambda r: r.breakdown),
        "raw_channel_pull": _of_run(lambda r: ordered_daily(r.raw["channel"])),
        "latest_date": lambda spark, sf: latest_sot_date(source_of_truth(spark, sf)),
        "date_check": date_check,
        "sot_validation": _per_date(VALIDATION_DATES, lambda r: r.validations, validate=True),
        "failed_validations": _per_date(
            VALIDATION_DATES, lambda r: failed_validations(r.validations), validate=True
        ),
        "validation_verdict": _per_date(VALIDATION_DATES, lambda r: r.verdicts, validate=True),
        "anomalies": _of_run(lambda r: r.anomalies),
        "anomaly_counts": _per_date(ANOMALY_DATES, lambda r: r.anomaly_counts),
        "small_denominators": _of_run(lambda r: small_denominators(r.detail, r.config)),
        "scorecard": _of_run(lambda r: scorecard(r.summary, r.config).drop("style")),
        "channel_table": _of_run(lambda r: channel_table(r.breakdown, r.config)),
        "growth_decomposition": _of_run(lambda r: r.growth),
        "channel_contribution": _of_run(lambda r: r.contributions),
        "multi_monitor": lambda spark, sf: comparable(stack_details(run_both(spark, sf))),
        "token_cost": token_cost,
        "channel_lookup": channel_lookup,
        "anomaly_section": _of_run(anomaly_items),
        "archive_numbers": archive_numbers,
        "archive_rewritten": archive_rewritten,
        "report_text": _of_both(report_texts),
        "prompt_text": _of_both(prompt_texts),
        "findings_json": _of_both(findings_json),
        "archive_row": lambda spark, sf: comparable(archive(spark, sf)),
        "report_json": lambda spark, sf: exit_payload(archive(spark, sf)),
    }
