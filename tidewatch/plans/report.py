"""Reports on a monitor run.

A report is first a frame of lines, ``section, position, key, text``. Turning lines into one
document is the last step, and the only one where the text of a monitor comes together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import MonitorConfig
from tidewatch.functions.text import (
    STYLES,
    four_places,
    grouped,
    literal,
    money,
    percent,
    quoted,
    record_json,
    signed_percent,
    whole,
)
from tidewatch.operators.anomalies import HIGH, anomaly_counts
from tidewatch.operators.growth import growth_decomposition
from tidewatch.operators.validation import VALIDATION_TOLERANCE, validation_verdict
from tidewatch.plans.engine import MonitorResult

HYPOTHESES = "array<struct<claim:string,evidence:array<string>,confidence:string,next_step:string>>"
NO_ANOMALIES = "No anomalies flagged."
SEPARATOR = "\n\n---\n\n"

DRIVER = (
    "CASE driver WHEN 'top_of_funnel' THEN 'top-of-funnel' WHEN 'conversion' THEN 'demand'"
    " ELSE driver END"
)
ANOMALY = (
    "concat('[', upper(severity), '] ', metric_label, ' in ', dimension, ': ', "
    f"{signed_percent('pct_change')}, ' ', comparison)"
)


def _in_order(struct: str, field: str) -> str:
    """SQL for ``field`` of every row, as an array ordered by the struct."""
    return f"transform(array_sort(collect_list(struct({struct}))), x -> x.{field})"


# --- tables -------------------------------------------------------------------------------


def scorecard(summary: DataFrame, config: MonitorConfig) -> DataFrame:
    """``position, metric, label, style, value, yoy, wow`` in the configured order."""
    have = set(summary.columns)

    def number(column: str, name: str) -> str:
        return f"CAST({quoted(column) if column in have else 'NULL'} AS DOUBLE) AS {name}"

    rows = [
        f"struct({i} AS position, {literal(line.column)} AS metric, {literal(line.label)} AS label,"
        f" {literal(line.style)} AS style, {number(line.column, 'value')},"
        f" {number(line.column + '_yoy', 'yoy')}, {number(line.column + '_wow', 'wow')})"
        for i, line in enumerate(config.scorecard, 1)
        if line.column in have
    ]
    return summary.selectExpr(f"inline(array({', '.join(rows)}))")


def channel_table(breakdown: DataFrame, config: MonitorConfig) -> DataFrame:
    """Revenue, orders and revenue per order of every dimension value, each with YoY (R2)."""
    growth = config.growth
    per_order = next(
        m.key
        for m in config.metrics
        if (m.numerator, m.denominator) == (growth.revenue, growth.orders)
    )
    columns = [
        x for name in (growth.revenue, growth.orders, per_order) for x in (name, f"{name}_yoy")
    ]
    small = f"{quoted(growth.orders)} < {config.rules.min_denominator} AS small_denominator"
    return breakdown.selectExpr("dimension", *map(quoted, columns), small)


def headline(result: MonitorResult) -> DataFrame:
    """One row with the headline: revenue growth and what each driver did to it."""
    growth = result.config.growth
    if growth is None:
        text = f"concat({literal(result.name)}, ': ', anomaly_count, ' anomalies flagged')"
        return anomaly_counts(result.anomalies).selectExpr(f"{text} AS headline")
    totals = result.summary.selectExpr(
        f"{quoted(growth.revenue)} AS revenue", f"{quoted(growth.revenue + '_yoy')} AS yoy"
    ).agg(F.max("revenue").alias("revenue"), F.max("yoy").alias("yoy"))
    part = f"concat({DRIVER}, ' ', {signed_percent('factor_yoy')}) AS text"
    # Three rows at most, one per driver.
    drivers = growth_decomposition(result.summary, growth).agg(
        F.expr(f"array_join({_in_order(f'position, {part}', 'text')}, ', ') AS parts"),
        F.expr(f"max_by({DRIVER}, contribution * signum(revenue_yoy)) AS main"),
    )
    text = (
        "concat('Revenue ', CASE WHEN yoy >= 0 THEN 'grew' ELSE 'fell' END, ' ',"
        f" {signed_percent('yoy')}, ' YoY to ', {money('revenue')}, ', driven by ',"
        " coalesce(main, 'no single driver'), ': ', parts)"
    )
    known = totals.select(
        "*",
        drivers.select("main").scalar().alias("main"),
        drivers.select("parts").scalar().alias("parts"),
    )
    return known.selectExpr(
        "CASE WHEN revenue IS NULL THEN 'No data for this day'"
        f" WHEN yoy IS NULL THEN concat('Revenue is ', {money('revenue')}, ', without a prior year')"
        f" ELSE {text} END AS headline"
    )


def anomaly_section(anomalies: DataFrame) -> DataFrame:
    """``anomaly_count`` and the list of flagged items in rank order, in one row."""
    return anomalies.agg(
        F.count("*").alias("anomaly_count"),
        F.expr(f"{_in_order(f'rank, {ANOMALY} AS text', 'text')} AS items"),
    )


# --- findings -----------------------------------------------------------------------------


def findings(result: MonitorResult) -> DataFrame:
    """Anomalies as findings, ``rank`` first; hypotheses are left empty."""
    return result.anomalies.selectExpr(
        "rank",
        "severity",
        f"array({literal(result.domain)}) AS domains",
        f"{ANOMALY} AS summary",
        f"concat('current ', {four_places('current_value')}, ', prior ', {four_places('prior_value')},"
        f" ', threshold ', {percent('threshold', 0)}) AS details",
        f"CAST(array() AS {HYPOTHESES}) AS hypotheses",
        f"CASE severity WHEN '{HIGH}' THEN 'investigate' ELSE 'monitor' END AS action",
    )


def settled(results: Sequence[MonitorResult]) -> list[MonitorResult]:
    """Results to read many times: what sections share is computed once."""
    return [result.settled for result in results]


def findings_json(results: Sequence[MonitorResult]) -> DataFrame:
    """All findings of a run as one JSON array, most severe first: ``findings_json``."""
    results = settled(results)
    stacked = reduce(
        DataFrame.unionByName,
        [findings(r).selectExpr(f"{i} AS monitor", "*") for i, r in enumerate(results)],
    )
    entry = (
        f"CASE severity WHEN '{HIGH}' THEN 0 ELSE 1 END AS severity_order, monitor, rank,"
        " to_json(struct(severity, domains, summary, details, hypotheses, action)) AS text"
    )
    joined = f"concat('[', array_join({_in_order(entry, 'text')}, ', '), ']')"
    return stacked.agg(F.expr(f"{joined} AS findings_json"))


# --- lines --------------------------------------------------------------------------------


def _line(df: DataFrame, section: int, text: str, position: str = "0", key: str = "''") -> DataFrame:
    return df.selectExpr(
        f"{section} AS section",
        f"CAST({position} AS BIGINT) AS position",
        f"{key} AS key",
        f"{text} AS text",
    )


def _fixed(result: MonitorResult, lines: Sequence[tuple[int, str]]) -> DataFrame:
    """Lines that do not depend on data; negative positions put them first in their section."""
    rows = ", ".join(
        f"({section}, {i - len(lines)}L, '', {literal(text)})"
        for i, (section, text) in enumerate(lines)
    )
    spark = result.comparison.sparkSession
    return spark.sql(f"SELECT * FROM VALUES {rows} AS fixed(section, position, key, text)")


def _row(*cells: str) -> str:
    return f"concat('| ', concat_ws(' | ', {', '.join(cells)}), ' |')"


def report_lines(result: MonitorResult) -> DataFrame:
    """The lines of the daily report in their fixed order."""
    config, growth = result.config, result.config.growth
    # Section headings and table heads of the report.
    fixed = [
        (1, f"*{config.title or config.name} — {result.report_date:%Y-%m-%d}*"),
        (2, "\n*Headline:*"),
        (3, "\n*Scorecard:*"),
        (3, "| Metric | Value | YoY | WoW |"),
        (3, "|--------|-------|-----|-----|"),
        (6, "\n*Anomaly Flags:*"),
        (7, "\n*Data Validation:*"),
    ]
    if growth is not None:
        fixed += [
            (4, "\n*Channel Breakdown:*"),
            (4, "| Channel | Revenue | YoY | Projects | YoY | RPP | YoY |"),
            (4, "|---------|---------|-----|----------|-----|-----|-----|"),
            (5, "\n*YoY Growth Drivers:*"),
        ]
    parts = [
        _fixed(result, fixed),
        _line(headline(result), 2, "concat('• ', headline)"),
        _line(
            anomaly_counts(result.anomalies), 6, "concat('• ', anomaly_count, ' YoY anomalies flagged')"
        ),
        _line(result.anomalies, 6, f"concat('• ', {ANOMALY})", "rank"),
    ]
    if config.scorecard:
        styled = " ".join(f"WHEN '{name}' THEN {show('value')}" for name, show in STYLES.items())
        row = _row("label", f"CASE style {styled} END", signed_percent("yoy"), signed_percent("wow"))
        parts.append(_line(scorecard(result.summary, config), 3, row, "position"))
    if growth is not None:
        parts += _growth_lines(result)
    if result.validations is not None:
        verdict = "CASE WHEN passed THEN 'PASS' WHEN NOT passed THEN 'FAIL' ELSE 'NOT CHECKED' END"
        text = f"concat('• Metrics cross-checked against SOT: ', {verdict})"
        parts.append(_line(validation_verdict(result.validations), 7, text))
    return reduce(DataFrame.unionByName, parts)


def _growth_lines(result: MonitorResult) -> list[DataFrame]:
    table = channel_table(result.breakdown, result.config)
    revenue, revenue_yoy, orders, orders_yoy, per_order, per_order_yoy = table.columns[1:7]
    note = "CASE WHEN small_denominator THEN ' (small)' ELSE '' END"
    row = _row(
        "dimension",
        money(revenue),
        signed_percent(revenue_yoy),
        f"concat({whole(orders)}, {note})",
        signed_percent(orders_yoy),
        money(per_order),
        signed_percent(per_order_yoy),
    )
    part = f"' contributing ', {signed_percent('contribution')}, ' of revenue growth'"
    driver = f"concat('• *', initcap({DRIVER}), ':* ', {signed_percent('factor_yoy')}, ' YoY,', {part})"
    channel = f"concat('• *Channel ', dimension, ':*', {part})"
    return [
        _line(table, 4, row, key="dimension"),
        _line(result.growth, 5, driver, "position"),
        _line(result.contributions, 5, channel, "100", "dimension"),
    ]


def prompt_lines(result: MonitorResult) -> DataFrame:
    """The structured text block of one monitor: context, tables, anomalies, checks."""
    fixed = [
        (1, f"## Monitor: {result.name}"),
        (1, f"Report date: {result.report_date:%Y-%m-%d}"),
        (1, f"Context: {result.context}"),
    ]
    record = record_json(result.detail)
    levels = ", ".join(literal(level) for level in result.config.dimensions)
    level_order = f"array_position(array({levels}), dim_type)"

    def records(df: DataFrame, section: int, title: str) -> list[DataFrame]:
        # An empty frame has no heading.
        heading = df.agg(F.count("*").alias("n")).filter("n > 0")
        return [
            _line(heading, section, literal(f"\n### {title}")),
            _line(df, section, record, level_order, "dimension"),
        ]

    item = (
        f"concat('  - ', {ANOMALY}, ' (current: ', {four_places('current_value')}, ', prior: ',"
        f" {four_places('prior_value')}, ', threshold: ', {percent('threshold', 0)}, ')')"
    )
    heading = (
        f"concat({literal(chr(10) + '### Pre-Flagged Anomalies (')}, anomaly_count, ' total)',"
        f" CASE WHEN anomaly_count = 0 THEN {literal(chr(10) + '  ' + NO_ANOMALIES)} ELSE '' END)"
    )
    parts = [
        _fixed(result, fixed),
        *records(result.summary, 2, "Overall Summary"),
        *records(result.breakdown, 3, "Breakdown by Dimension"),
        _line(anomaly_counts(result.anomalies), 4, heading),
        _line(result.anomalies, 4, item, "rank"),
    ]
    if result.validations is not None:
        parts += _validation_lines(result.validations)
    return reduce(DataFrame.unionByName, parts)


def _validation_lines(validations: DataFrame) -> list[DataFrame]:
    verdict = validation_verdict(validations).filter("validated > 0")
    title = literal("\n### SOT Cross-Validation")
    tolerance = f" metrics passed (within {VALIDATION_TOLERANCE * 100:.1f}% tolerance)"
    all_passed = f"concat({literal(chr(10) + '  All ')}, validated, {literal(tolerance)})"
    heading = f"concat({title}, CASE WHEN passed THEN {all_passed} ELSE '' END)"
    check = (
        f"concat('  - ', metric, ': ours=', {grouped('our_value')}, ', SOT=', {grouped('sot_value')},"
        f" ', diff=', {percent('pct_diff', 2)}, CASE WHEN passed THEN ' [PASS]' ELSE ' [FAIL]' END)"
    )
    # Single checks are listed only when one of them failed.
    listed = validations.filter(~verdict.select("passed").scalar())
    return [_line(verdict, 5, heading), _line(listed, 5, check, "1", "metric")]


# --- documents ----------------------------------------------------------------------------


def as_document(lines: DataFrame, name: str) -> DataFrame:
    """Lines in order, joined into one text."""
    ordered = _in_order("section, position, key, text", "text")
    return lines.agg(F.expr(f"array_join({ordered}, '\\n') AS {name}"))


def _per_monitor(results: Sequence[MonitorResult], build, name: str) -> DataFrame:
    results = settled(results)
    documents = [
        as_document(build(r), name).selectExpr(
            f"{i} AS monitor",
            f"{literal(r.domain)} AS domain",
            f"DATE '{r.report_date}' AS report_date",
            name,
        )
        for i, r in enumerate(results)
    ]
    return reduce(DataFrame.unionByName, documents)


def report_texts(results: Sequence[MonitorResult]) -> DataFrame:
    """``monitor, domain, report_date, report``, one row per monitor."""
    return _per_monitor(results, report_lines, "report")


def prompt_texts(results: Sequence[MonitorResult]) -> DataFrame:
    """``monitor, domain, report_date, prompt``, one row per monitor."""
    return _per_monitor(results, prompt_lines, "prompt")


def _joined(name: str) -> Column:
    return F.expr(f"array_join({_in_order(f'monitor, {name}', name)}, {literal(SEPARATOR)})")


def archive_row(
    results: Sequence[MonitorResult],
    requested: Sequence[str],
    costs: DataFrame | None = None,
    written: Column | None = None,
) -> DataFrame:
    """The archive row of a run.

    ``requested`` lists the asked keys, also those skipped (T20). The date and headline are
    those of the first monitor. ``costs`` is the output of ``run_costs``, if there was any;
    ``written`` is the time of writing, now if not given.
    """
    if not results:
        raise ValueError("no monitor ran, there is nothing to archive")
    results = settled(results)
    counts = reduce(
        DataFrame.unionByName, [anomaly_counts(r.anomalies) for r in results]
    ).agg(F.sum("anomaly_count"))
    cost = F.lit(0.0) if costs is None else costs.agg(F.sum("total_cost")).scalar()
    reports = report_texts(results).agg(_joined("report").alias("markdown_report"))
    return reports.select(
        F.lit(results[0].report_date).alias("report_date"),
        (F.current_timestamp() if written is None else written).alias("created_timestamp"),
        headline(results[0]).scalar().alias("headline"),
        "markdown_report",
        findings_json(results).scalar().alias("findings_json"),
        counts.scalar().alias("anomaly_count"),
        F.lit(",".join(requested)).alias("monitors_run"),
        F.coalesce(cost.cast("double"), F.lit(0.0)).alias("token_cost_usd"),
    )
