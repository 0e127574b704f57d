"""Daily store, backfill, keyed archive, monitors from files, observed pulls."""

import datetime as dt
import json

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from fixtures.funnel import FUNNEL_MONITOR, REPORT_DATE, funnel_binding, funnel_roles
from fixtures.queries import LEVELS, run
from tidewatch import Binding, FunnelSource, MonitorEngine, MonitorRegistry
from tidewatch.config import ConfigError
from tidewatch.functions import DateWindow
from tidewatch.functions.text import record_json
from tidewatch.operators.validation import repeated_dates
from tidewatch.plans.backfill import backfill
from tidewatch.sources import (
    DailyStore,
    GroupedSqlSource,
    load_monitor,
    read_archive,
    replace_in_archive,
    shared,
)

DAY = dt.date(2024, 6, 15)


def days_before(*numbers):
    return [REPORT_DATE - dt.timedelta(days=n) for n in numbers]


class CountingSource:
    """A funnel that notes which days it is asked to compute."""

    def __init__(self, source):
        self.source, self.asked = source, []

    def daily(self, levels, window):
        self.asked.append(window.days)
        return self.source.daily(levels, window)

    def __getattr__(self, name):
        return getattr(self.source, name)


def engine_over(source, sot=None):
    return MonitorEngine(MonitorRegistry(FUNNEL_MONITOR), {FUNNEL_MONITOR.key: Binding(source, sot)})


def test_the_next_days_run_computes_one_day(spark, tmp_path):
    source = CountingSource(funnel_binding(spark, SF_DIR, validate=False).source)
    store = DailyStore(source, str(tmp_path / "store"), LEVELS)
    computed = store.refresh(days_before(0, 1, 6, 7, 8, 363, 364, 365))
    assert len(computed) == 8 and store.refresh(days_before(0, 1, 365)) == []
    source.asked.clear()
    later = REPORT_DATE + dt.timedelta(days=1)
    result = engine_over(store).run(FUNNEL_MONITOR.key, later)
    want = engine_over(source.source).run(FUNNEL_MONITOR.key, later)
    assert sorted(result.detail.collect()) == sorted(want.detail.collect())
    assert [days for days in source.asked if days and days != (dt.date(2000, 1, 1),)] == [(later,)]
    assert sorted(result.anomalies.collect()) == sorted(want.anomalies.collect())


def test_late_rows_replace_just_their_day(spark, tmp_path):
    roles = funnel_roles(spark, SF_DIR)
    location = str(tmp_path / "store")
    days = days_before(0, 1, 2)
    store = DailyStore(FunnelSource(roles), location, LEVELS)
    store.refresh(days)
    window = DateWindow.always().only(*days)

    def files_by_day(daily):
        found = {}
        for day, file in daily.select("metric_date", F.input_file_name()).collect():
            found.setdefault(day, set()).add(file)
        return found

    files = files_by_day(store.daily(LEVELS, window))
    late = roles["visits"].union(
        spark.createDataFrame([(dt.datetime(2000, 6, 14, 12), "SEM", "b1")], "d timestamp_ntz, s string, b string")
    )
    changed = DailyStore(FunnelSource(roles | {"visits": late}), location, LEVELS)
    assert changed.late_days(days) == days_before(1) and changed.refresh(days) == days_before(1)
    after = changed.daily(LEVELS, window)
    now = files_by_day(after)
    assert {day for day in days if now[day] != files[day]} == set(days_before(1))
    want = FunnelSource(roles | {"visits": late}).daily(LEVELS, window)
    assert sorted(after.select(want.columns).collect()) == sorted(want.collect())
    # A day that lost all its rows has none, whatever was kept of it.
    empty = {name: role.limit(0) for name, role in roles.items()}
    gone = DailyStore(FunnelSource(empty), location, LEVELS)
    assert sorted(gone.refresh(days)) == sorted(days)
    assert gone.daily(LEVELS, window).isEmpty() and not gone.has_rows_on(REPORT_DATE)
    with pytest.raises(ValueError, match="unknown dimension level"):
        gone.daily(["buyer"], window)


def test_a_run_that_breaks_off_leaves_days_to_compute(spark, tmp_path, monkeypatch):
    store = DailyStore(funnel_binding(spark, SF_DIR, validate=False).source, str(tmp_path / "s"), LEVELS)
    write = DailyStore._write

    def broken(self, df, name):
        if name == "days":
            raise OSError("lost")
        write(self, df, name)

    monkeypatch.setattr(DailyStore, "_write", broken)
    with pytest.raises(OSError):
        store.refresh(days_before(0))
    monkeypatch.undo()
    assert store.missing_days(days_before(0)) == days_before(0)
    assert store.has_rows_on(REPORT_DATE) and store.missing_days(days_before(0)) == []


def test_backfill_is_one_run_per_date(spark):
    binding = funnel_binding(spark, SF_DIR)
    engine = engine_over(binding.source, binding.sot)
    dates = ["2000-06-15", dt.date(2000, 6, 16), "2000-06-15", "2001-11-10", "2030-01-01"]
    found = backfill(engine, FUNNEL_MONITOR.key, dates)
    assert found.report_dates == [dt.date(2000, 6, 15), dt.date(2000, 6, 16), dt.date(2001, 11, 10), dt.date(2030, 1, 1)]
    for day in found.report_dates:
        one, mine = engine.run(FUNNEL_MONITOR.key, day), F.col("report_date") == F.lit(day)
        for name in ("detail", "summary", "breakdown", "anomalies", "validations"):
            want = getattr(one, name)
            got = getattr(found, name).filter(mine).select(want.columns)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), (day, name)
    assert found.anomaly_counts.count() == found.verdicts.count() == 4
    last = F.col("report_date") == F.lit(dt.date(2030, 1, 1))
    assert found.anomaly_counts.filter(last).first()[1:] == (0, 0, 0)
    assert found.verdicts.filter(last).first()[1:] == (0, 0, None)
    with pytest.raises(ValueError, match="at least one"):
        backfill(engine, FUNNEL_MONITOR.key, [])


def test_adjacent_days_are_one_range():
    days = [DAY + dt.timedelta(days=n) for n in (0, 1, 2, 9)]
    sql = DateWindow.always().only(*days).covers("d", __import__("pyspark").sql.types.DateType())
    assert sql.count("OR") == 1 and "'2024-06-18'" in sql


@pytest.mark.parametrize("table", [False, True])
def test_a_rerun_replaces_its_archive_row(spark, tmp_path, table):
    location = "archive_by_run" if table else str(tmp_path / "archive")

    def row(day, monitors, headline):
        return spark.sql(
            f"SELECT DATE '{day}' AS report_date, current_timestamp() AS created_timestamp, '{headline}' AS headline,"
            f" 'text' AS markdown_report, '[]' AS findings_json, 1 AS anomaly_count, '{monitors}' AS monitors_run,"
            " 0.5 AS token_cost_usd, 'x' AS extra"
        )

    for day, monitors, headline in (
        ("2024-06-15", "a,b", "first"),
        ("2024-06-15", "a", "other"),
        ("2024-06-15", "a,b", "second"),
        ("2024-06-16", "a,b", "next"),
    ):
        replace_in_archive(row(day, monitors, headline), location)
    found = read_archive(spark, location)
    assert sorted(r.headline for r in found.collect()) == ["next", "other", "second"]
    assert {r.monitors_run for r in found.collect()} == {"a", "a,b"}
    assert found.columns[0] == "report_date" and found.schema["anomaly_count"].dataType.simpleString() == "bigint"


def test_pull_sizes_start_no_job_after_the_pulls_have_run(spark):
    result = run(spark, SF_DIR)
    for pull in result.raw.values():
        shared(pull)
    spark.sparkContext.setJobGroup("sizes", "")
    sizes = result.pull_sizes()
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("sizes")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sizes == {level: pull.count() for level, pull in result.raw.items()}
    assert run(spark, SF_DIR).pull_sizes() == sizes


def test_grouped_source_levels(spark):
    events = spark.createDataFrame(
        [(DAY, "x", "m", 1.0), (DAY, "y", "m", 2.0), (DAY, None, "n", float("nan"))],
        "day date, name string, kind string, amount double",
    )
    text = """SELECT day AS metric_date, name, kind, grouping_id() AS level_id, max(amount) AS most
        FROM {events} WHERE day BETWEEN :start_date AND :end_date
        GROUP BY GROUPING SETS ((day), (day, name), (day, kind))"""
    levels = {"overall": None, "name": "name", "kind": "kind"}
    source = GroupedSqlSource(spark, text, levels, {"events": events.filter("name IS NOT NULL")})
    rows = source.daily(["overall", "kind", "name"], DateWindow(DAY, DAY)).collect()
    assert sorted((r.dim_type, r.dimension, r.most) for r in rows) == [
        ("kind", "m", 2.0), ("name", "x", 1.0), ("name", "y", 2.0), ("overall", "overall", 2.0),
    ]
    assert source.has_rows_on(DAY) and source.latest_day(DateWindow.always()) == DAY
    missing = GroupedSqlSource(spark, text, levels, {"events": events.filter("name IS NULL")})
    assert {r.most for r in missing.daily(["overall"], DateWindow(DAY, DAY)).collect()} == {None}
    with pytest.raises(ValueError, match="unknown dimension level"):
        source.daily(["region"], DateWindow(DAY, DAY))
    with pytest.raises(ValueError, match="does not return"):
        GroupedSqlSource(spark, "SELECT current_date() AS metric_date", levels).daily(["name"], DateWindow(DAY, DAY))


def test_a_monitor_needs_no_python(spark, tmp_path):
    spark.createDataFrame([(DAY, "x", 3), (DAY, "y", 5)], "day date, name string, amount int").write.parquet(
        str(tmp_path / "tables" / "sales")
    )
    (tmp_path / "sales.sql").write_text(
        "SELECT day AS metric_date, name, grouping_id() AS level_id, sum(amount) AS sales FROM {sales}"
        " WHERE day BETWEEN :start_date AND :end_date GROUP BY GROUPING SETS ((day), (day, name))"
    )
    raw = {
        "key": "sales", "name": "Sales", "dimensions": ["overall", "name"], "volume_metrics": ["sales"],
        "source": {"query_file": "sales.sql", "levels": {"overall": None, "name": "name"},
                   "relations": {"sales": "{root}/sales"}},
    }
    file = tmp_path / "sales.json"
    file.write_text(json.dumps(raw))
    config, source, sot = load_monitor(spark, file, {"root": str(tmp_path / "tables")})
    assert sot is None
    engine = MonitorEngine(MonitorRegistry(config), {"sales": Binding(source)})
    detail = engine.run("sales", DAY).detail
    assert {(r.dimension, r.sales) for r in detail.collect()} == {("overall", 8), ("x", 3), ("y", 5)}
    file.write_text(json.dumps(raw | {"dimensions": ["overall", "region"]}))
    with pytest.raises(ConfigError, match="region"):
        load_monitor(spark, file, {"root": str(tmp_path / "tables")})
    file.write_text(json.dumps({"key": "sales"}))
    with pytest.raises(ConfigError, match="source"):
        load_monitor(spark, file)


def test_odd_names_in_records_and_repeated_dates(spark):
    df = spark.sql("SELECT 1.23456D AS `errors-per-view`, CAST(NULL AS STRING) AS `a.b`, 'x' AS `c``d`")
    assert json.loads(df.selectExpr(f"{record_json(df)} AS j").first().j) == {"errors-per-view": 1.2346, "c`d": "x"}
    sot = spark.createDataFrame([(DAY, 1), (DAY, 2), (DAY - dt.timedelta(days=1), 1)], "metric_date date, total int")
    assert [tuple(r) for r in repeated_dates(sot).collect()] == [(DAY, 2)]
