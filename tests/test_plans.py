"""The physical plans are the intended ones."""

import contextlib
import datetime as dt
import re

import pytest
from compare import plan_of
from conftest import SF_DIR
from pyspark.sql import functions as F
from pyspark.sql import types as T

from __spark_entry__ import queries
from fixtures.funnel import (
    PRIORITY_CHANNELS,
    buyer_source,
    funnel_roles,
    funnel_source,
    funnel_sql_source,
)
from fixtures.queries import ALL_TIME, LEVELS, archive, run, run_both
from tidewatch.functions import DateWindow
from tidewatch.operators.prefilter import key_filter, might_match
from tidewatch.operators.ranking import add_global_rank
from tidewatch.operators.stages import PARTITION_BYTES, Lookup
from tidewatch.plans.funnel import FunnelSource


@contextlib.contextmanager
def conf(spark, **settings):
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


NO_AQE = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def test_raw_bounds_reach_the_scan(spark):
    window = DateWindow(dt.date(2000, 6, 1), dt.date(2000, 6, 15))
    plan = plan_of(funnel_source(spark, SF_DIR).measure("contacts", "channel", window))
    assert "GreaterThanOrEqual(l_shipdate,2000-06-01T07:00)" in plan
    assert "LessThan(l_shipdate,2000-06-16T07:00)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_shipdate:timestamp_ntz>" in plan


def test_a_run_scans_only_the_compared_days(spark):
    plan = plan_of(run(spark, SF_DIR).detail)
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "l_shipdate" in line]
    assert pushed
    for day in ("1999-06-17", "2000-06-08", "2000-06-15"):
        assert all(f"GreaterThanOrEqual(l_shipdate,{day}T07:00)" in line for line in pushed)


def test_levels_use_no_outer_join_and_no_expand(spark):
    plan = plan_of(funnel_source(spark, SF_DIR).daily(LEVELS, ALL_TIME))
    assert "FullOuter" not in plan and "Expand" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    outer = plan_of(funnel_source(spark, SF_DIR).daily_by_outer_join("channel", ALL_TIME))
    assert "FullOuter" in outer


def test_lookup_is_shuffled_once_for_all_stages(spark):
    with conf(spark, **NO_AQE):
        plan = plan_of(funnel_source(spark, SF_DIR).daily(LEVELS, ALL_TIME))
    # Three joins need the lookup; two of them reuse the exchange of the first.
    assert len(re.findall(r"SortMergeJoin LeftOuter \(\d+\)", plan)) == 3
    assert len(re.findall(r"ReusedExchange \(\d+\)", plan)) >= 2


def test_distinct_keys_need_no_shuffle_after_the_join(spark):
    with conf(spark, **NO_AQE):
        plan = plan_of(funnel_source(spark, SF_DIR).measure("projects", "channel", ALL_TIME))
    tree = plan.split("(1) Scan")[0]
    # Two for the lookup, two for the keys, one for the few rows per day.
    assert len(re.findall(r"- Exchange \(\d+\)", tree)) == 5


def test_unique_lookup_is_shuffled_for_the_join_only(spark):
    lookup = Lookup("requests", "request_pk", "segment", unique=True)
    roles = funnel_roles(spark, SF_DIR)
    source = FunnelSource(roles, lookup=lookup, channels=PRIORITY_CHANNELS)
    with conf(spark, **NO_AQE):
        plan = plan_of(source.measure("revenue", "channel", ALL_TIME))
        overall = plan_of(source.measure("revenue", "overall", ALL_TIME))
    tree = plan.split("(1) Scan")[0]
    assert len(re.findall(r"- Exchange \(\d+\)", tree)) == 3
    assert "Join" not in overall


def test_bucketed_requests_are_not_shuffled(spark):
    roles = funnel_roles(spark, SF_DIR)
    roles["requests"].write.mode("overwrite").bucketBy(4, "request_pk").saveAsTable("bucketed_requests")
    roles["requests"] = spark.table("bucketed_requests")
    source = FunnelSource(roles, channels=PRIORITY_CHANNELS)
    with conf(spark, **NO_AQE):
        plan = plan_of(source.measure("revenue", "channel", ALL_TIME))
    tree = plan.split("(1) Scan")[0]
    # One for the facts and one for the few rows per day; none for the lookup.
    assert len(re.findall(r"- Exchange \(\d+\)", tree)) == 2


def test_hot_keys_are_split_by_the_adaptive_join(spark):
    """Facts meet the lookup in a join whose skewed partitions Spark may split."""
    hot = spark.range(40000).selectExpr(
        "id AS contact_pk", "IF(id % 3 = 0, 1, id) AS request_pk",
        "TIMESTAMP_NTZ '2000-06-15 12:00:00' AS contact_created_time",
    )
    roles = funnel_roles(spark, SF_DIR) | {"contacts": hot}
    source = FunnelSource(roles, channels=PRIORITY_CHANNELS)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16",
    }
    with conf(spark, **settings):
        df = source.measure("contacts", "channel", ALL_TIME)
        assert sum(r.contacts for r in df.collect()) == 40000
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_ranking_computes_the_funnel_once(spark):
    df = run(spark, SF_DIR.replace("0.001", "0.01")).anomalies
    assert df.collect()
    # Six stages and the lookup are scanned once each, and the keys of four stages for the prefilter.
    # The sample of the ranks reuses their shuffles; only visits, which have none, are read again.
    scans = [node.toString() for kind, node in executed(df) if kind == "FileSourceScanExec"]
    assert len(scans) <= 12 and len([s for s in scans if s.startswith("FileScan parquet [o_orderdate")]) <= 2


def executed(df):
    """Kind and node of the plan of a frame that has run, subqueries included, reused parts left out."""
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind in ("ReusedExchangeExec", "ReusedSubqueryExec"):
            continue
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            yield kind, node
            for inner in (node.children(), node.subqueries()):
                todo += [inner.apply(i) for i in range(inner.size())]


def shuffled_rows(df):
    """Partitioning and rows of every shuffle of a frame that has run."""
    return [
        (node.outputPartitioning().toString(), node.metrics().apply("shuffleRecordsWritten").value())
        for kind, node in executed(df)
        if kind == "ShuffleExchangeExec"
    ]


def test_a_report_reads_its_events_once(spark):
    row = archive(spark, SF_DIR)
    plan = row._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") <= 20
    results = run_both(spark, SF_DIR)
    assert results[0].settled is results[0].settled is results[0].settled.settled
    assert sorted(results[0].settled.detail.collect()) == sorted(results[0].detail.collect())


def test_a_backfill_scans_each_role_once(spark):
    df = queries()["sot_validation"](spark, SF_DIR)
    df.collect()
    scans = [node for kind, node in executed(df) if kind == "FileSourceScanExec"]
    # Six stages, the lookup and the keys of four stages, and five parts of the source of truth.
    assert len(scans) <= 16


def test_a_grouped_sql_source_scans_each_role_once(spark):
    df = funnel_sql_source(spark, SF_DIR).daily(LEVELS, DateWindow(dt.date(2000, 6, 1), dt.date(2000, 6, 15)))
    df.collect()
    scans = [node.toString() for kind, node in executed(df) if kind == "FileSourceScanExec"]
    # Visits, requests, projects, contacts, two revenues, and the lookup that three of them share.
    assert len(scans) == 7
    contacts = [scan for scan in scans if "[IsNotNull(l_shipdate), Gr" in scan]
    assert len(contacts) == 1 and "GreaterThanOrEqual(l_shipdate,2000-06-01T07:00)" in contacts[0]


def test_equal_changes_are_ranked_in_many_tasks(spark):
    """18,000 of 20,000 changes are equal; the rest of the order tells them apart."""
    rows = spark.range(20_000).selectExpr(
        "concat('d', lpad(id * 7919 % 20000, 5, '0')) AS dimension", "IF(id < 18000, 1D, 0.5D + id) AS size"
    )
    with conf(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}):
        ranked = add_global_rank(rows, [-F.col("size"), F.col("dimension")], ranges=64)
        found = {row["rank"]: (-row["size"], row["dimension"]) for row in ranked.collect()}
        sorts = [node for kind, node in executed(ranked) if kind == "WindowExec" and "row_number" in node.toString()]
        ranges = ranked.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    assert len(sorts) == 1 and ranges[0] < 6_000 and ranges[1] >= 8
    assert sorted(found) == list(range(1, 20_001))
    assert [found[i] for i in range(1, 20_001)] == sorted(found.values())


def test_levels_do_not_multiply_what_a_distinct_count_shuffles(spark):
    sf = SF_DIR.replace("0.001", "0.01")

    def by_entity(levels):
        df = buyer_source(spark, sf).daily(levels, ALL_TIME)
        df.collect()
        entity = [(text, rows) for text, rows in shuffled_rows(df) if "value#" in text]
        return entity, plan_of(df)

    overall, _ = by_entity(["overall"])
    three, plan = by_entity(["overall", "channel", "buyer"])
    largest = max(rows for _, rows in overall)
    assert largest > 10_000
    assert all(rows <= largest for _, rows in three)
    assert not any("dim_type#" in text for text, _ in three)
    # Levels are spread out above the last shuffle by entity, with no shuffle before they are counted.
    numbered = {int(n): (kind, text) for n, kind, text in re.findall(r"^\((\d+)\) (\w+)(.*?)(?=^\(\d+\) |\Z)", plan, re.M | re.S)}
    shuffles = [text for kind, text in numbered.values() if kind == "Exchange" and "REPARTITION_BY_COL" in text]
    assert len(shuffles) >= 2 and all(re.search(r"hashpartitioning\(metric_date#\w+, value#\w+, 4\)", t) for t in shuffles)


def test_a_run_shuffles_few_of_the_lookup_keys(spark):
    sf = SF_DIR.replace("0.001", "0.01")
    days = DateWindow.always().only(dt.date(2000, 6, 15), dt.date(2000, 6, 8), dt.date(1999, 6, 17))
    df = funnel_source(spark, sf).daily(LEVELS, days)
    wanted = sorted(df.collect())
    lookup = [rows for text, rows in shuffled_rows(df) if "lookup_key#" in text]
    keys = funnel_roles(spark, sf)["contacts"].filter(days.covers("contact_created_time", T.TimestampNTZType()))
    matched = keys.select("request_pk").distinct().count()
    assert 0 < max(lookup) <= 2 * matched < funnel_roles(spark, sf)["requests"].count() / 20
    everything = funnel_source(spark, sf).daily(LEVELS, ALL_TIME)
    assert wanted == sorted(everything.filter(F.col("metric_date").isin(list(days.days))).collect())


@pytest.mark.parametrize("bits", [64 * 1024, 1 << 20])
def test_the_key_filter_loses_no_wanted_key(spark, bits):
    keys = spark.range(0, 30_000, 3).selectExpr("CASE WHEN id % 9 = 0 THEN NULL ELSE concat('k', id) END AS k", "id")
    rows = spark.range(0, 60_000).selectExpr("concat('k', id % 30000) AS k", "id AS _block")
    wanted = key_filter(keys, "k", bits)
    assert wanted.count() <= bits // 64 // 1024 + 1
    kept = might_match(rows, "k", wanted, bits)
    assert kept.columns == rows.columns
    assert kept.join(keys, "k", "left_semi").count() == rows.join(keys, "k", "left_semi").count()
    assert kept.count() < rows.count() and might_match(rows, "k", key_filter(keys.limit(0), "k")).isEmpty()


@pytest.mark.parametrize("levels", [["overall"], ["channel"], ["overall", "channel"], ["overall", "channel", "buyer"]])
def test_no_task_hashes_entities_spread_into_levels(spark, levels):
    """Two hash tables of all of a task's rows, once per level, were most of its memory."""
    with conf(spark, **NO_AQE):
        plan = plan_of(buyer_source(spark, SF_DIR).daily(levels, ALL_TIME))
    keys = re.findall(r"Keys \[\d+\]: \[(.*?)\]\n", plan)
    assert len(keys) > 5
    assert not [k for k in keys if "value#" in k and "dim_type#" in k]
    if levels == ["overall"]:
        # Keys are distinct by day once, and that is all that is counted.
        assert sum("lookup_key#" in k and "metric_date#" in k for k in keys) == 2
    else:
        sorts = [s for s in re.findall(r"Arguments: \[(.*? ASC NULLS FIRST)\], false", plan) if "level channel" in s or "level buyer" in s]
        # Requests, contacts and the keys of the lookup, each once for two levels and once more for a third.
        assert len(sorts) == 3 * (len(levels) - 1)


def test_no_task_is_given_more_than_a_small_partition(spark):
    """Partitions merged up to Spark's advisory size made one task sort and hash millions of rows."""
    rows = spark.range(1_500_000).selectExpr(
        "xxhash64(id) AS contact_pk", "xxhash64(-id) AS request_pk",
        "TIMESTAMP_NTZ '2000-06-15 12:00:00' AS contact_created_time",
    )
    source = FunnelSource(funnel_roles(spark, SF_DIR) | {"contacts": rows}, channels=PRIORITY_CHANNELS)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    with conf(spark, **settings):
        df = source.measure("contacts", "channel", ALL_TIME)
        assert sum(r.contacts for r in df.collect()) == 1_500_000
        reads = [node for kind, node in executed(df) if kind == "AQEShuffleReadExec"]
        sizes = [node.metrics().apply("partitionDataSize").value() / node.partitionSpecs().size() for node in reads]
    assert max(sizes) > 1 << 20
    assert max(sizes) <= PARTITION_BYTES


@pytest.mark.parametrize(
    "asked, kept", [("64MB", "16777216"), ("1g", "16777216"), ("8m", "8m"), ("10KB", "10KB"), ("16777216", "16777216")]
)
def test_a_session_may_ask_for_smaller_partitions_yet(spark, asked, kept):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    with conf(spark, **{name: asked}):
        funnel_source(spark, SF_DIR).measure("requests", "channel", ALL_TIME)
        assert spark.conf.get(name) == kept


@pytest.mark.parametrize("asked, kept", [("128MB", "33554432"), ("1g", "33554432"), ("4m", "4m")])
def test_a_scan_task_drops_repeats_of_a_small_split(spark, asked, kept):
    """Splits grow with the table up to 128 MB, millions of rows for the hash table of one task."""
    name = "spark.sql.files.maxPartitionBytes"
    with conf(spark, **{name: asked}):
        funnel_source(spark, SF_DIR).measure("projects", "channel", ALL_TIME)
        assert spark.conf.get(name) == kept
