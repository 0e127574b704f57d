from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from compare import differences, duckdb_over
from pyspark.sql import functions as F

from tidewatch.llm import mixing
from tidewatch.llm.mixing import due, mix, mixed
from tidewatch.llm.oracle import ORACLES
from tidewatch.llm.queries import QUERIES


def shared_out(sizes):
    """Targets by repeated sharing: sizes by source, None last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_sources, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_sources:
        unit = left / sum(weight[s] for s in open_sources)
        full = {s for s in open_sources if unit * weight[s] >= 2 * sizes[s]}
        if not full:
            return target | {s: unit * weight[s] for s in open_sources}
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(target[s] for s in full)
        open_sources -= full
    return target


@pytest.mark.parametrize("bucket_rows", [1, 5_000])
def test_targets_and_words_taken(odd_docs, monkeypatch, bucket_rows):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", bucket_rows)
    sizes = Counter()
    for row in odd_docs.collect():
        sizes[row["source"]] += len((row["text"] or "").encode().split())
    want = shared_out(sizes)
    taken, seen = defaultdict(int), defaultdict(set)
    rows = mixing.plan(odd_docs, "doc_id", "text", "source").collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        assert 0 <= row["taken"] <= 2 * row["size"]
        taken[row["source"]] += row["taken"]
        seen[row["source"]].add((row["target"], row["source_size"]))
    for source, total in sizes.items():
        assert len(seen[source]) == 1
        target, size = seen[source].pop()
        assert size == total and target == pytest.approx(want[source])
        assert abs(taken[source] - target) <= 1


def test_reruns_agree_and_nothing_gives_nothing(odd_docs, no_docs):
    order = ["doc_id", "size", "taken", "position"]
    first = sorted(map(str, mix(odd_docs).select(*order).collect()))
    assert first == sorted(map(str, mix(odd_docs.repartition(7)).select(*order).collect()))
    assert mix(no_docs).count() == 0
    assert mixed(no_docs).count() == 0


def test_rows_are_range_sorted_by_position(spark, odd_docs):
    out = mix(odd_docs)
    assert "rangepartitioning(position" in out._jdf.queryExecution().executedPlan().toString()
    found = [row["position"] for row in out.collect()]
    assert None in found and len(set(found)) > 5
    assert found == sorted(found, key=lambda at: (at is None, at or 0.0))
    query = [row["position"] for row in QUERIES["op5_mixing"](spark, "/root/testdata/sf0.001").collect()]
    assert len(set(query)) > 100 and query == sorted(query, key=lambda at: (at is None, at or 0.0))


def test_due_inverts_the_schedule(spark):
    rows = spark.range(101).select((F.col("id") / 100).alias("t"))
    for slope in (0.5, 0.0, -0.5):
        share = F.col("t") + F.lit(slope) * (F.col("t") * F.col("t") - F.col("t"))
        found = rows.select("t", due(share * 1000, F.lit(1000.0), F.lit(slope)).alias("u")).collect()
        assert all(abs(r["t"] - r["u"]) < 1e-9 for r in found)


def test_mixed_documents_are_whole_repeated_and_in_order(odd_docs):
    positions = mixing.plan(odd_docs, "doc_id", "text", "source").where("read or read_again")
    readings = positions.select(F.expr("int(read) + int(read_again)").alias("n")).agg(F.sum("n")).first()[0]
    out = mixed(odd_docs)
    assert out.columns == odd_docs.columns
    rows = out.collect()
    assert len(rows) == readings
    originals = Counter(map(str, odd_docs.collect()))
    assert all(count <= 2 * originals[row] for row, count in Counter(map(str, rows)).items())


def test_plan_has_no_python(spark, odd_docs):
    plan = mix(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    assert differences(QUERIES[name](spark, sf_dir), duckdb_over(sf_dir), ORACLES[name]) == []
