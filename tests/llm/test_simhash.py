from __future__ import annotations

import random

import xxhash
from pyspark.sql import functions as F

from tidewatch.llm.components import connected
from tidewatch.llm.simhash import (
    hex_digits,
    keep_one_of_each,
    links,
    may_have_neighbours,
    near_duplicates,
    simhash,
)


def plain_simhash(text):
    words = [w.lower() if w.isascii() else w for w in (text or "").encode().lower().decode().split()]
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(part.encode(), 42) for part in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups_of(values, distance=3):
    """Smallest member of each value's component, comparing all pairs."""
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    values = sorted(values)
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {v: root(v) for v in values}


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_fingerprint_as_by_hand(odd_rows):
    for row in odd_rows:
        assert simhash(row[1]) % (1 << 64) == plain_simhash(row[1])


def test_a_shingle_hash_is_the_one_spark_computes(spark):
    value = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert simhash("A b C") == value


def test_links_connect_whoever_is_close_and_nobody_else(spark):
    generator = random.Random(5)
    values = {generator.getrandbits(64) for _ in range(60)}
    for centre in list(values)[:25]:
        for count in (1, 2, 3, 3, 3, 4, 5):
            other = centre
            for bit in generator.sample(range(64), count):
                other ^= 1 << bit
            values.add(other)
    frame = spark.createDataFrame([(signed(v),) for v in values], "fingerprint long")
    found = links(may_have_neighbours(frame)).collect()
    assert all(((r["a"] ^ r["b"]) % (1 << 64)).bit_count() <= 3 for r in found)
    want = groups_of(values)
    groups = groups_of_links(values, [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in found])
    assert groups == want


def groups_of_links(values, pairs):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {v: root(v) for v in sorted(values)}


def test_components_of_a_path_a_star_and_a_pair(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(300, 340)] + [(50, 49)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["root"] for r in connected(frame).collect()}
    assert found == groups_of_links({v for edge in edges for v in edge}, edges)
    assert connected(frame.where(F.lit(False))).count() == 0


def test_odd_documents(odd_docs, no_docs):
    found = near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count()
    component = {r["doc_id"]: r["component_id"] for r in found}
    assert component[0] == component[1] == 0
    assert component[3] == component[4] == component[5] == 3  # no words: fingerprint zero
    nulls = [r for r in found if r["doc_id"] is None]
    assert [r["component_id"] for r in nulls] == [0, 0]
    digits = {r[0] for r in near_duplicates(odd_docs).select(hex_digits(F.col("fingerprint"))).collect()}
    assert "0" * 16 in digits and all(len(d) == 16 for d in digits)
    assert near_duplicates(no_docs).count() == 0


def test_one_document_of_each_group_stays_whole(odd_docs, no_docs):
    kept = keep_one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    groups = near_duplicates(odd_docs).select("root").distinct().count()
    rows = kept.collect()
    assert len(rows) == groups
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] in (0, 1, 3, 4, 5)) == [0, 3]
    assert sum(r["doc_id"] == 6 for r in rows) == 2  # two texts under one id
    assert keep_one_of_each(no_docs).count() == 0


def test_null_ids_only(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d")], "doc_id long, text string")
    assert [r["component_id"] for r in near_duplicates(docs).collect()] == [None, None]
    assert keep_one_of_each(docs).count() == 1
