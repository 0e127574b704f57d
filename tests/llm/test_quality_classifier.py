from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidewatch.llm.quality_classifier import classify, is_held_out, learn
from tidewatch.llm.queries import QUERIES


def rank_quality(scores, labels):
    """Share of pairs of a good and a bad document that are in order."""
    good = [s for s, label in zip(scores, labels, strict=True) if label]
    bad = [s for s, label in zip(scores, labels, strict=True) if not label]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


def test_held_out_documents_are_told_apart_and_good_ones_kept(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES["op6_quality_classifier"](spark, sf_dir)
    rows = found.collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [(r["score"], labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert rank_quality(*zip(*((s, q) for s, q, _ in held), strict=True)) > 0.97
    good = [p for _, q, p in held if q]
    assert sum(good) >= 0.95 * len(good)


def test_held_out_labels_are_not_learnt(spark, odd_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(13)], "doc_id long, quality int")
    turned = labels.withColumn(
        "quality", F.when(is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    one, other = (learn(odd_docs, frame, "doc_id", "text", "quality") for frame in (labels, turned))
    assert (one.vectors == other.vectors).all() and (one.labels == other.labels).all()


def test_odd_documents_and_labels(spark, odd_docs, no_docs):
    rows = [(0, 1), (1, 1), (7, 0), (7, 0), (None, 1), (8, None), (9, 1), (9, 0), (99, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    found = classify(odd_docs, labels)
    assert sorted(found.columns) == sorted(odd_docs.columns)  # a clashing column is replaced
    scores = [r["quality_score"] for r in found.collect()]
    assert len(scores) == odd_docs.count() and all(0 <= s <= 1 for s in scores)
    none = classify(odd_docs, labels.limit(0)).collect()
    assert {r["quality_score"] for r in none} == {0.5}
    assert classify(no_docs, labels).count() == 0


@pytest.mark.parametrize("letters", [("abcdefghijkl", "mnopqrstuvwx"), ("абвгдежзиклм", "αβγδεζηθικλμ")])
def test_a_label_that_depends_on_vocabulary_alone(spark, letters):
    """Words of the same lengths and shapes; only which words there are tells good from bad."""
    generator = random.Random(5)
    words = [["".join(generator.choices(own, k=6)) for _ in range(300)] for own in letters]
    rows = [(i, " ".join(generator.choices(words[i % 2], k=60)), i % 2) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    found = classify(frame.select("doc_id", "text"), frame.select("doc_id", "quality"))
    held = found.where(is_held_out(F.col("doc_id"))).collect()
    assert len(held) > 50
    assert all((r["quality_score"] >= 0.7) == bool(r["doc_id"] % 2) for r in held)
