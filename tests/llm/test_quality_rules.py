from __future__ import annotations

import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.llm.quality_rules import beta_prior, quality_rules, text_metrics


def plain_metrics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {
        i + step for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for step in range(5)
    }
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    again = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab #|\n\t\x0b\xa0\x85é", max_size=80))
def test_metrics_as_by_hand(text):
    assert text_metrics(text) == plain_metrics(text)


def test_metrics_with_many_different_words():
    generator = random.Random(3)
    words = [f"w{generator.randrange(9000)}" for _ in range(20_000)]
    text = " ".join(words + words[5:40])
    assert text_metrics(text) == plain_metrics(text)


def test_odd_documents_keep_their_columns_and_get_a_verdict(odd_docs, no_docs):
    judged = quality_rules(odd_docs)
    others = [name for name in odd_docs.columns if name != "quality_metrics"]
    assert sorted(judged.columns) == sorted([*others, "quality_metrics"])
    named = quality_rules(odd_docs, metrics="other name")
    assert named.columns == [*odd_docs.columns, "other name"]
    assert {row["verdict_host"] for row in judged.collect()} == {"x"}
    rows = judged.collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        found = row["quality_metrics"]
        assert tuple(found)[:5] == plain_metrics(row["text"])
        repeats = found["n_repeat_words"]
        assert found["base_failed"] == (found["n_words"] < 10 or 100 * repeats > 20 * found["n_words"])
        assert not (found["kept"] and found["base_failed"])
    assert quality_rules(no_docs).count() == 0


def test_a_bad_host_goes_with_its_documents_and_few_documents_are_not_enough(spark):
    good, bad = " ".join(f"word{i}" for i in range(20)), "short"
    rows = [(i, good, "fine") for i in range(200)] + [(300 + i, bad, "fine") for i in range(10)]
    rows += [(400 + i, bad, "junk") for i in range(190)] + [(600 + i, good, "junk") for i in range(10)]
    rows += [(700, bad, "new"), (701, good, "new")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["quality_metrics"]["kept"] for r in quality_rules(docs).collect()}
    assert all(kept[i] for i in range(200))
    assert not any(kept[600 + i] for i in range(10))
    assert kept[701] and not kept[700]


def test_prior_of_equal_hosts_is_strong_and_of_unequal_ones_weak(spark):
    schema = "verdict_host string, n long, failed long"
    equal = spark.createDataFrame([(f"h{i}", 100, 10) for i in range(9)], schema)
    unequal = spark.createDataFrame([(f"h{i}", 100, 100 * (i % 2)) for i in range(9)], schema)
    assert sum(beta_prior(equal)) > 1000 > 5 > sum(beta_prior(unequal))
    alpha, beta = beta_prior(equal)
    assert abs(alpha / (alpha + beta) - 0.1) < 1e-9
    assert beta_prior(equal.where(F.lit(False))) == (1.0, 1.0)
