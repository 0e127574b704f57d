from __future__ import annotations

import re
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.llm.fill_in_middle import fill_in_middle, restored, unit_cuts

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def by_iteration(doc_id, text):
    """Form, number of units, prefix, middle and output, one unit after the other."""
    text = text or ""
    units = [match.group() for match in UNIT.finditer(text)]
    digest = sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(part) for part in (units[:low], units[low:high], units[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return "plain", len(units), None, None, text
    if h[3] % 100 < 80:
        return "spm", len(units), len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return "psm", len(units), len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x85\xa0ab\U0001f600", max_size=40), st.integers(0, 99), st.integers(0, 99))
def test_one_match_gives_what_iteration_gives(text, first, second):
    units = [match.group() for match in UNIT.finditer(text)]
    low, high = sorted((first % (len(units) + 1), second % (len(units) + 1)))
    n, prefix_end, middle_end = unit_cuts(text, first, second)
    assert n == len(units) and "".join(units) == text
    assert text[:prefix_end] == "".join(units[:low]) and text[:middle_end] == "".join(units[:high])


def test_a_very_long_text_of_one_kind_is_matched():
    assert unit_cuts(" " * 3_000_000, 0, 1) == (1, 0, 3_000_000)
    assert unit_cuts("x" * 3_000_000, 0, 1) == (1, 0, 3_000_000)
    assert unit_cuts("x " * 1_000_000, 10, 20) == (1_000_001, 19, 39)


def test_odd_documents(odd_docs, no_docs):
    found = fill_in_middle(odd_docs)
    assert found.columns == [*[name for name in odd_docs.columns if name != "fim"], "fim"]
    rows = found.withColumn("again", restored(F.col("fim.output"), F.col("fim.form"))).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        fim = row["fim"]
        got = (fim["form"], fim["n"], fim["prefix_chars"], fim["middle_chars"], fim["output"])
        assert got == by_iteration(row["doc_id"], row["text"])
        assert row["again"] == (row["text"] or "") and row["cut"] == "x"
    assert fill_in_middle(no_docs).count() == 0


@pytest.mark.parametrize("rates", [(100, 0), (100, 100), (0, 50)])
def test_every_form_is_read_back(spark, rates):
    texts = ["a b", "<", "x <P", "<S", " S> <", "S><M", "a <P> b", "<M>", "M> P>", " < < <", "\n", "é \U0001f600 <"]
    docs = spark.createDataFrame([(i, texts[i % len(texts)]) for i in range(400)], "doc_id long, text string")
    found = fill_in_middle(docs, seed=7, fim_rate=rates[0], spm_rate=rates[1])
    again = found.select("text", "fim.form", restored(F.col("fim.output"), F.col("fim.form")).alias("again"))
    rows = again.collect()
    assert all(row["text"] == row["again"] for row in rows)
    marked = {text for text in texts if re.search("<[PSM]>", text)}
    want = "plain" if not rates[0] else "spm" if rates[1] else "psm"
    assert {row["form"] for row in rows if row["text"] not in marked} == {want}
    assert {row["form"] for row in rows if row["text"] in marked} == {"plain"}
