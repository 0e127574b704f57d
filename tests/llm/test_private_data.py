from __future__ import annotations

import hashlib
import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.llm.private_data import (
    base_spans,
    document_frequencies,
    find_private_data,
    sanitised,
)
from tidewatch.llm.queries import QUERIES

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for match in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", match[0])
            good = (
                kind == 0
                or (kind == 1 and all(int(part) <= 255 for part in match[0].split(".")))
                or (kind == 2 and 12 <= len(digits) <= 19 and luhn(digits))
                or (kind == 3 and 9 <= len(digits) <= 15)
            )
            if good:
                out.append((match.start(), kind, match.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(
    ["a@b.c", "@", "x_", ".", "10.0.0.1", "256.", "+1 (555) 555-2485", "4524132264652876", " ", "-", "é", "12", "\n"]
), max_size=14).map("".join))
def test_base_spans_as_by_hand(text):
    assert base_spans(text) == plain_spans(text)


def test_long_runs_cost_no_more():
    assert base_spans("a" * 300_000 + "@") == []
    assert base_spans("1" * 300_000) == []


def revealing_corpus(spark):
    """Contact sentences of one address, each time in other words but with the same rare name."""
    generator = random.Random(2)
    word = lambda: "w%d" % generator.randrange(40)
    texts = [
        f"{word()} {word()} {word()} Zorblax {word()} write to z@private.example {word()} {word()} {word()}"
        for _ in range(12)
    ]
    texts += [" ".join(word() for _ in range(30)) + " write to nobody" for _ in range(200)]
    texts += ["only copies beside rare Quux q@copied.example here"] * 30
    texts += [None, ""]
    rows = [(i, text, "x") for i, text in enumerate(texts)] + [(None, texts[0], "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string")


def test_terms_that_reveal_an_entity_are_found_and_others_stay(spark):
    docs = revealing_corpus(spark)
    found = find_private_data(docs).collect()
    assert len(found) == docs.count()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in found:
        text = texts[row["doc_id"]] if row["doc_id"] is not None else texts[0]
        added = [text[s["start"] : s["end"]] for s in row["added"] or []]
        if text and "z@private" in text:
            assert added == ["Zorblax"]
        else:
            assert added == []  # copies of one passage are one context
    clean = {r["doc_id"]: r["text"] for r in sanitised(docs).collect()}
    assert "Zorblax" not in clean[0] and "z@private" not in clean[0] and "[EMAIL]" in clean[0]
    assert clean[100] == texts[100]
    assert clean[241] == texts[241].replace("q@copied.example", "[EMAIL]")
    assert sorted(map(str, (clean[242], clean[243]))) == ["", "None"]


def test_terms_far_from_an_entity_and_without_it_are_found(spark):
    generator = random.Random(3)
    common = lambda n: " ".join("w%d" % generator.randrange(40) for _ in range(n))
    texts = [f"Zorblax {common(30)} z@private.example {common(20)} zorblax" for _ in range(3)]
    texts += [f"{common(10)} Zorblax {common(5)}"] + [common(30) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in find_private_data(docs).where("doc_id < 10").collect():
        added = [texts[row["doc_id"]][s["start"] : s["end"]] for s in row["added"] or []]
        assert added == [["Zorblax", "zorblax"], ["Zorblax"], []][(row["doc_id"] > 2) + (row["doc_id"] > 3)]
    clean = {r["doc_id"]: r["text"] for r in sanitised(docs).collect()}
    assert not any("zorblax" in clean[i].lower() for i in range(4))
    assert all(clean[i] == texts[i] for i in range(4, len(texts)))


def test_a_pair_in_two_different_texts_is_scored(spark):
    texts = ["Zorblax a b z@private.example", "c z@private.example d Zorblax"] + ["a b c d"] * 300
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in sanitised(docs).collect()}
    assert "Zorblax" not in clean[0] + clean[1] and clean[2] == texts[2]


def shingles(text):
    words = re.findall(r"[^\W_]+", re.sub(PATTERNS[0], " ", text).lower())
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def plain_disclosures(texts):
    """Every pair of entity and term by nested loops; texts that share a shingle are one context."""
    total, terms, entities = len(texts), {}, {}
    for place, text in enumerate(texts):
        bare = re.sub(PATTERNS[0], " ", text).lower()
        for term in set(re.findall(r"[^\W_]+", bare)):
            terms.setdefault(term, set()).add(place)
        for match in re.finditer(PATTERNS[0], text):
            entities.setdefault(match[0].lower(), set()).add(place)
    out = {}
    for value, holders in entities.items():
        for term, places in terms.items():
            families = []
            for place in holders & places:
                near = [f for f in families if any(shingles(texts[place]) & shingles(texts[o]) for o in f)]
                families = [f for f in families if f not in near] + [{place}.union(*near)]
            if len(families) < 2:
                continue
            both = len(holders & places) * (len(families) - 1) / len(families) / total
            pmi = math.log(both / (len(places) / total * len(holders) / total))
            if (share := pmi / -math.log(len(holders) / total)) >= 0.8:
                out[term] = max(share, out.get(term, 0))
    return out


def test_disclosure_and_added_spans_as_brute_force(spark):
    """Names beside addresses, in edited copies and in texts of their own; some names elsewhere too."""
    generator = random.Random(11)
    common = lambda n: [f"c{generator.randrange(300)}" for _ in range(n)]
    texts = [" ".join(common(40)) for _ in range(600)]
    for person in range(12):
        address, names = f"p{person}@private.example", [f"Name{person}", f"Town{person}"]
        for _ in range(1 + person % 4):  # contexts
            family = [*common(20), names[0], address, *common(20), *names[1 : 1 + person % 2]]
            texts.append(" ".join(family))
            for _ in range(person % 3):  # edited copies
                texts.append(" ".join(word if i != 3 else common(1)[0] for i, word in enumerate(family)))
        texts += [" ".join([*common(30), names[0]]) for _ in range(person // 3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = plain_disclosures(texts)
    assert {"name2", "name3", "town3"} <= set(want) and "name0" not in want and "name4" not in want
    for row in find_private_data(docs).collect():
        text = texts[row["doc_id"]]
        expected = [
            (m.start(), m.end(), round(want[m[0].lower()], 9))
            for m in re.finditer(r"[^\W_]+", text)
            if m[0].lower() in want
        ]
        got = [(s["start"], s["end"], round(s["disclosure"], 9)) for s in row["added"] or []]
        assert got == expected


def test_edited_copies_are_one_context(spark):
    generator = random.Random(5)
    base = [f"u{generator.randrange(10**6)}" for _ in range(80)]
    copies = [
        " ".join([*(f"v{generator.randrange(10**6)}" if generator.random() < 0.1 else w for w in base), "z@private.example"])
        for _ in range(8)
    ]
    texts = copies + [" ".join(generator.choices(base, k=10)) for _ in range(5)]
    texts += [f"some other words {i}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert find_private_data(docs).where("added is not null").count() == 0


def test_counts_of_candidates_are_exact(spark):
    docs = revealing_corpus(spark)
    wanted = spark.createDataFrame([("zorblax",), ("w3",), ("absent",)], "term string")
    counts = {r["term"]: r["term_docs"] for r in document_frequencies(docs, "text", wanted).collect()}
    texts = [r["text"] or "" for r in docs.collect()]
    assert counts["zorblax"] == sum("Zorblax" in t for t in texts)
    assert counts["w3"] == sum("w3" in t.split() for t in texts)


def test_odd_documents(odd_docs, no_docs):
    found = find_private_data(odd_docs)
    assert found.count() == odd_docs.count()
    spans = found.where("doc_id = 10").first()["spans"]
    assert spans["kinds"] == [0, 3, 2, 1]
    clean = sanitised(odd_docs)
    assert clean.columns == odd_docs.columns
    text = clean.where("doc_id = 10").first()["text"]
    assert text == "mail [EMAIL] or [PHONE], card [CARD], host [IP]"
    assert find_private_data(no_docs).count() == sanitised(no_docs).count() == 0


def test_query_agrees_with_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    names = ("email", "ip", "card", "phone")
    for row in QUERIES["op10_private_data"](spark, sf_dir).collect():
        spans = plain_spans(docs[row["doc_id"]])
        text = ",".join(f"{names[kind]}:{start}:{end}" for start, kind, end in spans)
        assert row["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [row[f"n_{name}"] for name in names] == [
            sum(kind == i for _, kind, _ in spans) for i in range(4)
        ]
        assert [s for s in row["spans"].split(",") if s and not s.startswith("term")] == [
            s for s in text.split(",") if s
        ]


def test_rate_of_documents_left_alone(spark):
    docs = spark.createDataFrame([(i, f"plain words number {i}") for i in range(50)], "doc_id long, text string")
    assert find_private_data(docs).where(F.size("spans.kinds") > 0).count() == 0


def test_an_address_with_very_many_zeros_is_one():
    text = "at 1.2.3." + "0" * 6_000 + "1 and 1.2.3." + "0" * 6_000 + "256"
    assert base_spans(text) == [(3, 1, 3 + 6 + 6_001)]
