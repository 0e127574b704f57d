from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.llm import common
from tidewatch.llm.packing import best_fit_packing, cuts, plan_sequences, sequences, token_ids


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def want_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_are_those_of_the_tokenizer(tokenizer, odd_rows):
    extra = ["a<|endoftext|>b", "a  b   c\n \n d\t", "don't 12,34 x\xa0 y", "é́   z", "   "]
    for text in [row[1] for row in odd_rows] + extra:
        assert token_ids(text).tolist() == want_ids(tokenizer, text)


def test_only_the_first_piece_is_short():
    assert cuts(5, 4) == [(0, 1), (1, 4)]
    assert cuts(8, 4) == [(0, 4), (4, 4)]
    assert cuts(3, 4) == [(0, 3)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=24, max_size=24))
def test_plan_places_every_piece_once_and_nothing_overlaps(numbers):
    capacity = 24
    counts = np.array([0, *numbers])
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    starts, sequence, times, offset = plan_sequences(counts, capacity).intervals(first)
    used = defaultdict(list)
    for number, length in enumerate(np.repeat(np.arange(25), counts)):
        at = np.searchsorted(starts, number, side="right") - 1
        ahead = number - starts[at]
        used[sequence[at] + ahead // times[at]].append((offset[at] + ahead % times[at] * length, length))
    for places in used.values():
        end = 0
        for start, length in sorted(places):
            assert start == end
            end = start + length
        assert end <= capacity
        assert sum(length > capacity // 3 for _, length in places) <= 2
    least = -(-int((counts * np.arange(25)).sum()) // capacity)
    assert len(used) <= 1.23 * least + 1


def test_large_pieces_are_matched_best():
    counts = np.zeros(101, np.int64)
    counts[[60, 55, 45, 40]] = 3, 2, 2, 3
    plan = plan_sequences(counts, 100)
    assert sum(count for groups in plan.groups for count, _ in groups) == 5


@pytest.mark.parametrize("bucket_rows", [1, 5_000])
def test_odd_documents(odd_docs, no_docs, tokenizer, monkeypatch, bucket_rows):
    monkeypatch.setattr(common, "ROWS_PER_BUCKET", bucket_rows)
    packed = best_fit_packing(odd_docs, capacity=64, keep_ids=True).collect()
    want = []
    for row in odd_docs.collect():
        ids = want_ids(tokenizer, row["text"])
        for piece, (start, length) in enumerate(cuts(len(ids), 64)):
            part = np.array(ids[start : start + length], "<u4")
            want.append((str(row["doc_id"]), piece, start, length, zlib.crc32(part.tobytes())))
    assert sorted(want) == sorted(
        (str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed
    )
    places = defaultdict(list)
    for row in packed:
        places[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in places.values():
        ends = np.cumsum([length for _, length in sorted(parts)])
        assert [offset for offset, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 64
    assert best_fit_packing(no_docs).count() == 0


def test_sequences_hold_the_ids(odd_docs):
    packed = best_fit_packing(odd_docs, capacity=64, keep_ids=True).cache()
    total = packed.agg(F.sum("length")).first()[0]
    found = sequences(packed)
    assert found.agg(F.sum(F.size("ids")), F.max(F.size("ids"))).first()[0] == total
    one = packed.where("offset = 0 and length = 64").first()
    assert found.where(F.col("sequence_id") == one["sequence_id"]).first()["ids"] == one["ids"]
