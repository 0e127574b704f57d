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

from tidewatch.llm.sum_of_squares import Lane, Part, sum_of_squares_packing, windows


def brute_force(sizes, capacity):
    """Fill of every window, each choice made by adding up all squares."""
    fills = []

    def squares(levels):
        partial = [fill for fill in levels if fill < capacity]
        return sum(partial.count(level) ** 2 for level in set(partial))

    for size in sizes:
        choices = [(squares([*fills, size]), 1, None)]
        for i, fill in enumerate(fills):
            if fill + size <= capacity:
                choices.append((squares([*fills[:i], fill + size, *fills[i + 1 :]]), -fill, i))
        _, _, best = min(choices, key=lambda choice: choice[:2])
        if best is None:
            fills.append(size)
        else:
            fills[best] += size
    return fills


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 15), max_size=60))
def test_each_document_goes_where_the_sum_of_squares_is_least(sizes):
    lane, full = Lane(16), 0
    for number, size in enumerate(sizes):
        full += len(lane.add(Part(number, 0, np.zeros(size, "<u2"), size)))
    left = [window.fill for windows_ in lane.open for window in windows_]
    assert sorted([16] * full + left) == sorted(brute_force(sizes, 16))
    for level, windows_ in enumerate(lane.open):
        assert lane.counts[level] == len(windows_) and all(w.fill == level for w in windows_)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=60))
def test_closing_loses_nothing_and_pads_one_window(sizes):
    lane, done, ids = Lane(16), [], {}
    for number, size in enumerate(sizes):
        ids[number] = np.arange(size, dtype="<u2")
        done += lane.add(Part(number, 0, ids[number], size))
    done += lane.close()
    pieces = defaultdict(list)
    for window in done:
        assert 0 < window.fill == sum(len(part.ids) for part in window.parts) <= 16
        for part in window.parts:
            pieces[part.doc_id].append((part.start, part.ids.tolist()))
    assert sum(window.fill < 16 for window in done) <= 1
    for number, size in enumerate(sizes):
        found = [i for start, piece in sorted(pieces[number]) for i in piece]
        assert found == list(range(size)) and all(piece[0] == start for start, piece in pieces[number])


@pytest.mark.parametrize("docs_per_lane", [3, 10_000])
def test_odd_documents(odd_docs, no_docs, docs_per_lane):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = sum_of_squares_packing(odd_docs, capacity=64, docs_per_lane=docs_per_lane)
    rows = packed.withColumn("crc", F.crc32("ids")).collect()
    wanted, documents = [], odd_docs.collect()
    for row in documents:
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids
        wanted.append((str(row["doc_id"]), np.array([*ids, 1], "<u4").tobytes()))
    pieces = defaultdict(list)
    for row in rows:
        assert len(row["ids"]) == 4 * row["length"] and row["crc"] == zlib.crc32(row["ids"])
        pieces[str(row["doc_id"]), row["doc_tokens"]].append((row["start"], bytes(row["ids"])))
    total = defaultdict(int)
    for doc_id, ids in wanted:
        total[doc_id, len(ids) // 4] += 1
        for start, piece in pieces[doc_id, len(ids) // 4]:
            assert piece == ids[4 * start : 4 * start + len(piece)]
    for key, times in total.items():
        covered = np.zeros(key[1], int)
        for start, piece in pieces[key]:
            covered[start : start + len(piece) // 4] += 1
        assert (covered == times).all()
    places = defaultdict(list)
    for row in rows:
        places[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in places.values():
        ends = np.cumsum([length for _, length in sorted(parts)])
        assert [offset for offset, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 64
    lanes = -(-len(documents) // docs_per_lane)
    assert sum(sum(length for _, length in parts) < 64 for parts in places.values()) <= lanes
    assert sum_of_squares_packing(no_docs).count() == 0


def test_a_rerun_gives_the_same_rows_and_windows_hold_the_ids(odd_docs):
    first, again = (sum_of_squares_packing(df, capacity=64) for df in (odd_docs, odd_docs.repartition(7)))
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect()))
    found = windows(first).agg(F.sum("n_ids"), F.sum(F.octet_length("ids")), F.max("n_ids")).first()
    assert found[0] * 4 == found[1] and found[2] == 64
