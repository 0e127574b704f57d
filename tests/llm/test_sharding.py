from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import common
from tidewatch.llm.sharding import CapacityTree, best_fit_decreasing, level, shard


def plain_best_fit(sizes, capacity):
    room, placed = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(left, b) for b, left in enumerate(room) if left >= sizes[i]]
        if fits:
            _, b = min(fits)
        else:
            b = len(room)
            room.append(max(capacity, sizes[i]))
        room[b] -= sizes[i]
        placed[i] = b
    return [placed[i] for i in range(len(sizes))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.integers(1, 50))
def test_best_fit_decreasing_as_by_hand(sizes, capacity):
    found = best_fit_decreasing(np.array(sizes, np.int64), capacity)
    assert found.tolist() == plain_best_fit(sizes, capacity)


def test_tree_gives_the_tightest_bin():
    generator, tree, open_bins = random.Random(1), CapacityTree(), set()
    for number in range(2000):
        size = generator.randrange(100)
        fits = [bin_ for bin_ in open_bins if bin_[0] >= size]
        assert tree.take_tightest(size) == min(fits, default=None)
        open_bins -= {min(fits, default=None)}
        new = (generator.randrange(100), number)
        tree.add(*new)
        open_bins.add(new)


def test_level_shards_are_nearly_equal_beside_a_huge_item():
    sizes = np.array([20_000, *range(1, 400)], np.int64)
    bins = level(sizes, 8)
    sums = [int(sizes[bins == b].sum()) for b in range(8)]
    others = [s for s in sums if s != 20_000]
    assert len(others) == 7 and max(others) - min(others) <= 2


@pytest.mark.parametrize("bucket_rows", [1, 5_000])
def test_odd_documents(odd_docs, no_docs, monkeypatch, bucket_rows):
    monkeypatch.setattr(common, "ROWS_PER_BUCKET", bucket_rows)
    rows = shard(odd_docs, shards=4).collect()
    texts = odd_docs.collect()
    assert len(rows) == len(texts)
    known = sorted((r["doc_id"] or -1, len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in texts)
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in rows) == known
    slots, shards_of = defaultdict(list), defaultdict(set)
    for row in rows:
        slots[row["shard"]].append(row["slot"])
        shards_of[row["text_crc32"], row["size"]].add(row["shard"])
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    assert all(len(found) == 1 for found in shards_of.values())
    assert set(slots) <= set(range(4))
    assert shard(no_docs).count() == 0


def test_shards_of_many_documents_are_nearly_equal(spark):
    rows = [(i, "x" * (1 + i * 7919 % 997)) for i in range(4000)]
    found = shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=16)
    sums = [r[1] for r in found.groupBy("shard").sum("size").collect()]
    assert len(sums) == 16 and max(sums) - min(sums) < 0.01 * max(sums)
