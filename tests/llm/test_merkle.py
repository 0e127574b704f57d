from __future__ import annotations

import re
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm.merkle import Block, address, fold, height, merkle_proofs, tree_size


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def in_runs(nodes):
    return [nodes[i : i + 8] for i in range(0, len(nodes), 8)]


def levels_of(nodes):
    """All levels of a tree, by lists."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*run) for run in in_runs(levels[-1])])
    return levels


def climb(levels, place, node):
    """Concatenated siblings of a leaf, and the digest that ``node`` in its place leads to."""
    siblings = ""
    for level in levels[:-1]:
        run, at = level[place // 8 * 8 : place // 8 * 8 + 8], place % 8
        siblings += "".join(run[:at] + run[at + 1 :])
        node, place = digest(*run[:at], node, *run[at + 1 :]), place // 8
    return siblings, node


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def by_lists(rows):
    def changed(row):
        return row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0

    trees = defaultdict(list)
    for row in rows:
        text = row["text"]
        if text is not None and changed(row):
            text = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        first = (row["doc_id"] is not None, row["doc_id"] or 0)
        trees[row["lang"]].append((first, leaf(row, row["text"]), leaf(row, text), row["doc_id"]))
    names = sorted(trees, key=lambda name: (name is not None, (name or "").encode()))
    made = {name: levels_of([entry[1] for entry in sorted(trees[name], key=lambda e: e[:2])]) for name in names}
    top = levels_of([made[name][-1][0] for name in names])
    found = []
    for i, name in enumerate(names):
        for place, (_, original, tampered, doc_id) in enumerate(sorted(trees[name], key=lambda e: e[:2])):
            low, subroot = climb(made[name], place, tampered)
            high, root = climb(top, i, subroot)
            want = top[-1][0]
            found.append((doc_id, original, made[name][-1][0], want, digest(low + high), root, root == want))
    return found


@pytest.mark.parametrize("levels", range(1, 7))
def test_addresses_fill_the_layout_once(levels):
    found = np.concatenate([np.atleast_1d(address(levels, d, np.arange(8**d))) for d in range(levels)])
    assert sorted(found.tolist()) == list(range(tree_size(levels)))
    assert address(levels, 0, 0) == 0


def test_a_subtree_at_half_height_stands_together():
    # Five levels: two above, and 64 trees of three levels behind them.
    inside = [int(address(5, 2 + d, 5 * 8**d + i)) for d in range(3) for i in range(8**d)]
    assert sorted(inside) == list(range(9 + 5 * 73, 9 + 6 * 73))


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 500, 513, 4095, 4096])
def test_block_against_lists(n):
    digests = [sha256(str(i).encode()).digest() for i in range(n)]
    block = Block.build(digests, height(n))
    levels = levels_of([d.hex() for d in digests])
    assert block.root.hex() == levels[-1][0]
    again = Block.read(block.slots.tobytes(), n)
    paths = list(again.siblings())
    for place in {0, n // 2, n - 1}:
        siblings, root = climb(levels, place, digests[place].hex())
        before, after = paths[place]
        assert "".join(a + b for a, b in zip(before, after, strict=True)) == siblings
        assert fold(digests[place].hex(), before, after) == root


@pytest.mark.parametrize("block_height", [1, 2, 4])
def test_many_documents_against_lists(spark, block_height):
    rows = [
        (i * 7 % 601, f"Text {i} ÄÖ" if i % 11 else None, [None, "en", "é", "z", "\U0001f600", "", "ﬀ"][min(i % 40, 6)], "s", i)
        for i in range(600)
    ] + [(1000 + i, "One Text", f"l{i:02}", None, None) for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = merkle_proofs(docs.repartition(5), block_height=block_height).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, by_lists(docs.collect())))


def test_odd_documents(odd_docs, no_docs):
    clashing = odd_docs.withColumns({name: F.lit("x") for name in ("tree", "digest", "place", "leaf", "root", "range")})
    found = merkle_proofs(clashing).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, by_lists(odd_docs.collect())))
    assert {row["verified"] for row in found} == {True, False}
    assert merkle_proofs(no_docs).count() == 0


def test_text_ids_and_equal_rows_in_number(spark):
    docs = spark.createDataFrame(
        [("k", "Same", "en", "s", 4)] * 5_000 + [("b", "Other", "en", "s", 5)],
        "doc_id string, text string, lang string, source string, n_chars long",
    )
    found = merkle_proofs(docs)
    assert found.count() == 5_001 and found.select("root").distinct().count() == 1
