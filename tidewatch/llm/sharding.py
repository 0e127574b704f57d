"""Sharding of indivisible groups by best-fit-decreasing bin packing (operator 8).

A group is all documents of one text. Groups sorted by size enter the bin with the tightest
remaining capacity that still takes them, found through a balanced tree. As that is serial, it runs
in two levels. Lanes of some ten thousand groups, chosen by hash, are packed side by side into
crates of a 4096th of all bytes (the smallest groups, five percent of a lane's bytes, into crates of
a sixteenth of that); a group larger than a crate is a crate. Crates, whose number depends on the
lanes and not on the documents, are then packed the same way into the shards, with the smallest
capacity at which they fit, which makes the shards nearly equal. Slots follow from the number of
rows before a group in its crate and before a crate in its shard.

A group larger than its share of a shard has a shard to itself, and the others share the rest.
Copies of one text, however many, are one row while packing. To number them they are dealt into
buckets, so no task holds a large group.

Defined cases: a NULL text counts as empty (size 1, CRC 0) and is in the group of the empty texts;
NULL ids sort first in their group; repeated rows each get a slot; an empty table gives an empty
result; other columns of the input do not matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import cut, numbered

SHARDS = 16
LANE_GROUPS = 50_000
CRATES = 4096
FINE_SHARE = 0.05
FINE = 16


class CapacityTree:
    """Open bins by remaining capacity in a treap: a search tree balanced by hashed priorities."""

    def __init__(self) -> None:
        self.root: list | None = None
        self.seed = 1

    def _split(self, node: list | None, key: tuple) -> tuple[list | None, list | None]:
        """Parts below the key, and from it on."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, left: list | None, right: list | None) -> list | None:
        if left is None or right is None:
            return left or right
        if left[1] > right[1]:
            left[3] = self._merge(left[3], right)
            return left
        right[2] = self._merge(left, right[2])
        return right

    def add(self, capacity: int, number: int) -> None:
        self.seed = self.seed * 6364136223846793005 + 1442695040888963407 & (1 << 64) - 1
        left, right = self._split(self.root, (capacity, number))
        new = [(capacity, number), self.seed >> 20, None, None]
        self.root = self._merge(self._merge(left, new), right)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least capacity that is enough."""
        left, rest = self._split(self.root, (size, -1))
        if rest is None:
            self.root = left
            return None
        first, parent = rest, None
        while first[2] is not None:
            parent, first = first, first[2]
        if parent is None:
            rest = first[3]
        else:
            parent[2] = first[3]
        self.root = self._merge(left, rest)
        return first[0]


def best_fit_decreasing(sizes: np.ndarray, capacity: int, bins: int | None = None) -> np.ndarray | None:
    """Bin of each size; None if ``bins`` are given and too few. A size above capacity gets a bin."""
    tree = CapacityTree()
    placed = np.zeros(len(sizes), np.int64)
    opened = 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        found = tree.take_tightest(size)
        if found is None:
            if opened == bins:
                return None
            found = (max(capacity, size), opened)
            opened += 1
        placed[i] = found[1]
        tree.add(found[0] - size, found[1])
    return placed


def level(sizes: np.ndarray, bins: int) -> np.ndarray:
    """Bins of nearly equal content: the least capacity at which best-fit-decreasing needs no more."""
    placed = np.zeros(len(sizes), np.int64)
    order = np.argsort(-sizes, kind="stable")
    left, first = int(sizes.sum()), 0
    while bins > 1 and first < len(order) and int(sizes[order[first]]) * bins >= left:
        bins -= 1
        placed[order[first]] = bins
        left -= int(sizes[order[first]])
        first += 1
    rest = order[first:]
    if not len(rest):
        return placed
    low, high = -(-left // bins), 2 * left + 1
    best = np.zeros(len(rest), np.int64)
    while low < high and (high - low) * 20_000 > low:
        middle = (low + high) // 2
        if (found := best_fit_decreasing(sizes[rest], middle, bins)) is None:
            low = middle + 1
        else:
            best, high = found, middle
    placed[rest] = best
    return placed


def pack_lane(frame: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Crate of each group of a lane and the rows before the group in it."""
    frame = frame.sort_values(["bytes", "text_hash"], ascending=False, ignore_index=True)
    sizes = frame["bytes"].to_numpy()
    coarse = np.cumsum(sizes) <= (1 - FINE_SHARE) * sizes.sum()
    crates = np.zeros(len(sizes), np.int64)
    if coarse.any():
        crates[coarse] = best_fit_decreasing(sizes[coarse], capacity)
    fine = best_fit_decreasing(sizes[~coarse], max(1, capacity // FINE))
    crates[~coarse] = fine + (crates[coarse].max() + 1 if coarse.any() else 0)
    frame["crate"] = crates
    frame["before"] = frame.groupby("crate")["n_rows"].cumsum() - frame["n_rows"]
    return frame[["lane", "crate", "text_hash", "bytes", "n_rows", "before"]]


def pack_crates(frame: pd.DataFrame, shards: int) -> pd.DataFrame:
    """Shard of each crate and the rows before it in the shard."""
    frame = frame.sort_values(["bytes", "lane", "crate"], ascending=False, ignore_index=True)
    frame["shard"] = level(frame["bytes"].to_numpy(), shards)
    frame["base"] = frame.groupby("shard")["n_rows"].cumsum() - frame["n_rows"]
    return frame[["lane", "crate", "shard", "base"]]


def place_groups(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard and first slot of each group; ``groups`` has (text_hash, bytes, n_rows)."""
    groups = cut(groups)
    total = groups.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    lanes = max(1, -(-total["n"] // LANE_GROUPS))
    # With very many lanes a crate is a quarter of a lane, so that crates stay in proportion.
    capacity = max(1, (total["bytes"] or 0) // max(CRATES, 4 * lanes))
    packed = cut(
        groups.withColumn("lane", F.pmod(F.xxhash64("text_hash"), F.lit(lanes)))
        .groupBy("lane")
        .applyInPandas(
            lambda frame: pack_lane(frame, capacity),
            "lane long, crate long, text_hash binary, bytes long, n_rows long, before long",
        )
    )
    crates = packed.groupBy("lane", "crate").agg(
        F.sum("bytes").alias("bytes"), F.sum("n_rows").alias("n_rows")
    )
    shelved = crates.groupBy(F.lit(0).alias("all")).applyInPandas(
        lambda frame: pack_crates(frame, shards), "lane long, crate long, shard int, base long"
    )
    return packed.join(shelved, ["lane", "crate"]).select(
        "text_hash", "n_rows", "shard", (F.col("base") + F.col("before")).alias("first_slot")
    )


def shard(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS
) -> DataFrame:
    """Per row its id, size, the CRC of its text, its shard and its slot in the shard."""
    whole = F.coalesce(docs[text], F.lit(""))
    rows = cut(
        docs.select(
            docs[doc_id].alias("doc_id"),
            (F.octet_length(whole) + 1).cast("long").alias("size"),
            F.crc32(whole).alias("text_crc32"),
            F.unhex(F.md5(whole)).alias("text_hash"),
        )
    )
    groups = rows.groupBy("text_hash").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n_rows")
    )
    placed = cut(place_groups(groups, shards)).withColumnRenamed("text_hash", "group_hash")
    found = rows.join(placed, rows["text_hash"] == placed["group_hash"]).drop("group_hash")
    result = ("doc_id", "size", "text_crc32", "shard", "slot")
    single = found.where("n_rows = 1").withColumn("slot", F.col("first_slot"))
    copies = numbered(found.where("n_rows > 1"), ["text_hash"], "n_rows", "ahead").withColumn(
        "slot", F.col("first_slot") + F.col("ahead")
    )
    return single.select(*result).union(copies.select(*result))
