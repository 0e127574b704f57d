"""Merkle manifest of a dataset in a van Emde Boas layout (operator 12).

Every row is a leaf; per language leaves are hashed together in runs of eight, level by level, up to a
subroot, and subroots likewise up to the root. Digests are hex text wherever they are hashed.

A tree is built in tiers of aligned blocks. A block is the subtree over ``ARITY ** HEIGHT`` neighbouring
nodes, and one task builds it in one array: the complete subtree is split at half its height, the upper
part stands first and then each lower part, each laid out likewise (:func:`addresses`). So a path
through a block touches few cache lines, whatever their size, and both building and looking up siblings
need address arithmetic only, no pointers. The roots of all blocks are the leaves of the next tier,
until one block is left; a tier is 4,096 times smaller than the one below.

Proofs go the other way: a block's path to the root is its own siblings above it, found in its parent
block, and its parent's path. At the leaves, one task has a block's array, its path and its rows.

Leaves are numbered within their tree without gathering a tree in one task: rows are range-partitioned
by (tree, id), counted per range, and numbered inside a range behind the counts of earlier ones. Equal
rows are counted before that and spread out again after, so a hot tree, or a row repeated very often, is
in no single task. The driver holds the number of tiers only.

Defined cases: a NULL value is hashed as ``-``; a NULL language is a tree of its own, the first; leaves of
NULL ids come first, equal ids are ordered by their leaves, and equal rows are leaves side by side; a
NULL id is never tampered with; an empty table gives an empty result; texts of any length are hashed whole
by SQL functions. Other columns of the input do not matter.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tidewatch.llm.common import cut

ARITY = 8
#: Levels of a block above its leaves.
HEIGHT = 4
DIGEST = 32
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TEXTS = ArrayType(StringType())
BLOCK_SCHEMA = (
    StructType([StructField("tree", StringType())])
    .add("block", LongType())
    .add("n_leaves", LongType())
    .add("n_nodes", LongType())
    .add("nodes", BinaryType())
    .add("digest", BinaryType())
)
PATH_SCHEMA = (
    StructType([StructField("tree", StringType())])
    .add("block", LongType())
    .add("before", TEXTS)
    .add("after", TEXTS)
    .add("subroot", StringType())
    .add("root", StringType())
)
BLOCK_ARROW, PATH_ARROW = to_arrow_schema(BLOCK_SCHEMA), to_arrow_schema(PATH_SCHEMA)


# --- layout -------------------------------------------------------------------------------


def tree_size(levels: int) -> int:
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index):
    """Slot of node ``index`` (a number or an array) at ``depth`` of a complete tree with so many levels.

    The tree is split at half its levels. A node of the upper part is looked for there; one below
    belongs to one of the lower parts, which stand one after the other behind the upper part.
    """
    base = 0
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        lower = levels - upper
        part, index = np.divmod(index, ARITY ** (depth - upper))
        base = base + tree_size(upper) + part * tree_size(lower)
        depth, levels = depth - upper, lower
    return base + index


@cache
def addresses(levels: int, depth: int) -> np.ndarray:
    """Slots of all nodes of a depth, left to right."""
    return address(levels, depth, np.arange(ARITY**depth))


def height(n_nodes: int) -> int:
    """Levels above so many nodes until one is left."""
    levels = 0
    while ARITY**levels < n_nodes:
        levels += 1
    return levels


class Block:
    """One subtree: ``n_nodes`` leaves at its deepest level, in the layout of the complete tree."""

    def __init__(self, n_nodes: int, levels: int, slots: np.ndarray) -> None:
        self.n_nodes, self.levels, self.slots = n_nodes, levels, slots

    @classmethod
    def build(cls, digests: Sequence[bytes], above: int) -> Block:
        """From the digests of the leaves in order; ``above`` is the number of levels to add."""
        levels = above + 1
        slots = np.zeros((tree_size(levels), DIGEST), np.uint8)
        block = cls(len(digests), levels, slots)
        leaves = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, DIGEST)
        slots[addresses(levels, above)[: len(digests)]] = leaves
        for depth in range(above, 0, -1):
            parents = [sha256(run.hex().encode()).digest() for run in block.runs(depth)]
            at = addresses(levels, depth - 1)[: len(parents)]
            slots[at] = np.frombuffer(b"".join(parents), np.uint8).reshape(-1, DIGEST)
        return block

    @classmethod
    def read(cls, nodes: bytes, n_nodes: int) -> Block:
        slots = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
        levels = 1
        while tree_size(levels) < len(slots):
            levels += 1
        return cls(n_nodes, levels, slots)

    def width(self, depth: int) -> int:
        """Nodes that exist at a depth."""
        return -(-self.n_nodes // ARITY ** (self.levels - 1 - depth))

    def runs(self, depth: int) -> list[bytes]:
        """Digests of each run of siblings at a depth, concatenated."""
        at = addresses(self.levels, depth)[: self.width(depth)]
        found = self.slots[at].tobytes()
        step = ARITY * DIGEST
        return [found[i : i + step] for i in range(0, len(found), step)]

    @property
    def root(self) -> bytes:
        return self.slots[0].tobytes()

    def siblings(self) -> Iterator[tuple[list[str], list[str]]]:
        """Per leaf, what stands before and after it and its ancestors, from the leaf up."""
        runs = [
            [run.hex() for run in self.runs(depth)] for depth in range(self.levels - 1, 0, -1)
        ]
        for leaf in range(self.n_nodes):
            before, after, index = [], [], leaf
            for level in runs:
                index, place = divmod(index, ARITY)
                before.append(level[index][: 2 * DIGEST * place])
                after.append(level[index][2 * DIGEST * (place + 1) :])
            yield before, after


def fold(digest: str, before: Sequence[str], after: Sequence[str]) -> str:
    """The root that a digest leads to with these siblings."""
    for left, right in zip(before, after, strict=True):
        digest = sha256(f"{left}{digest}{right}".encode()).hexdigest()
    return digest


# --- leaves -------------------------------------------------------------------------------


def hashed_value(value: Column) -> Column:
    text = value.cast("string")
    counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(counted, F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(hashed_value, values)), 256)


def is_tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))


def tampered_text(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def leaves_of(docs: DataFrame, columns: Sequence[str] = LEAF_COLUMNS) -> DataFrame:
    """``tree, doc_id, digest`` and the digest ``tampered``, NULL where nothing was tampered with.

    ``columns`` are the id, source, language, length and text, in this order.
    """
    values = [docs[name] for name in columns]
    doc_id, _, lang, _, text = values
    changed = leaf_digest([*values[:-1], tampered_text(text)])
    return docs.select(
        # A NULL language is the empty name, which comes before all others.
        F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit("")).alias("tree"),
        doc_id.alias("doc_id"),
        F.unhex(leaf_digest(values)).alias("digest"),
        F.when(is_tampered(doc_id), F.unhex(changed)).alias("tampered"),
    )


def indexed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``place``, from 0 without gaps within a ``tree``, and the tree's ``n_leaves``."""
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    ranged = cut(
        counted.repartitionByRange("tree", *order).withColumn("range", F.spark_partition_id())
    )
    tree = Window.partitionBy("tree")
    before = tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("tree", "range").agg(F.sum("copies").alias("here")).select(
        "tree",
        "range",
        F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"),
        F.sum("here").over(tree).alias("n_leaves"),
    )
    inside = (
        Window.partitionBy("tree", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = ranged.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    each = placed.join(sums, ["tree", "range"]).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
    )
    place = (F.col("before") + F.col("inside") + F.col("copy")).cast("long")
    return each.select(*rows.columns, place.alias("place"), "n_leaves")


# --- building -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Forest:
    """Trees over indexed leaves: the blocks of each tier; the last tier has one block per tree."""

    tiers: tuple[DataFrame, ...]
    block_height: int = HEIGHT

    @property
    def roots(self) -> DataFrame:
        return self.tiers[-1].select("tree", "digest")


def block_of(place: Column, block_height: int) -> Column:
    return F.floor(place / ARITY**block_height)


def block_builder(block_height: int):
    def built(table: pa.Table) -> pa.Table:
        """The block over some neighbouring nodes of one tree."""
        table = table.sort_by("place")
        first = {name: table.column(name)[0].as_py() for name in ("tree", "block", "n_leaves")}
        above = min(block_height, height(first["n_leaves"]))
        block = Block.build(table.column("digest").to_pylist(), above)
        row = {**first, "n_nodes": block.n_nodes, "nodes": block.slots.tobytes(), "digest": block.root}
        return pa.Table.from_pylist([row], BLOCK_ARROW)

    return built


def build(leaves: DataFrame, block_height: int = HEIGHT) -> Forest:
    """All trees over ``tree, place, digest, n_leaves``; one small action, for the largest tree."""
    built, width = block_builder(block_height), ARITY**block_height
    nodes = leaves.select("tree", "place", "digest", "n_leaves")
    largest = leaves.agg(F.max("n_leaves")).first()[0] or 1
    tiers = []
    while not tiers or largest > 1:
        keyed = nodes.withColumn("block", block_of(F.col("place"), block_height))
        tiers.append(cut(keyed.groupBy("tree", "block").applyInArrow(built, BLOCK_SCHEMA)))
        largest = -(-largest // width)
        nodes = tiers[-1].select(
            "tree",
            F.col("block").alias("place"),
            "digest",
            F.ceil(F.col("n_leaves") / width).cast("long").alias("n_leaves"),
        )
    return Forest(tuple(tiers), block_height)


@dataclass(frozen=True)
class Manifest:
    """One tree per language, and ``top``, the tree whose leaves are their subroots.

    ``subroots`` has each language's ``name`` (its tree), ``place`` in the top tree and ``digest``.
    """

    languages: Forest
    subroots: DataFrame
    top: Forest

    @property
    def root(self) -> DataFrame:
        """``root`` in one row, none for an empty table."""
        return self.top.roots.select(hex_text(F.col("digest")).alias("root"))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def manifest(leaves: DataFrame, block_height: int = HEIGHT) -> Manifest:
    """Build both levels of trees over indexed leaves."""
    languages = build(leaves, block_height)
    named = languages.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    subroots = cut(indexed(named, ["name"]))
    return Manifest(languages, subroots, build(subroots, block_height))


# --- proofs -------------------------------------------------------------------------------


def opener(block_height: int):
    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of blocks with their paths, the path of each leaf of the block."""
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.read(row["nodes"], row["n_nodes"])
                first = row["block"] * ARITY**block_height
                paths = [
                    {
                        "tree": row["tree"],
                        "block": first + leaf,
                        "before": before + row["before"],
                        "after": after + row["after"],
                        "subroot": row["subroot"],
                        "root": row["root"],
                    }
                    for leaf, (before, after) in enumerate(block.siblings())
                ]
                yield pa.RecordBatch.from_pylist(paths, PATH_ARROW)

    return opened


def down(tiers: Sequence[DataFrame], paths: DataFrame, block_height: int) -> DataFrame:
    """Paths of the leaves of the lowest of ``tiers``, from those of the blocks of the highest."""
    for blocks in reversed(tiers):
        with_path = blocks.drop("digest", "n_leaves").join(paths, ["tree", "block"])
        paths = with_path.mapInArrow(opener(block_height), PATH_SCHEMA)
    return paths


def proved(leaves: pa.Table, blocks: pa.Table) -> pa.Table:
    """Proof and folded root of every leaf of one block."""
    leaves = leaves.sort_by("place")
    above = blocks.to_pylist()[0]
    paths = Block.read(above["nodes"], above["n_nodes"]).siblings()
    digests, changed = (leaves.column(name).to_pylist() for name in ("digest", "tampered"))
    proofs, folded = [], []
    for (before, after), digest, tampered in zip(paths, digests, changed, strict=True):
        before, after = before + above["before"], after + above["after"]
        siblings = "".join(side for level in zip(before, after, strict=True) for side in level)
        proofs.append(sha256(siblings.encode()).hexdigest())
        folded.append(fold((tampered or digest).hex(), before, after))
    n = len(proofs)
    return pa.table(
        {
            "doc_id": leaves.column("doc_id"),
            "leaf": [digest.hex() for digest in digests],
            "subroot": [above["subroot"]] * n,
            "root": [above["root"]] * n,
            "proof_sha256": proofs,
            "folded_root": folded,
            "verified": [root == above["root"] for root in folded],
        }
    )


def prove(leaves: DataFrame, made: Manifest) -> DataFrame:
    """Per leaf its subroot, root, proof, and the root its (tampered) digest leads to with that proof."""
    nothing = F.array().cast("array<string>")
    top_paths = made.top.tiers[-1].select(
        "tree",
        "block",
        nothing.alias("before"),
        nothing.alias("after"),
        F.lit(None).cast("string").alias("subroot"),
        hex_text(F.col("digest")).alias("root"),
    )
    of_subroots = down(made.top.tiers, top_paths, made.top.block_height).drop("tree", "subroot")
    languages = made.subroots.join(of_subroots, F.col("place") == F.col("block")).select(
        F.col("name").alias("tree"),
        F.lit(0).cast("long").alias("block"),
        "before",
        "after",
        hex_text(F.col("digest")).alias("subroot"),
        "root",
    )
    tiers, block_height = made.languages.tiers, made.languages.block_height
    paths = down(tiers[1:], languages, block_height)
    blocks = tiers[0].select("tree", "block", "n_nodes", "nodes").join(paths, ["tree", "block"])
    rows = leaves.withColumn("block", block_of(F.col("place"), block_height))
    schema = StructType([StructField("doc_id", leaves.schema["doc_id"].dataType)])
    for name in ("leaf", "subroot", "root", "proof_sha256", "folded_root"):
        schema = schema.add(name, StringType())
    key = ("tree", "block")
    return (
        rows.groupBy(*key)
        .cogroup(blocks.groupBy(*key))
        .applyInArrow(proved, schema.add("verified", BooleanType()))
    )


def merkle_proofs(
    docs: DataFrame, columns: Sequence[str] = LEAF_COLUMNS, block_height: int = HEIGHT
) -> DataFrame:
    """Manifest of a table, and every row's proof against it."""
    leaves = cut(indexed(leaves_of(docs, columns), ["doc_id", "digest", "tampered"]))
    return prove(leaves, manifest(leaves, block_height))
