"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 4).

Two fingerprints at most three bits apart meet at a variant that is one bit from one of them and
two bits from the other. So every fingerprint emits the variants within half the radius, variants
are grouped by a shuffle, and those who meet are verified and linked. Two facts keep the variants
few without losing a pair:

* Fingerprints three (or one) bits apart differ in parity. So only those of odd parity emit
  two-bit variants; all emit the variants within one bit, which also serves pairs two bits apart.
* Of three differing bits two always lie in the same half of the word (there are two halves), and
  any two of the three may be flipped first. So two-bit variants flip two bits of one half.

That leaves 65 variants for even and 1,057 for odd fingerprints, not 2,081. Before that, one
cheaper pass of the same kind finds fingerprints that cannot have a neighbour: three bits leave one
half with at most one difference, so whoever meets nobody within one bit on a half is out.

All who meet at a variant of which they are at most one bit away are linked with all others there,
so a group is linked through one member; no pairs are formed inside a group. Equal fingerprints
(exact copies, any number of them) are one row before any of this.

Defined cases: a NULL or empty text, or one without words, has fingerprint zero and is linked like
any other; shorter texts than a shingle are one shingle; NULL ids do not count as smallest id (a
group of NULL ids only has a NULL component); repeated rows get a result each; an empty table gives
an empty result; other columns of the input do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidewatch.llm.common import cut, small_batches
from tidewatch.llm.components import connected

BITS = 64
HALF = 32
SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Hashes whose bits are counted at a time, so that a very long text takes little memory.
BLOCK = 8192


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint as a signed number: a bit is one if set in over half the shingles' hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(part, SEED) for part in shingles], dtype="<u8")
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), BLOCK):
        block = hashes[start : start + BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_udf(shingle: int):
    @pandas_udf("long")
    def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            yield pd.Series([simhash(text, shingle) for text in series], dtype="int64")

    return fingerprint


def flips(width: int, count: int, offset: int = 0) -> list[int]:
    """Masks that flip ``count`` of the bits from ``offset`` on, as signed 64-bit numbers."""
    masks = (sum(1 << (offset + i) for i in bits) for bits in combinations(range(width), count))
    return [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in masks]


def variants(value: Column, masks: list[int]) -> Column:
    return F.transform(F.lit(np.array(masks, np.int64)), lambda mask: value.bitwiseXOR(mask))


def is_odd(value: Column) -> Column:
    return F.bit_count(value) % 2 == 1


def may_have_neighbours(prints: DataFrame) -> DataFrame:
    """Of distinct fingerprints those that meet another one within one bit on a half."""
    low = F.col("fingerprint").bitwiseAND(F.lit((1 << HALF) - 1))
    high = F.shiftrightunsigned("fingerprint", HALF)
    keys = []
    # The bit above a half tells the two halves' keys apart.
    for half, key in ((low, low), (high, high + F.lit(1 << HALF))):
        near = variants(key, flips(HALF, 1))
        keys.append(F.when(is_odd(half), F.concat(F.array(key), near)).otherwise(F.array(key)))
    met = prints.select("fingerprint", F.explode(F.concat(*keys)).alias("key"))
    crowded = (
        met.groupBy("key")
        .agg(F.min("fingerprint").alias("first"), F.max("fingerprint").alias("last"))
        .where("first <> last")
        .select("key")
    )
    return met.join(crowded, "key", "left_semi").select("fingerprint").distinct()


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) of distinct fingerprints that connect whoever is at most three bits apart."""
    value = F.col("fingerprint")
    near = [0, *flips(BITS, 1)]
    far = [*flips(HALF, 2), *flips(HALF, 2, HALF)]
    masks = F.when(is_odd(value), variants(value, near + far)).otherwise(variants(value, near))
    # A fingerprint is small and its variants are many, so they are dealt to all tasks first.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = prints.repartition(tasks, "fingerprint")
    emitted = dealt.select(value, F.posexplode(masks).alias("place", "variant"))
    emitted = emitted.select("fingerprint", "variant", (F.col("place") < len(near)).alias("near"))
    # Distinct fingerprints within two bits of one variant: at most 2,081 rows, whatever the data.
    group = Window.partitionBy("variant")
    centre = F.min(F.when(F.col("near"), value)).over(group)
    return (
        emitted.withColumn("centre", centre)
        .where(F.col("centre") != value)
        .groupBy(value.alias("a"), F.col("centre").alias("b"))
        .agg(F.lit(1))
        .select("a", "b")
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """Per row its id as ``doc_id``, its ``fingerprint``, ``component_id`` and ``root``.

    The root is the smallest fingerprint of the component; ``component_id`` its smallest id.
    """
    small_batches(docs.sparkSession)
    marked = cut(
        docs.select(
            docs[doc_id].alias("doc_id"), fingerprint_udf(shingle)(docs[text]).alias("fingerprint")
        )
    )
    prints = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    linked = cut(links(cut(may_have_neighbours(prints.select("fingerprint")))))
    roots = connected(linked)
    # Each fingerprint has a root; unlinked ones are their own.
    rooted = cut(
        prints.join(roots, prints["fingerprint"] == roots["node"], "left").select(
            "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
        )
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(smallest, "root").select(
        F.col("fingerprint").alias("named_print"), "root", "component_id"
    )
    return marked.join(named, marked["fingerprint"] == named["named_print"]).select(
        "doc_id", "fingerprint", "root", "component_id"
    )


def keep_one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """Of each component one row with its smallest id, all columns as they are.

    Ids need not be unique: an id of several rows is matched by its fingerprint too, and of rows
    that agree in both the one whose columns hash lowest stays, so that reruns agree.
    """
    groups = near_duplicates(docs, doc_id, text, shingle)
    rows_of_id = F.count("*").alias("id_rows")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fingerprint")
    chosen = groups.groupBy("root").agg(F.min(first).alias("chosen")).select("chosen.*")
    chosen = chosen.select(F.col("doc_id").alias("chosen_id"), F.col("fingerprint").alias("chosen_print"))
    counts = groups.groupBy(F.col("doc_id").alias("counted_id")).agg(rows_of_id)
    chosen = cut(
        chosen.join(counts, F.col("chosen_id").eqNullSafe(F.col("counted_id"))).drop("counted_id")
    )
    # Taken from its frame, as documents may have a column of that name.
    same_id = docs[doc_id].eqNullSafe(chosen["chosen_id"])
    alone = docs.join(chosen.where("id_rows = 1"), same_id, "left_semi")
    shared = (
        docs.join(chosen.where("id_rows > 1").select("chosen_id").distinct(), same_id, "left_semi")
        .select(F.struct(*[docs[name] for name in docs.columns]).alias("row"))
        .withColumn("row_print", fingerprint_udf(shingle)(F.col(f"row.`{text}`")))
    )
    matched = shared.join(
        chosen,
        F.col(f"row.`{doc_id}`").eqNullSafe(F.col("chosen_id"))
        & (F.col("row_print") == F.col("chosen_print")),
        "left_semi",
    )
    one = matched.groupBy(F.col(f"row.`{doc_id}`").alias("row_id"), "row_print").agg(
        F.min_by("row", F.xxhash64("row")).alias("row")
    )
    return alone.union(one.select("row.*"))


def hex_digits(value: Column) -> Column:
    """Sixteen lowercase digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
