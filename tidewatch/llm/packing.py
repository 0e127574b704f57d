"""Best-fit packing of token pieces into sequences, large items matched first (operator 9).

Documents become byte-level BPE ids and an end id; what exceeds a sequence is cut into full pieces
from the end, so that the first piece is the short one. Pieces of equal length are
interchangeable, so only the number of pieces of each length (at most one row per length,
whatever the input) decides the plan:

1. Pieces above a third of the capacity: from the longest down, each is matched with the longest
   one that still fits beside it; no sequence can hold three.
2. Shorter pieces, longest first, go where they leave the least gap (best fit), and open a new
   sequence only if they fit nowhere. Sequences with the same content so far are handled as one
   group with a count.

The plan is a short list of intervals: pieces number a to b of length l go to sequence s and
offset o. Pieces get their number within their length from a distributed count, and so their place.

Defined cases: a NULL or empty text is the end id alone; NULL ids and repeated rows are packed like
others; an empty table gives an empty result; other columns of the input do not matter.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tidewatch.llm.common import cut, numbered, small_batches

CAPACITY = 2048
END_ID = 0
VOCABULARY = "byte_bpe_50k"
#: The one special token of the vocabulary; a text with it goes through the slower reader.
SPECIAL = "<|endoftext|>"


@cache
def rank_encoder(vocabulary: str):
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        pairs = [line.split() for line in lines]
    ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding(
        vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@cache
def full_tokenizer(vocabulary: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))


def token_ids(text: str | None, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Ids of a text and the end id. Both readers give the same ids; this takes the faster one."""
    if not text:
        ids = []
    elif SPECIAL in text:
        ids = full_tokenizer(vocabulary).encode(text, add_special_tokens=False).ids
    else:
        ids = rank_encoder(vocabulary).encode_ordinary(text)
    ids.append(END_ID)
    return np.array(ids, dtype="<u4")


def cuts(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece; only the first may be shorter than the capacity."""
    first = n_ids % capacity or capacity
    starts = [0, *range(first, n_ids, capacity)]
    return [(start, (first if start == 0 else capacity)) for start in starts]


def pieces_udf(vocabulary: str, capacity: int, keep_ids: bool):
    fields = [StructField("n_ids", LongType()), StructField("crcs", ArrayType(LongType()))]
    if keep_ids:
        fields.append(StructField("ids", ArrayType(ArrayType(IntegerType()))))

    def pieces(text: str | None) -> tuple:
        ids = token_ids(text, vocabulary)
        parts = [ids[start : start + length] for start, length in cuts(len(ids), capacity)]
        row = (len(ids), [zlib.crc32(part.tobytes()) for part in parts])
        return (*row, [part.tolist() for part in parts]) if keep_ids else row

    @pandas_udf(StructType(fields))
    def tokenised(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [field.name for field in fields]
        for series in texts:
            yield pd.DataFrame([pieces(text) for text in series], columns=names)

    return tokenised


def tokenised_pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    capacity: int = CAPACITY,
    keep_ids: bool = False,
) -> DataFrame:
    """Per piece its doc_id, number, start, length and CRC, with ``keep_ids`` also its ids."""
    small_batches(docs.sparkSession)
    udf = pieces_udf(vocabulary, capacity, keep_ids)
    found = docs.select(docs[doc_id].alias("doc_id"), udf(docs[text]).alias("t"))
    columns = ["doc_id", "t.n_ids", *(["t.ids"] if keep_ids else [])]
    each = found.select(*columns, F.posexplode("t.crcs").alias("piece", "ids_crc32"))
    first = F.pmod(F.col("n_ids") - 1, F.lit(capacity)) + 1
    start = F.when(F.col("piece") == 0, 0).otherwise(first + (F.col("piece") - 1) * capacity)
    return each.select(
        "doc_id",
        "piece",
        start.cast("long").alias("start"),
        F.when(F.col("piece") == 0, first).otherwise(capacity).cast("long").alias("length"),
        "ids_crc32",
        *([F.element_at("ids", F.col("piece") + 1).alias("ids")] if keep_ids else []),
    )


class Plan:
    """Groups of sequences with equal content: by remaining gap, lists of (count, runs).

    A run (length, times) is so many pieces of one length side by side.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.groups: list[list[tuple[int, tuple]]] = [[] for _ in range(capacity + 1)]

    def add(self, count: int, gap: int, runs: tuple) -> None:
        if count:
            self.groups[gap].append((count, runs))

    def match_large(self, counts: np.ndarray) -> None:
        least = self.capacity // 3 + 1
        for length in range(self.capacity, least - 1, -1):
            other = min(length, self.capacity - length)
            while counts[length] and other >= least:
                if other == length:
                    pairs = int(counts[length]) // 2
                else:
                    pairs = int(min(counts[length], counts[other]))
                counts[length] -= pairs
                counts[other] -= pairs
                self.add(pairs, self.capacity - length - other, ((length, 1), (other, 1)))
                other -= 1
            self.add(int(counts[length]), self.capacity - length, ((length, 1),))
            counts[length] = 0

    def fit_small(self, length: int, count: int) -> None:
        gap = length
        while count:
            while gap < self.capacity and not self.groups[gap]:
                gap += 1
            if self.groups[gap]:
                sequences, runs = self.groups[gap].pop()
            else:
                sequences, runs = -(-count // (self.capacity // length)), ()
            times = gap // length
            full = min(sequences, count // times)
            self.add(full, gap - times * length, (*runs, (length, times)))
            count -= full * times
            sequences -= full
            if count and sequences:
                self.add(1, gap - count * length, (*runs, (length, count)))
                count, sequences = 0, sequences - 1
            self.add(sequences, gap, runs)

    def intervals(self, first_number: np.ndarray) -> tuple[np.ndarray, ...]:
        """By the pieces' numbers: where an interval starts, its sequence, run times and offset.

        Pieces are numbered by length, then within it; ``first_number`` has each length's first.
        """
        taken, rows, sequence = first_number.copy(), [], 0
        for groups in self.groups:
            for count, runs in groups:
                offset = 0
                for length, times in runs:
                    rows.append((taken[length], sequence, times, offset))
                    taken[length] += count * times
                    offset += length * times
                sequence += count
        rows.sort()
        columns = zip(*rows, strict=True) if rows else ([], [], [], [])
        return tuple(np.array(column, np.int64) for column in columns)


def plan_sequences(counts: np.ndarray, capacity: int) -> Plan:
    """Plan for ``counts[length]`` pieces of each length."""
    plan, left = Plan(capacity), counts.copy()
    plan.match_large(left)
    for length in range(capacity // 3, 0, -1):
        plan.fit_small(length, int(left[length]))
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have a ``length`` from 1 to the capacity."""
    pieces = cut(pieces)
    histogram = cut(pieces.groupBy("length").agg(F.count("*").alias("n_rows")))
    counts = np.zeros(capacity + 1, np.int64)
    for row in histogram.collect():  # one row per length
        counts[row["length"]] = row["n_rows"]
    first_number = np.concatenate([[0], np.cumsum(counts)[:-1]])
    starts, sequences, times, offsets = plan_sequences(counts, capacity).intervals(first_number)

    @pandas_udf(StructType([StructField(name, LongType()) for name in ("sequence_id", "offset")]))
    def place(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        length = lengths.to_numpy()
        number = numbers.to_numpy() + first_number[length]
        at = np.searchsorted(starts, number, side="right") - 1
        ahead = number - starts[at]
        return pd.DataFrame(
            {
                "sequence_id": sequences[at] + ahead // times[at],
                "offset": offsets[at] + ahead % times[at] * length,
            }
        )

    # At most one row per length: small, whatever the input.
    sized = pieces.join(F.broadcast(histogram), "length")
    ranked = numbered(sized, ["length"], "n_rows", "number")
    return ranked.withColumn("place", place("length", "number")).select(
        *pieces.columns, "place.sequence_id", "place.offset"
    )


def best_fit_packing(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    capacity: int = CAPACITY,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their places; with ``keep_ids`` also their ids."""
    return pack(tokenised_pieces(docs, doc_id, text, vocabulary, capacity, keep_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from pieces with ids: ``sequence_id`` and its ``ids``.

    A sequence has at most as many ids as the capacity, so the lists are small.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda part: part["ids"])).alias("ids")
    )
