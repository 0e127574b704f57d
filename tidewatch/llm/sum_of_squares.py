"""Sum-of-squares online packing of documents into token windows (operator 11).

Documents become byte-level BPE ids and an end id, and meet windows of a fixed capacity one after the
other. What fills windows by itself is cut off in whole windows; the rest of a document, shorter than a
window, goes where the sum of the squared counts of partially filled windows, by fill level, comes out
smallest: into an open window of some level, or into a new one. A level array holds the counts, so a
decision is one vector subtraction and its minimum. Of equal choices the fullest window wins.

Packing online is a sequence of decisions, so documents are dealt by hash into lanes of about
``DOCS_PER_LANE``; a task reads a lane as a stream in hash order and keeps nothing but its open windows
(a few hundred, at most some per level). A full window goes out at once. At the end of a lane its open
windows are closed: the emptiest give their documents to the gaps of the fullest, cut where a gap ends.
So one window per lane has padding, whatever the lengths, and few documents are cut.

Nothing is collected. Lane and order follow from the rows alone, so a lost task is repeated alike.

Defined cases: a NULL or empty text is the end id alone; NULL ids and repeated rows are packed like
others (rows equal in id and text share a lane, which streams them); an empty table gives an empty
result; other columns of the input do not matter. Texts of any length are one row. Vocabularies may have
up to 65,536 ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tidewatch.llm.packing import VOCABULARY, token_ids

CAPACITY = 2048
END_ID = 1
DOCS_PER_LANE = 32_768
#: Ids that one batch of results holds at most, beyond a single row.
BATCH_IDS = 4_000_000
FAR = 1 << 40


@dataclass(frozen=True)
class Part:
    """Consecutive ids of one document."""

    doc_id: object
    start: int
    ids: np.ndarray
    doc_tokens: int

    def split(self, at: int) -> tuple[Part, Part]:
        left, right = self.ids[:at], self.ids[at:]
        return (
            Part(self.doc_id, self.start, left, self.doc_tokens),
            Part(self.doc_id, self.start + at, right, self.doc_tokens),
        )


@dataclass
class Window:
    fill: int = 0
    parts: list[Part] = field(default_factory=list)

    def put(self, part: Part) -> None:
        self.parts.append(part)
        self.fill += len(part.ids)


class Lane:
    """The open windows of one lane; methods return the windows that are done."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        #: Open windows by fill level; levels 0 and ``capacity`` stay 0.
        self.counts = np.zeros(capacity + 1, np.int64)
        #: The same, but far below 0 where there is no window to extend.
        self.sources = np.full(capacity + 1, -FAR)
        self.open: list[list[Window]] = [[] for _ in range(capacity + 1)]

    def level_for(self, size: int) -> int:
        """The level whose window takes ``size`` more ids; 0 for a new window.

        Moving a window from level h to h + size changes the sum by 2 * (counts[h + size] - counts[h])
        + 2, by 1 less if that fills it; a new window changes it by 2 * counts[size] + 1.
        """
        change = self.counts[size + 1 :] - self.sources[1 : self.capacity - size + 1]
        if not len(change):
            return 0
        level = len(change) - int(change[::-1].argmin())
        best = int(change[level - 1])
        fills = level + size == self.capacity
        new_is_better = best >= FAR // 2 or (not fills and self.counts[size] <= best)
        return 0 if new_is_better else level

    def _count(self, level: int, change: int) -> None:
        self.counts[level] += change
        self.sources[level] = self.counts[level] or -FAR

    def add(self, part: Part) -> list[Window]:
        """Place one document: whole windows of it, then its rest."""
        done = []
        while len(part.ids) >= self.capacity:
            first, part = part.split(self.capacity)
            done.append(Window(self.capacity, [first]))
        size = len(part.ids)
        if not size:
            return done
        level = self.level_for(size)
        window = self.open[level].pop() if level else Window()
        if level:
            self._count(level, -1)
        window.put(part)
        if window.fill == self.capacity:
            return [*done, window]
        self.open[window.fill].append(window)
        self._count(window.fill, 1)
        return done

    def close(self) -> list[Window]:
        """Open windows at the end: the emptiest are dealt out into the gaps of the fullest."""
        left = [window for windows in reversed(self.open) for window in windows]
        last = len(left) - 1
        for place, window in enumerate(left):
            while place < last and window.fill < self.capacity:
                gap, donor = self.capacity - window.fill, left[last]
                part = donor.parts.pop()
                if len(part.ids) > gap:
                    stays, part = part.split(len(part.ids) - gap)
                    donor.parts.append(stays)
                window.put(part)
                donor.fill -= len(part.ids)
                last -= not donor.fill
        return left[: last + 1]


def ids_udf(vocabulary: str):
    def stored(text: str | None) -> bytes:
        ids = token_ids(text, vocabulary)
        ids[-1] = END_ID
        if ids.max() > 0xFFFF:
            raise ValueError(f"vocabulary {vocabulary!r} has ids above 65,535")
        return ids.astype("<u2").tobytes()

    @pandas_udf(BinaryType())
    def tokenised(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            yield pd.Series([stored(text) for text in series], dtype=object)

    return tokenised


class Results:
    """Rows of finished windows, handed out in batches."""

    NAMES = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")

    def __init__(self, id_type: pa.DataType) -> None:
        number = pa.int64()
        types = (id_type, number, number, pa.binary(), number, number, number)
        self.schema = pa.schema(list(zip(self.NAMES, types, strict=True)))
        self.rows: list[tuple] = []
        self.n_ids = 0

    def add(self, sequence: int, window: Window) -> None:
        offset = 0
        for part in window.parts:
            n, ids = len(part.ids), part.ids.astype("<u4").tobytes()
            self.rows.append((part.doc_id, part.start, n, ids, part.doc_tokens, sequence, offset))
            offset += n
        self.n_ids += offset

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [()] * len(self.NAMES)
        arrays = [pa.array(list(c), f.type) for c, f in zip(columns, self.schema, strict=True)]
        self.rows, self.n_ids = [], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def pack_lanes(capacity: int):
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, number, sequence, results = None, None, 0, None

        def out(windows: list[Window]) -> None:
            nonlocal sequence
            for window in windows:
                results.add((number << 32) + sequence, window)
                sequence += 1

        for batch in batches:
            results = results or Results(batch.schema.field("doc_id").type)
            columns = [batch.column(name).to_pylist() for name in ("lane", "doc_id", "ids")]
            for next_number, doc_id, stored in zip(*columns, strict=True):
                if next_number != number:
                    if lane is not None:
                        out(lane.close())
                    lane, number, sequence = Lane(capacity), next_number, 0
                ids = np.frombuffer(stored, "<u2")
                out(lane.add(Part(doc_id, 0, ids, len(ids))))
                if results.n_ids > BATCH_IDS:
                    yield results.batch()
        if lane is not None:
            out(lane.close())
            yield results.batch()

    return packed


def sum_of_squares_packing(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    capacity: int = CAPACITY,
    docs_per_lane: int = DOCS_PER_LANE,
) -> DataFrame:
    """Pieces of all documents with their places.

    Per piece ``doc_id, start, length, ids`` (little-endian unsigned 32-bit), ``doc_tokens,
    sequence_id, offset``. Documents are counted first, which a Parquet table answers from its footers.
    """
    lanes = max(1, -(-docs.count() // docs_per_lane))
    tokenised = docs.select(docs[doc_id].alias("doc_id"), ids_udf(vocabulary)(docs[text]).alias("ids"))
    dealt = tokenised.withColumn("turn", F.xxhash64("doc_id", "ids")).withColumn(
        "lane", F.pmod("turn", F.lit(lanes))
    )
    ordered = dealt.repartition("lane").sortWithinPartitions("lane", "turn", "doc_id", "ids")
    fields = [StructField("doc_id", tokenised.schema["doc_id"].dataType)]
    fields += [
        StructField(name, BinaryType() if name == "ids" else LongType()) for name in Results.NAMES[1:]
    ]
    return ordered.select("lane", "doc_id", "ids").mapInArrow(pack_lanes(capacity), StructType(fields))


def windows(packed: DataFrame) -> DataFrame:
    """The windows themselves, from the pieces: ``sequence_id``, its ``n_ids`` and its ``ids``.

    A window has at most as many ids as the capacity, so the lists are small.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda ids, part: F.concat(ids, part["ids"]))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_ids"), joined.alias("ids")
    )
