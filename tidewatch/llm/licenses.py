"""License scan with ordered signature rules (operator 7).

A few keywords decide whether a text is looked at; rules then run whose own keywords occur. Keywords
are single words that every match has, so they lose none. Where
detections overlap, the one of higher priority, then the longer, then the earlier rule stays, and
what lies within the interval of a detection that stayed goes. Three base phrases are looked for
besides, as consecutive words, in every text; their places and labels are always reported.

Defined cases: a NULL text is an empty one, with no words and score 0; no label is an empty string;
repeated rows get a result each; an empty table gives an empty result; other columns of the input
are kept.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tidewatch.llm.common import small_batches
from tidewatch.llm.license_rules import GATE, rules

PHRASES = (
    ("mit", (b"mit", b"license")),
    ("apache", (b"apache", b"license")),
    ("gpl", (b"general", b"public", b"license")),
)
PHRASE_SCORE = 0.6
#: Bytes of words, after lower-casing: digits, letters and all that is not ASCII.
IS_WORD = np.array([chr(i).isalnum() if i < 128 else True for i in range(256)])
GAP = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
EDGE = rb"[0-9a-z\x80-\xff]"
BASE = [
    (label, re.compile(rb"(?<!" + EDGE + rb")" + GAP.join(words) + rb"(?!" + EDGE + rb")"))
    for label, words in PHRASES
]
SCHEMA = StructType(
    [
        StructField("n_words", LongType()),
        StructField("place_words", ArrayType(LongType())),
        StructField("place_labels", ArrayType(StringType())),
        StructField("rules", ArrayType(StringType())),
        StructField("labels", ArrayType(StringType())),
        StructField("starts", ArrayType(LongType())),
        StructField("ends", ArrayType(LongType())),
        StructField("scores", ArrayType(DoubleType())),
    ]
)


def base_places(data: bytes) -> tuple[int, list[tuple[int, str]]]:
    """Number of words, and for each place of a phrase its first word and label."""
    mark = IS_WORD[np.frombuffer(data, np.uint8)]
    starts = mark.copy()
    starts[1:] &= ~mark[:-1]
    found = []
    if b"license" in data:
        for label, pattern in BASE:
            found.extend((match.start(), label) for match in pattern.finditer(data))
    if not found:
        return int(np.count_nonzero(starts)), []
    offsets = np.flatnonzero(starts)
    places = [(int(np.searchsorted(offsets, start)), label) for start, label in found]
    return len(offsets), sorted(places)


class Reach:
    """The furthest end of intervals that start at or before a place, by a tree over known starts."""

    def __init__(self, starts: Iterable[int]) -> None:
        self.starts = sorted(set(starts))
        self.tree = [-1] * (len(self.starts) + 1)

    def furthest(self, start: int) -> int:
        place, end = bisect_right(self.starts, start), -1
        while place:
            end = max(end, self.tree[place])
            place &= place - 1
        return end

    def add(self, start: int, end: int) -> None:
        place = bisect_right(self.starts, start)
        while place < len(self.tree):
            self.tree[place] = max(self.tree[place], end)
            place += place & -place


def detections(text: str) -> list[tuple[int, int, int, float, str, str]]:
    """What rules find, without what lies within a detection that ranks before it."""
    if not any(keyword in text for keyword in GATE):
        return []
    has = cache(text.__contains__)
    found = []
    for number, rule in enumerate(rules()):
        if any(all(map(has, words)) for words in rule.keywords):
            found.extend(
                (-rule.priority, m.start() - m.end(), number, m.start(), m.end(), rule)
                for m in rule.pattern.finditer(text)
            )
    reach = Reach(row[3] for row in found)
    result = []
    for _, _, number, start, end, rule in sorted(found, key=lambda row: row[:4]):
        # What lies within a suppressed detection lies within the one that suppressed it.
        if reach.furthest(start) < end:
            result.append((start, end, number, rule.score, rule.label, rule.name))
            reach.add(start, end)
    return sorted(result)


def scan_text(text: str | None) -> tuple:
    data = (text or "").encode().lower()
    n_words, places = base_places(data)
    found = detections(data.decode())
    return (
        n_words,
        [word for word, _ in places],
        [label for _, label in places],
        [row[5] for row in found],
        [row[4] for row in found],
        [row[0] for row in found],
        [row[1] for row in found],
        [row[3] for row in found],
    )


@pandas_udf(SCHEMA)
def scan_udf(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for series in texts:
        yield pd.DataFrame([scan_text(text) for text in series], columns=SCHEMA.names)


def scan(docs: DataFrame, text: str = "text", into: str = "license_scan") -> DataFrame:
    """Documents with the struct ``into``: words, places of base phrases, and detections.

    The arrays ``rules``, ``labels``, ``starts``, ``ends`` (code points) and ``scores`` run side by
    side, one entry per detection.
    """
    small_batches(docs.sparkSession)
    return docs.withColumn(into, scan_udf(docs[text]))


def label_list(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def score(found: Column) -> Column:
    """Best score of the detections; a base phrase alone counts as much as a weak rule."""
    phrase = F.when(F.size(found["place_words"]) > 0, PHRASE_SCORE).otherwise(0.0)
    return F.greatest(phrase, F.coalesce(F.array_max(found["scores"]), F.lit(0.0)))
