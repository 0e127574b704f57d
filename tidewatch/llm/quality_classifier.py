"""Quality by voting of the nearest labelled documents in a latent semantic space (operator 6).

A text's terms are its words, in lower case and hashed to ``WORD_TERMS`` numbers; besides them, hashed
to ``SHAPE_TERMS`` numbers, word shapes (letters, capitals, digits and marks as they follow one
another) and grades of how far it repeats words, neighbours and lines. Words of scripts written
without spaces count by their pairs of characters. Language, source and id are no input. Counts are
weighted by log tf or shares, and idf; words and shapes have half of a text's weight each. A singular
value decomposition of the labelled documents' term matrix gives the latent space of ``DIMENSIONS``.
Every document is compared, by exact cosine, with all labelled vectors, in blocks; of the nearest
``NEIGHBOURS`` each votes for its label with a weight that grows with its similarity and evens out the
share of its label in the sample.

The model is fitted on at most ``SAMPLE_PER_LABEL`` labelled documents per label, those whose id's
MD5 is lowest; whatever the corpus, the broadcast vectors have at most 2 * SAMPLE_PER_LABEL *
DIMENSIONS floats, and the basis (SHAPE_TERMS + WORD_TERMS) * DIMENSIONS. Documents are held out by the CRC of their id and never learnt from.

Defined cases: a NULL or empty text has terms of its own (no words) and is scored like any other;
NULL labels and labels of NULL ids are not learnt from; contradicting labels of an id count as their
mean, rounded up at a half; without any usable label every score is 0.5; repeated rows get a result
each; an empty table gives an empty result; other columns of the input are kept.
"""

from __future__ import annotations

import math
import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from tidewatch.llm.common import cut, small_batches

SHAPE_TERMS = 4096
WORD_TERMS = 32_768
TERMS = SHAPE_TERMS + WORD_TERMS
DIMENSIONS = 32
#: More directions than wanted, and rounds, of the iteration that finds the strongest ones.
SPARE_DIMENSIONS = 32
ROUNDS = 12
SAMPLE_PER_LABEL = 2048
NEIGHBOURS = 25
#: A neighbour's weight is its similarity to this power.
SHARPNESS = 8
THRESHOLD = 0.7
HELD_OUT = 2
BLOCK = 512

SHAPES = bytes(
    ord("a") if i > 127 or chr(i).islower() else ord("A") if chr(i).isupper() else ord("9") if chr(i).isdigit() else i
    for i in range(256)
)
RUN = re.compile(rb"(.)\1+", re.DOTALL)
WORD = re.compile(r"[^\W_]+")
#: Thai, Lao, Burmese, Khmer, kana and ideographs: written without spaces.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")
TERM_FIELDS = StructType(
    [
        StructField("terms", ArrayType(IntegerType())),
        StructField("weights", ArrayType(FloatType())),
    ]
)


class Known:
    """Numbers of the shapes and words that a task has met."""

    def __init__(self) -> None:
        self.shapes: dict[bytes, int] = {}
        self.words: dict[str, tuple[int, ...]] = {}


def term_number(term: bytes, known: dict[bytes, int]) -> int:
    number = known.get(term)
    if number is None:
        number = zlib.crc32(RUN.sub(rb"\1", term)) % SHAPE_TERMS
        if len(known) < 100_000:
            known[term] = number
    return number


def word_numbers(word: str, known: dict[str, tuple[int, ...]]) -> tuple[int, ...]:
    numbers = known.get(word)
    if numbers is None:
        unspaced = len(word) > 2 and not word.isascii() and UNSPACED.search(word)
        parts = [word[i : i + 2] for i in range(len(word) - 1)] if unspaced else [word]
        numbers = tuple(SHAPE_TERMS + zlib.crc32(part.encode()) % WORD_TERMS for part in parts)
        if len(known) < 100_000:
            known[word] = numbers
    return numbers


def word_weights(text: str, known: dict[str, tuple[int, ...]]) -> dict[int, float]:
    """Log tf of a text's words."""
    counts: Counter[int] = Counter()
    for word, count in Counter(WORD.findall(text.lower())).items():
        for number in word_numbers(word, known):
            counts[number] += count
    return {number: 1 + math.log(count) for number, count in counts.items()}


def grade(name: bytes, share: float) -> tuple[int, float]:
    """A pseudo-term for a share from 0 to 1: eight grades, each a term of its own."""
    return zlib.crc32(name + b"%d" % int(8 * min(max(share, 0.0), 0.999))) % SHAPE_TERMS, 1.0


def document_terms(text: str | None, known: Known) -> tuple[list[int], list[float]]:
    """Numbers and weights of a text's terms; shapes by their share of all words, words by log tf."""
    data = (text or "").encode()
    words = data.split()
    total = len(words)
    if not total:
        return [zlib.crc32(b"no words") % SHAPE_TERMS], [1.0]
    weights: Counter[int] = Counter()
    for shape, count in Counter(data.translate(SHAPES).split()).items():
        weights[term_number(shape, known.shapes)] += count
    found = {term: float(np.sqrt(count / total)) for term, count in weights.items()}
    lines = [line for line in data.split(b"\n") if line.strip()]
    follows = sum(map(operator.eq, words, words[1:]))
    distinct = len(set(words))
    grades = (
        grade(b"same as before ", follows / total),
        # Distinct words grow as a root of all words; against that, how few are there?
        grade(b"distinct ", distinct / (total**0.8) / 2),
        grade(b"same line ", 1 - len(set(lines)) / len(lines)),
        grade(b"short lines ", min(1.0, len(lines) / total)),
        grade(b"length ", np.log10(total) / 5),
    )
    for term, weight in grades:
        found[term] = found.get(term, 0.0) + weight / 2
    found |= word_weights(text, known.words)
    return list(found), list(found.values())


@pandas_udf(TERM_FIELDS)
def terms_udf(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    known = Known()
    for series in texts:
        rows = [document_terms(text, known) for text in series]
        yield pd.DataFrame(rows, columns=TERM_FIELDS.names)


@dataclass(frozen=True)
class Model:
    """Term weights, basis of the latent space, labelled vectors in it, and their votes."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    balance: np.ndarray
    prior: float

    def project(self, rows: list[tuple]) -> np.ndarray:
        out = np.zeros((len(rows), self.basis.shape[1]), np.float32)
        for i, (terms, weights) in enumerate(rows):
            at, values = weighted(terms, weights, self.idf)
            out[i] = values @ self.basis[at]
        return normal(out)

    def scores(self, rows: list[tuple]) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(rows), self.prior)
        out = np.empty(len(rows))
        near = min(NEIGHBOURS, len(self.vectors))
        for start in range(0, len(rows), BLOCK):
            cosine = self.project(rows[start : start + BLOCK]) @ self.vectors.T
            nearest = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
            similar = np.clip(np.take_along_axis(cosine, nearest, axis=1), 0, 1)
            weight = similar.astype(np.float64) ** SHARPNESS * self.balance[nearest]
            total = weight.sum(axis=1)
            votes = (weight * self.labels[nearest]).sum(axis=1)
            out[start : start + BLOCK] = np.where(
                total > 0, votes / np.where(total > 0, total, 1), self.prior
            )
        return np.clip(out, 0, 1)


def normal(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(size > 0, size, 1)


def weighted(terms: list[int], weights: list[float], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms and their weights times idf; shapes and words have the length 1 each."""
    at = np.asarray(terms, np.int64)
    values = np.asarray(weights, np.float32) * idf[at]
    for part in (at < SHAPE_TERMS, at >= SHAPE_TERMS):
        size = np.linalg.norm(values[part])
        if size > 0:
            values[part] /= size
    return at, values


def strongest_directions(rows: list[tuple[np.ndarray, np.ndarray]], n_terms: int) -> np.ndarray:
    """Right singular vectors of a sparse matrix, strongest first, by subspace iteration."""
    wanted = min(DIMENSIONS, len(rows))
    space = np.random.default_rng(0).standard_normal((n_terms, min(DIMENSIONS + SPARE_DIMENSIONS, len(rows))))
    for _ in range(ROUNDS):
        product = np.zeros(space.shape)
        for at, values in rows:
            product[at] += np.outer(values, values @ space[at])
        space, _ = np.linalg.qr(product)
    seen = np.stack([values @ space[at] for at, values in rows])
    _, sizes, turned = np.linalg.svd(seen, full_matrices=False)
    return space @ turned[:wanted][sizes[:wanted] > 1e-9 * max(sizes[0], 1e-30)].T


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == HELD_OUT


def fit(sample: pd.DataFrame, shares: dict[int, int]) -> Model:
    """Model from the sampled terms and labels; ``shares`` counts all usable labels."""
    if not len(sample):
        empty = np.zeros((0, DIMENSIONS), np.float32)
        ones = np.ones(TERMS, np.float32)
        return Model(ones, np.zeros((TERMS, DIMENSIONS), np.float32), empty, ones[:0], ones[:0], 0.5)
    used = np.zeros(TERMS, np.int64)
    for terms in sample["terms"]:
        used[np.asarray(terms, np.int64)] += 1
    idf = np.log((1 + len(sample)) / (1 + used)).astype(np.float32) + 1
    rows = [weighted(*row, idf) for row in zip(sample["terms"], sample["weights"], strict=True)]
    present = np.flatnonzero(used)
    place = np.zeros(TERMS, np.int64)
    place[present] = np.arange(len(present))
    strongest = strongest_directions([(place[at], values) for at, values in rows], len(present))
    basis = np.zeros((TERMS, DIMENSIONS), np.float32)
    basis[present, : strongest.shape[1]] = strongest
    labels = sample["label"].to_numpy(np.float64)
    sampled = Counter(labels.tolist())
    balance = np.array([shares[int(label)] / sampled[label] for label in labels])
    known = normal(np.stack([values @ basis[at] for at, values in rows])).astype(np.float32)
    prior = shares.get(1, 0) / sum(shares.values())
    return Model(idf, basis, known, labels, balance / balance.max(), prior)


def learn(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out."""
    usable = (
        labels.where(labels["doc_id"].isNotNull() & labels[label].isNotNull())
        .groupBy(labels["doc_id"].alias("label_id"))
        .agg((F.avg(labels[label]) >= 0.5).cast("int").alias("label"))
        .where(~is_held_out(F.col("label_id")))
    )
    usable = cut(usable)
    shares = {row["label"]: row["count"] for row in usable.groupBy("label").count().collect()}
    digest = F.md5(F.col("label_id").cast("string"))
    chosen = None
    for value in (0, 1):
        part = usable.where(F.col("label") == value).orderBy(digest, "label_id").limit(SAMPLE_PER_LABEL)
        chosen = part if chosen is None else chosen.union(part)
    # At most 2 * SAMPLE_PER_LABEL rows of two numbers.
    known = docs.select(docs[doc_id].alias("known_id"), docs[text].alias("known_text"))
    texts = known.join(F.broadcast(chosen), F.col("known_id") == F.col("label_id")).select(
        "label_id", "label", terms_udf(F.col("known_text")).alias("t")
    )
    # An id may have several rows; one of them is enough, the same at every run.
    one = texts.groupBy("label_id", "label").agg(F.min("t").alias("t"))
    sample = one.select("label_id", "label", "t.terms", "t.weights").toPandas()
    sample = sample.sort_values("label_id", ignore_index=True)
    return fit(sample, shares)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    into: str = "quality_score",
) -> DataFrame:
    """Documents with their score in the column ``into``, all other columns as they are."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, doc_id, text, label))

    @pandas_udf(DoubleType())
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Known()
        for series in texts:
            yield pd.Series(shared.value.scores([document_terms(t, known) for t in series]))

    return docs.withColumn(into, scored(docs[text]))
