"""Private data: fixed patterns, and information-theoretic sanitisation of what reveals them
(operator 10).

Patterns find e-mail addresses, IP addresses, card and phone numbers. Each different value is a
protected entity. A term beside an entity may reveal it too: how strongly, the corpus tells. With
the information content IC(e) = -log p(e) of an entity and the mutual information
PMI(t, e) = log(p(t, e) / (p(t) p(e))), a term discloses PMI / IC of the entity: all of it if the
term comes with no other text. Probabilities are shares of documents, and a pair is in every
document that holds both, however far apart. One of the contexts that hold a pair is left out of
p(t, e) (smoothing: of n contexts with the pair, n - 1 count), so a pair in one context only says
nothing about the term: once the entity is sanitised there, no other text links the two. Texts that
share wording are one context of an entity, so copies, edited copies and texts around one passage
count once: texts with one of ``SKETCH`` min-hashes of their shingles of ``SHINGLE`` words in common are
linked, and what is connected is one context. A term that discloses ``MAX_DISCLOSURE`` or more of any
entity is sanitised at every occurrence in every document; removed if it discloses nearly all, else
generalised to its kind.

Documents are counted over the whole corpus. Entities in one context only have no pairs to count.
Pairs that cannot reach ``MAX_DISCLOSURE`` because the term is too frequent are not shuffled: PMI / IC
is at most what p(t, e) = p(e) gives, so a term must be in at most n(e)^m * N^(1 - m) of N documents,
m being MAX_DISCLOSURE. Frequent terms and entities, in one of ``FREQUENT`` documents or more, are
broadcast for that: at most FREQUENT times the mean number of different terms of a document, whatever
the corpus. Terms are looked for by a bitmap of fixed size that cannot miss one, and then exactly.

Defined cases: a NULL or empty text has no spans and stays as it is; equal texts share their spans;
repeated rows and NULL ids get a result each; an empty table gives an empty result; other columns of
the input are kept.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidewatch.llm.common import cut, small_batches
from tidewatch.llm.components import connected

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
FREQUENT = 500
MAX_DISCLOSURE = 0.8
REMOVE_FROM = 0.95
#: Bits of the candidate bitmap: 2 MB, whatever the corpus.
BITMAP_BITS = 1 << 24
BUCKET_BITS = 32_768
#: Of two texts that share a fifth of their shingles, some hash is the same in 999 of 1,000 cases.
SKETCH = 32
SHINGLE = 5

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
WORD = re.compile(r"[^\W_]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses; from each @ back, so that long runs of letters cost no more."""
    place = 0
    while (at := text.find("@", place)) >= 0:
        start = at
        while start > place and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        place = domain.end() if domain else at + 1


def is_card(digits: str) -> bool:
    if not 12 <= len(digits) <= 19:
        return False
    numbers = [int(digit) for digit in reversed(digits)]
    doubled = (2 * n - 9 if n > 4 else 2 * n for n in numbers[1::2])
    return (sum(numbers[0::2]) + sum(doubled)) % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of each kind's own matches, in order; kinds may overlap."""
    if not text:
        return []
    found = [(start, 0, end) for start, end in emails(text)]
    if not DIGIT.search(text):
        return sorted(found)
    for match in IP.finditer(text):
        parts = [part.lstrip("0") for part in match[0].split(".")]
        if all(len(part) < 4 and int(part or "0") <= 255 for part in parts):
            found.append((match.start(), 1, match.end()))
    for match in CARD.finditer(text):
        if is_card(match[0].replace(" ", "").replace("-", "")):
            found.append((match.start(), 2, match.end()))
    for match in PHONE.finditer(text):
        if 9 <= sum("0" <= char <= "9" for char in match[0]) <= 15:
            found.append((match.start(), 3, match.end()))
    return sorted(found)


def value_of(kind: int, text: str) -> str:
    """The entity: an address as it is in lower case, a number by its digits."""
    return f"{KINDS[kind]}:" + (text.lower() if kind < 2 else "".join(DIGIT.findall(text)))


def free_words(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Places of the words that lie in no span."""
    ahead, last = 0, 0
    for match in WORD.finditer(text):
        start, end = match.span()
        while ahead < len(spans) and spans[ahead][0] < end:
            last = max(last, spans[ahead][2])
            ahead += 1
        if start >= last:
            yield start, end


SPANS = StructType(
    [
        StructField("kinds", ArrayType(LongType())),
        StructField("starts", ArrayType(LongType())),
        StructField("ends", ArrayType(LongType())),
        StructField("values", ArrayType(StringType())),
        StructField("base_sha256", StringType()),
        # Different words of the document outside the spans, and min-hashes of their sequence; none
        # without spans.
        StructField("terms", ArrayType(StringType())),
        StructField("sketch", ArrayType(LongType())),
    ]
)


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def mixed_bits(numbers: np.ndarray) -> np.ndarray:
    """Each 64-bit number with all its bits mixed."""
    numbers = (numbers ^ (numbers >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return numbers ^ (numbers >> np.uint64(29))


def sketch(words: list[str]) -> list[int]:
    """Min-hashes of the shingles of a sequence of words; a short one is one shingle."""
    hashes = mixed_bits(np.array([zlib.crc32(word.encode()) for word in words], np.uint64))
    size = min(SHINGLE, len(words))
    shingles = np.zeros(len(words) - size + 1, np.uint64)
    for place in range(size):
        shingles = mixed_bits(shingles + hashes[place : place + len(shingles)] + np.uint64(1))
    seeds = mixed_bits(np.arange(1, SKETCH + 1, dtype=np.uint64))
    return [int(mixed_bits(shingles ^ seed).min().astype(np.int64)) for seed in seeds]


def find_spans(text: str | None) -> tuple:
    spans = base_spans(text)
    words = [text[start:end].lower() for start, end in free_words(text, spans)] if spans else []
    values = [value_of(kind, text[start:end]) for start, kind, end in spans]
    return (
        [kind for _, kind, _ in spans],
        [start for start, _, _ in spans],
        [end for _, _, end in spans],
        values,
        hashlib.sha256(span_text(spans).encode()).hexdigest(),
        list(set(words)),
        sketch(words) if spans else [],
    )


@pandas_udf(SPANS)
def spans_udf(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for series in texts:
        yield pd.DataFrame([find_spans(text) for text in series], columns=SPANS.names)


def text_key(text: Column) -> Column:
    """Identifies a text."""
    return F.md5(F.coalesce(text, F.lit("")))


def term_bitmap(candidates: DataFrame) -> bytes:
    """Bits of the hashes of all terms in the column ``term``."""
    # Numbers from 1 on: bucket n then holds the 32,768 numbers from (n - 1) * 32,768 + 1 on.
    number = (F.crc32("term") % BITMAP_BITS) + 1
    parts = (
        candidates.groupBy(F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
        .collect()  # at most 512 rows of 4 KB
    )
    bitmap = np.zeros((BITMAP_BITS // BUCKET_BITS, BUCKET_BITS // 8), np.uint8)
    for row in parts:
        bitmap[row["bucket"] - 1] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return bitmap.tobytes()


class Wanted:
    """Which terms may be in a bitmap."""

    def __init__(self, bitmap: bytes) -> None:
        self.may_be = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little")
        self.known: dict[str, bool] = {}

    def __call__(self, term: str) -> bool:
        wanted = self.known.get(term)
        if wanted is None:
            wanted = bool(self.may_be[zlib.crc32(term.encode()) % BITMAP_BITS])
            if len(self.known) < 300_000:
                self.known[term] = wanted
        return wanted


def document_frequencies(docs: DataFrame, text: str, candidates: DataFrame) -> DataFrame:
    """Documents that hold each term, exact for all candidates: (term, term_docs)."""
    shared = docs.sparkSession.sparkContext.broadcast(term_bitmap(candidates))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = Wanted(shared.value)
        counts: Counter[str] = Counter()
        for frame in batches:
            for whole in frame["whole"]:
                counts.update(filter(wanted, set(WORD.findall((whole or "").lower()))))
            if len(counts) > 200_000:
                yield pd.DataFrame(counts.items(), columns=["term", "n_docs"])
                counts.clear()
        yield pd.DataFrame(counts.items(), columns=["term", "n_docs"])

    partial = docs.select(docs[text].alias("whole")).mapInPandas(
        counted, "term string, n_docs long"
    )
    return partial.groupBy("term").agg(F.sum("n_docs").alias("term_docs"))


def contexts(holders: DataFrame) -> DataFrame:
    """Texts of the entities that have several contexts: (context_key, contexts).

    ``contexts`` has (value, context) for each such entity of the text.
    """
    held = cut(
        holders.select("text_key", F.explode(F.array_distinct("values")).alias("value"), "sketch")
    )
    repeated = held.groupBy("value").agg(F.count("*").alias("texts")).where("texts > 1")
    several = cut(
        held.join(repeated.select("value"), "value").withColumn(
            "node", F.xxhash64("value", "text_key")
        )
    )
    # Texts with an equal hash are linked with the first of them, not with each other.
    hashes = several.select("value", "node", F.posexplode("sketch").alias("hash", "shingle"))
    shared = ["value", "hash", "shingle"]
    first = hashes.groupBy(*shared).agg(F.min("node").alias("first"))
    links = hashes.join(first, shared).where("node <> first")
    roots = connected(links.select(F.col("node").alias("a"), F.col("first").alias("b")))
    placed = cut(
        several.join(roots, "node", "left").select(
            "text_key", "value", F.coalesce("root", "node").alias("context")
        )
    )
    apart = (
        placed.select("value", "context")
        .distinct()
        .groupBy("value")
        .agg(F.count("*").alias("n_contexts"))
        .where("n_contexts > 1")
    )
    return (
        placed.join(apart.select("value"), "value")
        .groupBy(F.col("text_key").alias("context_key"))
        .agg(F.collect_list(F.struct("value", "context")).alias("contexts"))
    )


def pair_counts(holders: DataFrame, terms: DataFrame, entities: DataFrame, total: int) -> DataFrame:
    """Documents and contexts that hold both: (value, term, pair_docs, n_contexts).

    ``holders`` has ``contexts``, ``terms`` and ``copies`` by text. Pairs whose term is too frequent
    to reach MAX_DISCLOSURE are left out.
    """
    least = total / FREQUENT
    frequent_terms = dict(terms.where(F.col("term_docs") >= least).toLocalIterator())
    frequent_values = dict(entities.where(F.col("value_docs") >= least).toLocalIterator())
    shared = holders.sparkSession.sparkContext.broadcast((frequent_terms, frequent_values))
    names = ["value", "term", "context", "pair_docs"]

    def rows(counts: Counter[tuple[str, str, int]]) -> pd.DataFrame:
        return pd.DataFrame([(*key, n) for key, n in counts.items()], columns=names)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often, values_often = shared.value
        counts: Counter[tuple[str, str, int]] = Counter()
        for frame in batches:
            for held, terms, copies in zip(
                frame["contexts"], frame["terms"], frame["copies"], strict=True
            ):
                for entity in held:
                    value, context = entity["value"], entity["context"]
                    most = values_often.get(value, least) ** MAX_DISCLOSURE * total ** (1 - MAX_DISCLOSURE)
                    for term in terms:
                        # A little more, as rounding must not lose a pair.
                        if often.get(term, 0) <= most * 1.000001:
                            counts[value, term, context] += copies
                    # Within a text too: a list of contacts has very many pairs.
                    if len(counts) > 200_000:
                        yield rows(counts)
                        counts.clear()
        yield rows(counts)

    partial = holders.select("contexts", "terms", "copies").mapInPandas(
        counted, "value string, term string, context long, pair_docs long"
    )
    # By context first: a frequent pair has many, and no task sees them all.
    by_context = partial.groupBy("value", "term", "context").agg(F.sum("pair_docs").alias("pair_docs"))
    return by_context.groupBy("value", "term").agg(
        F.sum("pair_docs").alias("pair_docs"), F.count("*").alias("n_contexts")
    )


def disclosures(docs: DataFrame, found: DataFrame, text: str) -> DataFrame:
    """Pairs of entity and term that disclose too much: (value, term, disclosure).

    ``found`` has one row per document: ``text_key`` and the struct ``spans``.
    """
    total = max(found.count(), 1)
    with_spans = found.where(F.size("spans.kinds") > 0)
    # Equal texts have equal spans and terms.
    holders = cut(
        with_spans.groupBy("text_key").agg(
            F.any_value("spans.values").alias("values"),
            F.any_value("spans.terms").alias("terms"),
            F.any_value("spans.sketch").alias("sketch"),
            F.count("*").alias("copies"),
        )
    )
    entities = cut(
        holders.select(F.explode(F.array_distinct("values")).alias("value"), "copies")
        .groupBy("value")
        .agg(F.sum("copies").alias("value_docs"))
    )
    several = contexts(holders)
    holders = cut(
        holders.join(several, holders["text_key"] == several["context_key"]).select(
            "contexts", "terms", "copies"
        )
    )
    terms = cut(
        document_frequencies(docs, text, holders.select(F.explode("terms").alias("term")))
    )
    # A pair in one context only has nothing left when that context is left out.
    pairs = cut(pair_counts(holders, terms, entities, total).where("n_contexts > 1"))
    joined = pairs.join(terms, "term").join(entities, "value")
    count = F.lit(float(total))
    both = F.col("pair_docs") * (F.col("n_contexts") - 1) / F.col("n_contexts")
    pmi = F.log(both * count / (F.col("term_docs") * F.col("value_docs")))
    content = F.log(count / F.col("value_docs"))
    share = F.when(content > 0, pmi / content).otherwise(0.0)
    return joined.select("value", "term", share.alias("disclosure")).where(
        F.col("disclosure") >= MAX_DISCLOSURE
    )


def term_places(docs: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """Where terms may stand outside base spans: (text_key, term, start, end)."""
    shared = docs.sparkSession.sparkContext.broadcast(term_bitmap(terms))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = Wanted(shared.value)
        for frame in batches:
            rows = []
            for key, whole in zip(frame["text_key"], frame["whole"], strict=True):
                if not whole or not any(map(wanted, set(WORD.findall(whole.lower())))):
                    continue
                for start, end in free_words(whole, base_spans(whole)):
                    term = whole[start:end].lower()
                    if wanted(term):
                        rows.append((key, term, start, end))
            yield pd.DataFrame(rows, columns=["text_key", "term", "start", "end"])

    return docs.select(text_key(docs[text]).alias("text_key"), docs[text].alias("whole")).mapInPandas(
        placed, "text_key string, term string, start long, end long"
    )


def added_spans(docs: DataFrame, found: DataFrame, text: str) -> DataFrame:
    """Spans of revealing terms by text: ``added_key`` and ``added``, an array of structs."""
    revealing = disclosures(docs, found, text).groupBy("term")
    revealing = cut(revealing.agg(F.max("disclosure").alias("disclosure")))
    places = term_places(docs, text, revealing).distinct()
    return (
        places.join(revealing, "term")
        .groupBy(F.col("text_key").alias("added_key"))
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "disclosure"))).alias("added"))
    )


def find_private_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its id as ``doc_id``, ``spans`` (base) and ``added`` (revealing terms, or NULL)."""
    small_batches(docs.sparkSession)
    found = cut(
        docs.select(
            docs[doc_id].alias("doc_id"),
            text_key(docs[text]).alias("text_key"),
            spans_udf(docs[text]).alias("spans"),
        )
    )
    added = cut(added_spans(docs, found, text))
    return found.join(added, found["text_key"] == added["added_key"], "left").select(
        "doc_id", "spans", "added"
    )


def sanitise(text: str | None, added: list | None) -> str | None:
    """The text with entities named by kind, and revealing terms generalised or removed."""
    if not text:
        return text
    parts = [(start, end, f"[{KINDS[kind].upper()}]") for start, kind, end in base_spans(text)]
    for span in [] if added is None else added:
        word = text[span["start"] : span["end"]]
        general = "[NUMBER]" if word.isdigit() else "[WORD]"
        parts.append((span["start"], span["end"], "" if span["disclosure"] >= REMOVE_FROM else general))
    out, place = [], 0
    for start, end, name in sorted(parts, key=lambda part: (part[0], -part[1])):
        if end <= place:
            continue
        if start >= place:
            out.append(text[place:start])
            out.append(name)
        place = end
    out.append(text[place:])
    return "".join(out)


@pandas_udf(StringType())
def sanitise_udf(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for texts, added in batches:
        yield pd.Series(
            [sanitise(*row) for row in zip(texts, added, strict=True)], dtype=object
        )


def sanitised(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents with their text sanitised, all other columns as they are."""
    small_batches(docs.sparkSession)
    found = cut(
        docs.select(text_key(docs[text]).alias("text_key"), spans_udf(docs[text]).alias("spans"))
    )
    added = cut(added_spans(docs, found, text))
    joined = docs.join(added, text_key(docs[text]) == added["added_key"], "left")
    return joined.select(
        *[
            sanitise_udf(docs[name], added["added"]).alias(name) if name == text else docs[name]
            for name in docs.columns
        ]
    )
