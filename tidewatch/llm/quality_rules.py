"""Host-level quality rules (operator 3).

Rules are judged per document, failures are counted per host, each host's failure rate is shrunk
towards the corpus by a beta prior fitted to all hosts, and the verdict on a host goes back to its
documents.

Defined cases: a NULL or empty text has no words and fails the base rule; a NULL host is a host of
its own; repeated rows each count and each get a result; an empty table gives an empty result;
other columns of the input are passed through untouched, under their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType, StructField, StructType

from tidewatch.llm.common import SPACES, cut, small_batches

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A document fails the symbol or line rule above these shares, and counts against its host.
MAX_SYMBOL_SHARE = 0.3
MAX_DUP_LINE_WORDS = 0.1
#: A host goes if its shrunk failure rate reaches this.
MAX_HOST_RATE = 0.5


def repeated_words(words: list[bytes]) -> int:
    """Words inside a five-word window that the text holds twice or more."""
    count = len(words)
    if count <= WINDOW:
        return 0
    number = dict.fromkeys(words)
    for i, word in enumerate(number):
        number[word] = i
    ids = np.fromiter(map(number.__getitem__, words), np.int64, count)
    size = len(number)
    if size**WINDOW < 2**63:
        keys = ids[: count - WINDOW + 1].copy()
        for i in range(1, WINDOW):
            keys = keys * size + ids[i : count - WINDOW + 1 + i]
    else:
        # Too many words for one number: number the pairs, then the fours.
        pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
        fours = np.unique(pairs[:-2] * count + pairs[2:], return_inverse=True)[1]
        keys = fours[:-1] * size + ids[4:]
    ordered = np.sort(keys)
    again = ordered[1:] == ordered[:-1]
    if not again.any():
        return 0
    twice = np.isin(keys, np.unique(ordered[1:][again]))
    return int(np.count_nonzero(np.convolve(twice, np.ones(WINDOW, np.int64))))


def text_metrics(text: str | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


@pandas_udf(StructType([StructField(name, LongType()) for name in METRICS]))
def metrics_of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for series in texts:
        rows = [text_metrics(text) for text in series]
        yield pd.DataFrame(rows, columns=METRICS, dtype="int64")


def base_failed(metrics: Column) -> Column:
    words = metrics["n_words"]
    return (words < MIN_WORDS) | (100 * metrics["n_repeat_words"] > MAX_REPEAT_PERCENT * words)


def any_rule_failed(metrics: Column) -> Column:
    words = metrics["n_words"]
    return (
        base_failed(metrics)
        | (metrics["n_symbols"] > MAX_SYMBOL_SHARE * words)
        | (metrics["n_dup_lines"] > MAX_DUP_LINE_WORDS * words)
    )


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Prior of the hosts' failure rates by moments: one row of sums decides it.

    Mean: the pooled rate. Strength: from the part of the variance that lies between hosts. With
    one host, or hosts that differ no more than chance, the prior is as strong as the bound allows.
    """
    total = hosts.agg(
        F.count("*").alias("k"),
        F.sum("n").alias("n"),
        F.sum("failed").alias("f"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
        F.sum(F.col("failed").cast("double") * F.col("failed") / F.col("n")).alias("ffn"),
    ).first()
    k, n, f = total["k"], total["n"] or 0, total["f"] or 0
    if n == 0:
        return 1.0, 1.0
    mean = f / n
    share = 0.0
    if k > 1 and n > k:
        between = (total["ffn"] - n * mean * mean) / (k - 1)
        within = (f - total["ffn"]) / (n - k)
        usual = (n - total["nn"] / n) / (k - 1)
        spread = between + (usual - 1) * within
        share = (between - within) / spread if spread > 0 else 0.0
    share = min(max(share, 1e-4), 0.9999)
    strength = 1 / share - 1
    return mean * strength, (1 - mean) * strength


def host_verdicts(scored: DataFrame, host: str, metrics: str) -> DataFrame:
    """One row per host: documents, failures, shrunk rate and whether the host goes."""
    hosts = cut(
        scored.groupBy(F.col(host).alias("verdict_host")).agg(
            F.count("*").alias("n"),
            F.count_if(any_rule_failed(F.col(metrics))).alias("failed"),
        )
    )
    alpha, beta = beta_prior(hosts)
    rate = (F.col("failed") + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))
    return hosts.withColumn("host_rate", rate).withColumn(
        "host_rejected", F.col("host_rate") >= MAX_HOST_RATE
    )


def measured(docs: DataFrame, text: str = "text", metrics: str = "quality_metrics") -> DataFrame:
    """Add the rules' counts as one struct column."""
    small_batches(docs.sparkSession)
    return docs.withColumn(metrics, metrics_of(docs[text]))


def with_verdicts(
    scored: DataFrame, host: str = "source", metrics: str = "quality_metrics"
) -> DataFrame:
    """Add to the counts, in the same struct, base_failed, host_rate and kept."""
    verdicts = host_verdicts(scored, host, metrics).select(
        "verdict_host", F.struct("host_rate", "host_rejected").alias("host_verdict")
    )
    joined = scored.alias("scored").join(
        verdicts.alias("of_host"),
        F.col(f"scored.`{host}`").eqNullSafe(F.col("of_host.verdict_host")),
    )
    own, of_host = F.col(f"scored.`{metrics}`"), F.col("of_host.host_verdict")
    failed = base_failed(own)
    verdict = own.withField("base_failed", failed).withField("host_rate", of_host["host_rate"])
    verdict = verdict.withField("kept", ~failed & ~of_host["host_rejected"])
    others = [F.col(f"scored.`{name}`") for name in scored.columns if name != metrics]
    return joined.select(*others, verdict.alias(metrics))


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    metrics: str = "quality_metrics",
) -> DataFrame:
    """Documents, unchanged, with the struct ``metrics`` added; it replaces a column of that name."""
    return with_verdicts(measured(docs, text, metrics), host, metrics)
