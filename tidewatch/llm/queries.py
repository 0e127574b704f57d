"""The registered queries of the operators; thin, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import cut, table
from tidewatch.llm.fill_in_middle import fill_in_middle, restored
from tidewatch.llm.html_extraction import extract
from tidewatch.llm.licenses import label_list, scan, score
from tidewatch.llm.merkle import merkle_proofs
from tidewatch.llm.mixing import mix
from tidewatch.llm.packing import best_fit_packing
from tidewatch.llm.private_data import KINDS, TERM, find_private_data
from tidewatch.llm.quality_classifier import THRESHOLD, classify, is_held_out
from tidewatch.llm.quality_rules import METRICS, measured, with_verdicts
from tidewatch.llm.search import search
from tidewatch.llm.sharding import shard
from tidewatch.llm.simhash import hex_digits, near_duplicates
from tidewatch.llm.sum_of_squares import sum_of_squares_packing


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = F.col("main_text")
    return extract(pages).select(
        "page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars")
    )


def op2_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best documents for the whole text of every document whose id is divisible by 50."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search(docs, docs.where("doc_id % 50 = 0"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    judged = with_verdicts(cut(measured(docs).drop("text")))
    return judged.select(
        "doc_id",
        *[f"quality_metrics.{name}" for name in METRICS],
        "quality_metrics.base_failed",
        "quality_metrics.kept",
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target of each document's source and the words that the mix takes of it."""
    mixture = mix(table(spark, sf_dir, "documents"))
    return mixture.withColumns(
        {name: F.round(name, 9) for name in ("position", "second_position")}
    )


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, from labels of documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    score = F.col("quality_score")
    return classify(docs, labels).select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        score.alias("score"),
        (score >= THRESHOLD).cast("int").alias("predicted"),
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases, labels and score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = F.col("license_scan")
    base, words = found["place_labels"], found["place_words"]
    return scan(docs).select(
        "doc_id",
        found["n_words"].alias("n_words"),
        F.size(words).cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        label_list(base).alias("base_labels"),
        label_list(F.concat(base, found["labels"])).alias("labels"),
        score(found).alias("score"),
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of nearly equal bytes; equal texts stay together."""
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 tokens."""
    return best_fit_packing(table(spark, sf_dir, "documents"))


def op10_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of every document and those of terms that reveal them."""
    found = find_private_data(table(spark, sf_dir, "documents"))
    kinds = F.col("spans.kinds")
    base = F.transform(
        F.arrays_zip(
            F.col("spans.starts").alias("start"), kinds.alias("kind"), F.col("spans.ends").alias("end")
        ),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")),
    )
    added = F.transform(
        "added",
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(len(KINDS)).cast("long").alias("kind"), s["end"].alias("end")
        ),
    )
    names = F.array(*[F.lit(name) for name in (*KINDS, TERM)])
    spans = F.transform(
        F.array_sort(F.when(F.col("added").isNull(), base).otherwise(F.concat(base, added))),
        lambda s: F.concat_ws(
            ":", F.element_at(names, (s["kind"] + 1).cast("int")), s["start"], s["end"]
        ),
    )
    return found.select(
        "doc_id",
        *[
            (F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{name}")
            for i, name in enumerate(KINDS)
        ],
        "spans.base_sha256",
        F.array_join(spans, ",").alias("spans"),
    )


def op11_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in windows of 2048 tokens."""
    packed = sum_of_squares_packing(table(spark, sf_dir, "documents").select("doc_id", "text"))
    crc = F.crc32("ids").alias("ids_crc32")
    return packed.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document against the manifest of all, some of them tampered with."""
    return merkle_proofs(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuts, output and restored text of every document, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fim = F.col("fim")
    return fill_in_middle(docs).select(
        "doc_id",
        *[fim[name].alias(name) for name in ("n", "form", "prefix_chars", "middle_chars")],
        F.sha2(fim["output"], 256).alias("output_sha256"),
        F.sha2(restored(fim["output"], fim["form"]), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_search": op2_search,
    "op3_quality_rules": op3_quality_rules,
    "op4_simhash": op4_simhash,
    "op5_mixing": op5_mixing,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_licenses": op7_licenses,
    "op8_sharding": op8_sharding,
    "op9_packing": op9_packing,
    "op10_private_data": op10_private_data,
    "op11_sum_of_squares": op11_sum_of_squares,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_fill_in_middle": op13_fill_in_middle,
}
