"""The corpus pipeline: quality rules, near-duplicates, private data, mix, packing.

Defined cases: NULL and empty texts fail the base rule and go in the first stage; a NULL source is a host
and a source of its own; rows of one id are told apart by their text; columns beside those of documents,
whatever their names, stay with their rows up to the mix; an empty table gives an empty result. The last
stage gives places of pieces, not their ids, which ``best_fit_packing(keep_ids=True)`` adds.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import checkpoint_folder, table
from tidewatch.llm.mixing import mixed
from tidewatch.llm.packing import best_fit_packing
from tidewatch.llm.private_data import sanitised
from tidewatch.llm.quality_rules import quality_rules
from tidewatch.llm.simhash import keep_one_of_each

#: A column that documents do not have.
VERDICT = "verdict of the quality stage"
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the verdict on their host keep."""
    judged = quality_rules(docs, metrics=VERDICT)
    return judged.where(F.col(VERDICT)["kept"]).drop(VERDICT)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return keep_one_of_each(docs)


def private_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with private data and what reveals it taken out of their texts."""
    clean = sanitised(docs)
    n_chars = F.char_length("text").cast("long")
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), n_chars)).select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix takes them."""
    return mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return best_fit_packing(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("simhash", near_duplicate_stage),
    ("private_data", private_data_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL cannot express near-duplicates of these fingerprints nor the packing; tests/llm compare
#: the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each result is written to the shared folder and read again."""
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
