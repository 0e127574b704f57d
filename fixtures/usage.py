"""Token usage derived from ``conversations``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.funnel import read


def conversation_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per conversation, a character taken as a token.

    Later user turns count as cached input; a conversation without them has NULL there. One
    of the four models has no price.
    """
    turns = read(spark, sf_dir, "conversations")
    size = F.length("text")
    user = F.col("role") == "user"

    def total(condition) -> F.Column:
        return F.sum(F.when(condition, size))

    models = F.array(*[F.lit(m) for m in ("gpt-5.2", "gpt-5-mini", "o3", "unlisted")])
    return turns.groupBy(F.col("conv_id").alias("run_id")).agg(
        F.coalesce(total(user), F.lit(0)).cast("bigint").alias("input_tokens"),
        total(user & (F.col("turn") >= 2)).cast("bigint").alias("cached_tokens"),
        F.coalesce(total(F.col("role") == "assistant"), F.lit(0)).cast("bigint").alias(
            "output_tokens"
        ),
    ).withColumn("model", models[(F.col("run_id") % 4).cast("int")])
