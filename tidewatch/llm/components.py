"""Connected components by alternating stars, on tables alone.

Each round first links a node's larger neighbours to its smallest neighbour, then its smaller ones.
Minima are taken before the shuffle, so a node with very many neighbours is no large group, and
the join back is one that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come as (larger, smaller)."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    joined = edges.join(least, "a").where("b > least")
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    )


def connected(links: DataFrame) -> DataFrame:
    """Of links (a, b) each node with the smallest node it is connected with: (node, root)."""
    pair = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = cut(pair.where("a <> b").distinct())
    before = None
    while (state := _state(edges)) != before:
        before = state
        edges = cut(_small_star(_large_star(edges)))
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select("b", "b")).distinct()
