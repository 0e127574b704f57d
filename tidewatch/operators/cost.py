"""Token cost of model runs, rolled up per model."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PRICE_TYPE = "decimal(18,12)"

# Price in dollars per million input, cached input and output tokens.
PRICE_PER_MILLION: dict[str, tuple[str, str, str]] = {
    "gpt-5.2": ("1.75", "0.175", "14.00"),
    "gpt-5": ("1.25", "0.125", "10.00"),
    "gpt-5-mini": ("0.25", "0.025", "2.00"),
    "o3": ("10.00", "2.50", "40.00"),
    "o4-mini": ("1.10", "0.275", "4.40"),
    "gpt-4.1": ("2.00", "0.50", "8.00"),
}
DEFAULT_MODEL = "gpt-5.2"

_PRICES = ("input_per_token", "cached_per_token", "output_per_token")


def _per_token(price: str):
    return (F.lit(price).cast(PRICE_TYPE) / F.lit(1_000_000)).cast(PRICE_TYPE)


def price_table(
    spark: SparkSession, prices: Mapping[str, tuple[str, str, str]] = PRICE_PER_MILLION
) -> DataFrame:
    """``model`` and its prices per token, as a literal relation."""
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            *[_per_token(p).alias(name) for p, name in zip(values, _PRICES)],
        )
        for model, values in prices.items()
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def run_costs(
    usage: DataFrame,
    prices: Mapping[str, tuple[str, str, str]] = PRICE_PER_MILLION,
    default_model: str = DEFAULT_MODEL,
) -> DataFrame:
    """Cost of every run in ``usage``.

    ``usage`` has ``model, input_tokens, cached_tokens, output_tokens``. Cached tokens are part
    of the input and may be NULL for none; an unknown model costs as much as the default one.
    """
    known = F.broadcast(price_table(usage.sparkSession, prices))
    default = dict(zip(_PRICES, prices[default_model]))
    priced = usage.join(known, "model", "left").withColumns(
        {name: F.coalesce(name, _per_token(default[name])) for name in _PRICES}
        | {"cached_tokens": F.coalesce("cached_tokens", F.lit(0))}
    )
    parts = {
        "cost_input": (F.col("input_tokens") - F.col("cached_tokens")) * F.col("input_per_token"),
        "cost_cached": F.col("cached_tokens") * F.col("cached_per_token"),
        "cost_output": F.col("output_tokens") * F.col("output_per_token"),
    }
    total = parts["cost_input"] + parts["cost_cached"] + parts["cost_output"]
    rounded = {
        name: F.round(cost, 6).cast("decimal(28,6)") for name, cost in (parts | {"total_cost": total}).items()
    }
    return priced.withColumns(rounded).drop(*_PRICES)


def cost_by_model(costs: DataFrame) -> DataFrame:
    """Runs, tokens and costs per model."""
    sums = [
        F.sum(c).alias(c)
        for c in (
            "input_tokens",
            "cached_tokens",
            "output_tokens",
            "cost_input",
            "cost_cached",
            "cost_output",
            "total_cost",
        )
    ]
    return costs.groupBy("model").agg(F.count("*").alias("runs"), *sums)
