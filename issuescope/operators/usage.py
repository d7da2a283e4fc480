"""Token usage and cost."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MODEL_PRICES
from .lookup import literal_table

TOKENS = ("prompt_tokens", "completion_tokens", "total_tokens")


def usage_summary(answers: DataFrame) -> DataFrame:
    """Calls and tokens per (stage, model), per stage and in all; the summed-up columns are null."""
    return answers.rollup("stage", "model").agg(
        F.count(F.lit(1)).alias("calls"), *[F.sum(c).alias(c) for c in TOKENS]
    )


def price_table(spark: SparkSession, prices=MODEL_PRICES) -> DataFrame:
    """(model, usd_in, usd_out) per million tokens."""
    return literal_table(spark, prices, "model string, usd_in double, usd_out double")


def cost_estimate(answers: DataFrame, prices: DataFrame) -> DataFrame:
    """Tokens and USD per (stage, model); models without a price have a null cost."""
    usage = answers.groupBy("stage", "model").agg(*[F.sum(c).alias(c) for c in TOKENS])
    usd = (F.col("prompt_tokens") * F.col("usd_in") + F.col("completion_tokens") * F.col("usd_out")) / 1_000_000
    return usage.join(prices, "model", "left").select("stage", "model", *TOKENS, usd.alias("usd"))
