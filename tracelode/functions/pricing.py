"""Price dimension in integer units of 1e-8 USD per token."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Price:
    input: int
    output: int
    cache_creation: int
    cache_read: int


# 3.00 / 15.00 / 3.75 / 0.30 USD per million tokens, for every model without its own price.
DEFAULT_PRICE = Price(input=300, output=1500, cache_creation=375, cache_read=30)

TOKEN_KINDS = ("input", "output", "cache_creation", "cache_read")


def cost_units(prices: dict[str, Price] | None = None, model: str = "model_name") -> Column:
    """Cost of one row. Prices are configuration, so they fold into the expression: no join."""
    total = F.lit(0).cast("bigint")
    for kind in TOKEN_KINDS:
        price = F.lit(getattr(DEFAULT_PRICE, kind)).cast("bigint")
        for name, special in (prices or {}).items():
            price = F.when(F.col(model) == name, F.lit(getattr(special, kind)).cast("bigint")).otherwise(price)
        total = total + F.coalesce(F.col(f"{kind}_tokens"), F.lit(0)) * price
    return total.cast("bigint")


def reported_or_priced(events: DataFrame, prices: dict[str, Price] | None = None, model: str = "model") -> Column:
    """The cost an event reports as ``cost_usd``, else the cost of its tokens."""
    priced = cost_units(prices, model)
    if "cost_usd" not in events.columns:
        return priced
    return F.coalesce(F.round(F.col("cost_usd") * 100_000_000).cast("bigint"), priced)


def with_price_table(facts: DataFrame, prices: DataFrame, model: str = "model_name") -> DataFrame:
    """Cost from a price table ``(model, input, output, cache_creation, cache_read)``.

    For price lists too long to be configuration. The join side is left to Spark, which
    broadcasts the table only while its measured size is below the threshold.
    """
    p = prices.select(
        F.col("model").alias(model), *[F.col(k).cast("bigint").alias(f"_price_{k}") for k in TOKEN_KINDS]
    )
    total = F.lit(0).cast("bigint")
    for kind in TOKEN_KINDS:
        price = F.coalesce(F.col(f"_price_{kind}"), F.lit(getattr(DEFAULT_PRICE, kind)).cast("bigint"))
        total = total + F.coalesce(F.col(f"{kind}_tokens"), F.lit(0)) * price
    return (
        facts.join(p, model, "left")
        .withColumn("cost_units", total)
        .drop(*[f"_price_{k}" for k in TOKEN_KINDS])
    )
