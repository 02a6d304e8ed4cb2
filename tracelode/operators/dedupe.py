"""Deterministic de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order_by: list[str | Column]) -> DataFrame:
    """One row per key: the first in ``order_by``, which should be a total order.

    Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle, so a
    key re-delivered a billion times sends one row per map task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by)))
    return ranked.filter("_rank = 1").drop("_rank")


def insert_new(
    target: DataFrame, source: DataFrame, key: str, order_by: list[str | Column], within: str | None = None
) -> DataFrame:
    """The rows a merge with "when not matched then insert" would add to ``target``.

    ``within`` names a column that is the same in every delivery of a row, best the one the
    target is partitioned by. Only the part of the target in the source's range is read then,
    so the cost follows the batch and not the history.
    """
    known = target
    if within:
        low, high = source.agg(F.min(within), F.max(within)).first()
        known = known.filter(F.col(within).between(F.lit(low), F.lit(high)))
    return keep_first(source, [key], order_by).join(known.select(key).distinct(), key, "left_anti")
