"""Joins that stay balanced when one key holds a large share of a side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_spread: list[str],
    right_spread: list[str],
    rows_per_task: int = ROWS_PER_TASK,
    null_safe: list[str] | None = None,
) -> DataFrame:
    """Left equi-join for sides with hot keys; NULL equals NULL in the ``null_safe`` keys, by default all.

    A key with more than ``rows_per_task`` rows on a side is cut into parts there, by a hash of
    the spread columns, and the other side's rows of that key are repeated once per part. The
    list of hot keys cannot be longer than rows / ``rows_per_task``; whether it is broadcast is up to Spark. All other
    rows join as they are. Rows that can match nothing, for a NULL in another key, skip the join.
    """
    safe = set(keys if null_safe is None else null_safe)
    strict = [k for k in keys if k not in safe]
    if strict:
        whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in strict])
        joined = salted_left_join(
            left.filter(whole), right.filter(whole), keys, left_spread, right_spread, rows_per_task
        )
        return joined.unionByName(left.filter(~whole), allowMissingColumns=True)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sides = left.select(*keys, one.alias("_l"), none.alias("_r")).unionByName(
        right.select(*keys, none.alias("_l"), one.alias("_r"))
    )
    counts = sides.groupBy(*keys).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))

    def parts(count: str) -> Column:
        return F.greatest(F.ceil(F.col(count) / F.lit(rows_per_task)).cast("int"), F.lit(1))

    hot = counts.filter((F.col("_l") > rows_per_task) | (F.col("_r") > rows_per_task)).select(
        *[F.col(k).alias(f"_hot_{k}") for k in keys], parts("_l").alias("_lefts"), parts("_r").alias("_rights")
    )

    def with_parts(side: DataFrame, own: str, other: str, spread: list[str]) -> DataFrame:
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
        joined = side.join(hot, same, "left").drop(*[f"_hot_{k}" for k in keys])
        joined = joined.withColumns({c: F.coalesce(c, F.lit(1)) for c in ("_lefts", "_rights")})
        return joined.withColumns(
            {
                f"_{own}": F.pmod(F.xxhash64(*spread), F.col(f"_{own}s")).cast("int"),
                f"_{other}": F.explode(F.sequence(F.lit(0), F.col(f"_{other}s") - 1)),
            }
        )

    lefts = with_parts(left, "left", "right", left_spread)
    rights = with_parts(right, "right", "left", right_spread)
    matches = rights.select(
        *[F.col(k).alias(f"_of_{k}") for k in keys],
        F.col("_left").alias("_of_left"),
        F.col("_right").alias("_of_right"),
        F.lit(True).alias("_matched"),
        *[c for c in right.columns if c not in keys],
    )
    on = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    on += [F.col("_left") == F.col("_of_left"), F.col("_right") == F.col("_of_right")]
    joined = lefts.join(matches, reduce(Column.__and__, on), "left")
    # A key cut on the right has right rows by definition: an unmatched copy of its left row is no result.
    return joined.filter((F.col("_rights") == 1) | F.col("_matched")).select(
        *left.columns, *[c for c in right.columns if c not in keys]
    )
