"""Exact money and ratio columns.

Money is summed as BIGINT units of 1e-8 USD, so that sums do not depend on the order
in which tasks finish. Rounding is done on integers, half away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS_PER_USD = 100_000_000


def usd(units: str) -> Column:
    return F.col(units).cast("double") / F.lit(float(UNITS_PER_USD))


def rounded_ratio(num: str, den: str, places: int, scale: int = 1) -> Column:
    """``round(scale * num / den, places)`` for non-negative BIGINT columns, NULL where den is 0."""
    return F.expr(
        f"(({num} * {2 * scale * 10**places} + {den}) div (2 * nullif({den}, 0))) / {10.0**places}D"
    )


def usd_rounded(units: str, places: int = 2) -> Column:
    step = UNITS_PER_USD // 10**places
    return F.expr(f"(({units} + {step // 2}) div {step}) / {10.0**places}D")


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def sum_long(column: str | Column) -> Column:
    """Sum with an empty group as 0."""
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")
