"""Running values over keys of any size.

A plain window sorts a whole key in one task, so a session (or an 'unknown' bucket) that
holds a third of all rows stops the job. Here a key is cut into slices of time.
Each slice is windowed on its own, the per-slice totals are small and get their own window,
and what a row needs from earlier slices is joined back on (key, slice). A slice that is still
too large is cut again by the next finer rule, and its totals are carried inside it: no
window sees more totals than one coarser slice has finer ones.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelode.functions.times import since_epoch
from tracelode.session import scratch_dir


@dataclass(frozen=True)
class Running:
    """A running ``sum``, ``max`` or ``min`` of ``value`` up to and including the row."""

    kind: str
    value: Column

    @property
    def aggregate(self) -> Callable[[Column], Column]:
        return {"sum": F.sum, "max": F.max, "min": F.min}[self.kind]

    def combine(self, carried: list[Column], local: Column) -> Column:
        if self.kind == "sum":
            total = F.coalesce(local, F.lit(0))
            for c in carried:
                total = total + F.coalesce(c, F.lit(0))
            return total
        if not carried:
            return local
        return (F.greatest if self.kind == "max" else F.least)(*carried, local)


ROWS_PER_SLICE = 5_000_000
#: Partitions that rows without a key or an order are spread over; they get no running value.
UNORDERED_PARTS = 4096


def time_slices(time: str, tie: str) -> list[tuple[Column, ...]]:
    """Ten minutes, seconds, milliseconds, instants, and ranges of the number that breaks ties.

    Each level has at most a thousand or so slices inside one of the level above.
    """
    seconds = since_epoch(F.col(time))
    return [
        (F.floor(seconds / 600).cast("bigint"),),
        (F.floor(seconds).cast("bigint"),),
        (F.floor(seconds * 1000).cast("bigint"),),
        (micros(F.col(time)),),
        (F.floor(F.col(tie) / 1_000_000).cast("bigint"),),
    ]


def micros(time: Column) -> Column:
    return (since_epoch(time) * 1_000_000).cast("bigint")


# Two BIGINTs in one DECIMAL, ordered as the pair is. Spark hashes a minimum over it; over a struct it would sort all rows.
_MINOR = Decimal(2 * 10**19)
_OFFSET = Decimal(2**63)


def paired(major: Column, minor: Column) -> Column:
    """``major`` below 10**18 in size, as times in microseconds and sequence numbers are."""
    wide = T.DecimalType(38, 0)
    return (major.cast(wide) * F.lit(_MINOR) + minor.cast(wide) + F.lit(_OFFSET)).cast(wide)


def unpaired(pair: str) -> tuple[Column, Column]:
    minor = F.pmod(F.col(pair), F.lit(_MINOR).cast(T.DecimalType(38, 0)))
    major = (F.col(pair) - minor) / F.lit(_MINOR)
    return major.cast("bigint"), (minor - F.lit(_OFFSET)).cast("bigint")


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running(
    df: DataFrame,
    keys: list[str],
    slices: list[tuple[Column, ...]],
    order_by: list[str],
    values: dict[str, Running],
    descending: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add one running column per entry of ``values``.

    ``order_by`` must be a total order within a key. ``slices`` are BIGINT columns, coarse to
    fine, none of which may decrease along that order within its coarser slice. Rows whose key or
    order is NULL are kept; they stand in no order and get NULL. With ``descending`` the values
    run from the last row back.

    The totals are written to the shared folder, level by level, so the input is read once for
    them and once for the rows, and a level that no slice needs is never computed.
    """
    known = F.lit(True)
    for c in [*keys, *order_by]:
        known = known & F.col(c).isNotNull()
    plain = [f.name for f in df.schema if not isinstance(f.dataType, (T.VariantType, T.MapType))]
    apart = -1 - F.pmod(F.xxhash64(*plain), F.lit(UNORDERED_PARTS))
    names = [[f"_slice_{depth}_{i}" for i in range(len(level))] for depth, level in enumerate(slices)]
    rows = df.withColumns({"_known": known, **{f"_in_{n}": r.value for n, r in values.items()}})
    totals = [r.aggregate(f"_in_{n}").alias(f"_all_{n}") for n, r in values.items()]
    direction = F.desc if descending else F.asc

    carried, path = [], list(keys)
    for depth, level in enumerate(slices):
        if depth:
            large = counted.filter(F.col("_n") > rows_per_slice).select(*path)  # noqa: F821
            if large.isEmpty():
                break
            rows = rows.join(large.withColumn("_large", F.lit(True)), path, "left")
            cut = {n: F.when(F.col("_large"), c) for n, c in zip(names[depth], level)}
            rows = rows.withColumns(cut).drop("_large")
            refined = rows.filter(F.col(names[depth][0]).isNotNull())
        else:
            rows = rows.withColumns(dict(zip(names[0], level)))
            refined = rows.filter("_known")
        above = Window.partitionBy(*path).orderBy(*[direction(c) for c in names[depth]])
        path = [*path, *names[depth]]
        counted = _kept(refined.groupBy(*path).agg(F.count("*").alias("_n"), *totals), "totals")
        earlier = above.rowsBetween(Window.unboundedPreceding, -1)
        carried.append(
            (path, counted.select(*path, *[r.aggregate(f"_all_{n}").over(earlier).alias(f"_carry_{depth}_{n}") for n, r in values.items()]))
        )

    used = [n for level in names[: len(carried)] for n in level]
    spread = F.when(F.col("_known"), F.col(used[0])).otherwise(apart)
    within = (
        Window.partitionBy(*keys, *used)
        .orderBy(*[direction(c) for c in order_by])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = rows.withColumn(used[0], spread)
    local = local.withColumns({f"_in_{n}": r.aggregate(f"_in_{n}").over(within) for n, r in values.items()})
    for on, totals_before in carried:
        local = local.join(totals_before, on, "left")
    out = {
        n: F.when(F.col("_known"), r.combine([F.col(f"_carry_{d}_{n}") for d in range(len(carried))], F.col(f"_in_{n}")))
        for n, r in values.items()
    }
    return local.withColumns(out).drop(
        "_known", *used, *[f"_in_{n}" for n in values], *[f"_carry_{d}_{n}" for d in range(len(carried)) for n in values]
    )
