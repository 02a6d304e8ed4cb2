"""Stored sketches: distinct users and durations per day, merged for any range without reading events again.

*Users.* A theta sketch per day and department. Sketches of several days merge to the users of the range; the difference and the
intersection of two ranges give the users lost and those who came back. An HLL sketch beside it is a tenth of the size, for counts alone.
*Durations.* A KLL sketch of whole milliseconds per hour and model; hours merge to days.

A sketch with fewer entries than its size is exact. Beyond, a count is off by about ``1 / sqrt(2**lg)`` of all users seen by either side, and a
quantile's rank by about ``1.7 / k``. The stored tables hold one row per day and department, however many events there were.
NULL users, durations and days have no part in a sketch; a NULL department or model is a group of its own. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.functions.times import from_micros
from tracelode.operators.sliced import micros

#: Entries of a theta sketch, registers of an HLL sketch (powers of two), size of a KLL sketch.
THETA_LG, HLL_LG, KLL_K = 14, 12, 400
_HOUR = 3_600_000_000


def user_days(events: DataFrame, user: str = "user_email", day: str = "event_date") -> DataFrame:
    """Sketches of the users of each day and department, and the exact number of their events."""
    known = events.filter(F.col(user).isNotNull() & F.col(day).isNotNull())
    return known.groupBy(F.col(day).alias("day"), "department").agg(
        F.theta_sketch_agg(user, THETA_LG).alias("users_theta"), F.hll_sketch_agg(user, HLL_LG).alias("users_hll"), F.count("*").alias("events")
    )


def merged_users(days: DataFrame, *group: str | Column) -> DataFrame:
    """The sketches of groups of days, as they would be over all their events."""
    return days.groupBy(*group).agg(
        F.theta_union_agg("users_theta", THETA_LG).alias("users_theta"), F.hll_union_agg("users_hll").alias("users_hll"), F.sum("events").alias("events")
    )


def active_users(merged: DataFrame) -> DataFrame:
    """Estimated users of each group, from either sketch."""
    return merged.withColumns({"theta_users": F.theta_sketch_estimate("users_theta"), "hll_users": F.hll_sketch_estimate("users_hll")}).drop(
        "users_theta", "users_hll"
    )


def changed_users(periods: DataFrame, period: str, before: Column) -> DataFrame:
    """period, active, lost and returning: users of each period, of the one ``before`` it who did not come back, and who did.

    ``periods``: one row per period with ``users_theta``. A period after one without events lost nobody and nobody returned.
    """
    now = periods.select(period, before.alias("_before"), "users_theta")
    past = periods.select(F.col(period).alias("_before"), F.col("users_theta").alias("_theta"))
    both = now.join(past, "_before", "left")

    def size(sketch: Column) -> Column:
        return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0))

    return both.select(
        period,
        size(F.col("users_theta")).alias("active"),
        size(F.theta_difference("_theta", "users_theta")).alias("lost"),
        size(F.theta_intersection("_theta", "users_theta")).alias("returning"),
    )


def duration_hours(events: DataFrame, time: str = "event_timestamp", value: str = "latency_ms") -> DataFrame:
    """A sketch of the durations of each hour and model. Parts of several batches merge."""
    known = events.filter(F.col(value).isNotNull() & F.col(time).isNotNull())
    hour = from_micros(F.floor(micros(F.col(time)) / _HOUR).cast("bigint") * _HOUR)
    return known.groupBy(hour.alias("hour"), "model").agg(
        F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), KLL_K).alias("durations"), F.count("*").alias("requests")
    )


def merged_durations(hours: DataFrame, *group: str | Column) -> DataFrame:
    return hours.groupBy(*group).agg(F.kll_merge_agg_bigint("durations", KLL_K).alias("durations"), F.sum("requests").alias("requests"))


def quantiles(merged: DataFrame, ranks: dict[str, float]) -> DataFrame:
    """The durations at the given ranks, by name."""
    found = {name: F.kll_sketch_get_quantile_bigint("durations", F.lit(rank)) for name, rank in ranks.items()}
    return merged.withColumns(found).drop("durations")
