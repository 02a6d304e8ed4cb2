"""Executive KPI queries over a trailing window that ends at ``as_of``.

``*_literal`` variants keep the original arithmetic (distinct counts of daily counts,
unweighted means of daily rates) for comparison; the others count people and weigh by volume.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.functions.measures import count_if, rounded_ratio, usd_rounded
from tracelode.functions.redact import MARK
from tracelode.operators import gold


def last_day(facts: DataFrame, time: str = "event_timestamp") -> Column:
    """The latest day of a table, as a scalar subquery."""
    return facts.agg(F.to_date(F.max(time))).scalar()


def trailing(facts: DataFrame, as_of: Column | date, days: int = 30, time: str = "event_timestamp") -> DataFrame:
    """Rows of the last ``days`` days.

    The bound is on the plain column, so scans can skip by it. A table stored by
    ``event_date`` gets the bound there as well: only that drops whole partitions.
    """
    start = F.date_sub(as_of if isinstance(as_of, Column) else F.lit(as_of), days)
    recent = facts.filter(F.col(time) >= start)
    return recent.filter(F.col("event_date") >= start) if "event_date" in facts.columns else recent


def scorecard(costs: DataFrame, as_of: Column | date, days: int = 30) -> DataFrame:
    tokens = F.col("input_tokens") + F.col("output_tokens") + F.col("cache_creation_tokens") + F.col("cache_read_tokens")
    per_session = (
        trailing(costs, as_of, days)
        .groupBy("session_id", "user_email")
        .agg(F.sum(tokens).alias("tokens"), F.sum("cost_units").alias("units"))
    )
    return (
        per_session.agg(
            F.count_distinct("user_email").alias("active_developers_30d"),
            F.count_distinct("session_id").alias("total_coding_sessions"),
            F.sum("tokens").alias("total_tokens_used"),
            F.sum("units").alias("_units"),
        )
        .withColumns(
            {
                "total_investment_usd": usd_rounded("_units"),
                "avg_cost_per_dev_usd": rounded_ratio("_units", "(active_developers_30d * 1000000)", 0) / 100,
            }
        )
        .drop("_units")
    )


def tool_matrix(tools: DataFrame, as_of: Column | date, days: int = 30) -> DataFrame:
    per_user = (
        trailing(tools, as_of, days)
        .groupBy("tool_name", "user_email")
        .agg(
            F.count("*").alias("n"),
            count_if(F.col("exit_code") != 0).alias("failed"),
            F.sum("duration_ms").alias("ms"),
            F.count("duration_ms").alias("timed"),
        )
    )
    totals = per_user.groupBy("tool_name").agg(
        F.sum("n").alias("total_executions_30d"),
        F.count("user_email").alias("active_developers_using_tool"),
        F.sum("failed").alias("failed"),
        F.sum("ms").alias("ms"),
        F.sum("timed").alias("timed"),
    )
    return totals.select(
        "tool_name",
        "total_executions_30d",
        "active_developers_using_tool",
        rounded_ratio("failed", "total_executions_30d", 2, scale=100).alias("failure_rate_pct"),
        rounded_ratio("ms", "timed", 0).alias("avg_execution_time_ms"),
    ).orderBy(F.desc("total_executions_30d"), "tool_name")


def tool_matrix_literal(matrix: DataFrame, as_of: Column | date, days: int = 30) -> DataFrame:
    """From the daily matrix view."""
    window = trailing(matrix, as_of, days, "metric_date").withColumns(
        {c: F.round(F.col(c) * 100).cast("bigint") for c in ("error_rate_pct", "avg_duration_ms")}
    )
    totals = window.groupBy("tool_name").agg(
        F.sum("total_executions").alias("total_executions_30d"),
        F.count_distinct("unique_users").alias("active_developers_using_tool"),
        F.sum("error_rate_pct").alias("rates"),
        (F.count("error_rate_pct") * 100).alias("rate_days"),
        F.sum("avg_duration_ms").alias("times"),
        (F.count("avg_duration_ms") * 100).alias("time_days"),
    )
    return totals.select(
        "tool_name",
        "total_executions_30d",
        "active_developers_using_tool",
        rounded_ratio("rates", "rate_days", 2).alias("avg_failure_rate_pct"),
        rounded_ratio("times", "time_days", 0).alias("avg_execution_time_ms"),
    ).orderBy(F.desc("total_executions_30d"), "tool_name")


def department_cost(costs: DataFrame, as_of: Column | date, days: int = 30) -> DataFrame:
    per_user = (
        trailing(costs, as_of, days)
        .withColumn("department", F.coalesce("department", F.lit("Unassigned")))
        .groupBy("department", "user_email")
        .agg(
            F.sum("input_tokens").alias("input"),
            F.sum("output_tokens").alias("output"),
            F.sum("cache_read_tokens").alias("cached"),
            F.sum("cost_units").alias("units"),
        )
    )
    totals = per_user.groupBy("department").agg(
        F.count("user_email").alias("dev_count"),
        F.sum("input").alias("input_tokens"),
        F.sum("output").alias("output_tokens"),
        F.sum("cached").alias("cached_tokens"),
        F.sum("units").alias("_units"),
    )
    return _with_cache_ratio(totals, usd_rounded("_units")).orderBy(F.desc("total_department_cost_usd"), "department")


def department_cost_literal(view: DataFrame, as_of: Column | date, days: int = 30) -> DataFrame:
    """From the daily department view."""
    totals = (
        trailing(view, as_of, days, "metric_date")
        .groupBy("department")
        .agg(
            F.count_distinct("active_users").alias("dev_count"),
            F.sum("total_input_tokens").alias("input_tokens"),
            F.sum("total_output_tokens").alias("output_tokens"),
            F.sum("total_cache_read_tokens").alias("cached_tokens"),
            F.sum(F.round(F.col("total_cost_usd") * 100).cast("bigint")).alias("_cents"),
        )
    )
    return _with_cache_ratio(totals, F.col("_cents") / 100).orderBy(F.desc("total_department_cost_usd"), "department")


def _with_cache_ratio(totals: DataFrame, cost: Column) -> DataFrame:
    return totals.select(
        "department",
        "dev_count",
        "input_tokens",
        "output_tokens",
        "cached_tokens",
        rounded_ratio("cached_tokens", "(input_tokens + cached_tokens)", 1, scale=100).alias("cache_hit_ratio_pct"),
        cost.alias("total_department_cost_usd"),
    )


def dau_trend(costs: DataFrame) -> DataFrame:
    return (
        gold.executive_daily_kpis(costs)
        .select(
            "metric_date",
            "active_developers_dau",
            "total_sessions",
            F.col("total_spend_usd").alias("daily_spend_usd"),
        )
        .orderBy(F.desc("metric_date"))
    )


def security_audit(leaks: DataFrame, as_of: Column | date, days: int = 30) -> DataFrame:
    """Flagged prompts, the tags in them, and the people concerned, by day and department."""
    tags = F.size(F.split("flagged_content_snippet", MARK.replace("[", r"\["))) - 1
    per_user = (
        trailing(leaks, as_of, days)
        .groupBy("audit_date", "department", "user_email")
        .agg(F.count("*").alias("n"), F.sum(tags).alias("tags"))
    )
    return (
        per_user.groupBy("audit_date", "department")
        .agg(
            F.sum("n").alias("flagged_prompts"),
            F.sum("tags").alias("secrets_redacted"),
            F.count("user_email").alias("impacted_developers"),
        )
        .orderBy(F.desc("audit_date"), "department")
    )
