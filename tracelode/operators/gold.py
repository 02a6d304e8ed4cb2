"""Gold aggregates and the serving views over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelode.functions.measures import count_if, rounded_ratio, sum_long, usd, usd_rounded
from tracelode.functions.redact import is_flagged, redact, will_be_flagged


def daily_user_metrics(sessions: DataFrame) -> DataFrame:
    """Sessions belong to the day they start. ``session_id`` is the key of the input, so a
    plain count is the distinct count."""
    return (
        sessions.groupBy(F.to_date("session_start").alias("usage_date"), "user_email", "department")
        .agg(
            F.count("session_id").alias("total_sessions"),
            F.sum("total_prompts").alias("total_prompts"),
            F.sum("total_tool_calls").alias("total_tool_calls"),
            F.sum("session_duration_sec").alias("total_duration_sec"),
        )
        .withColumn("avg_session_duration_sec", F.col("total_duration_sec") / F.col("total_sessions"))
    )


def _tool_days(tools: DataFrame) -> DataFrame:
    """Tool measures per day and tool.

    The first step groups by user as well. It shrinks the rows, and the distinct user count
    is a plain count after it.
    """
    per_user = tools.groupBy(F.to_date("event_timestamp").alias("execution_date"), "tool_name", "user_email").agg(
        F.count("*").alias("total_executions"),
        count_if(F.col("event_name") == "tool_result").alias("completed_executions"),
        count_if(F.col("exit_code") != 0).alias("failed_executions"),
        F.sum("duration_ms").alias("_ms"),
        F.count("duration_ms").alias("_timed"),
    )
    return per_user.groupBy("execution_date", "tool_name").agg(
        F.sum("total_executions").alias("total_executions"),
        F.sum("completed_executions").alias("completed_executions"),
        F.count("user_email").alias("unique_users"),
        F.sum("failed_executions").alias("failed_executions"),
        F.sum("_ms").alias("_ms"),
        F.sum("_timed").alias("_timed"),
    )


def tool_adoption_summary(tools: DataFrame) -> DataFrame:
    """``total_executions`` counts decisions and results, ``completed_executions`` results only."""
    return (
        _tool_days(tools)
        .withColumns(
            {
                "avg_duration_ms": F.col("_ms") / F.nullif("_timed", F.lit(0)),
                "error_rate_pct": F.col("failed_executions") / F.col("total_executions") * 100,
            }
        )
        .drop("_ms", "_timed")
    )


def department_cost_attribution(costs: DataFrame) -> DataFrame:
    per_user = costs.groupBy(
        F.to_date("event_timestamp").alias("cost_date"), "department", "model_name", "user_email"
    ).agg(
        F.sum("input_tokens").alias("input"),
        F.sum("output_tokens").alias("output"),
        F.sum("cache_creation_tokens").alias("cache_creation"),
        F.sum("cache_read_tokens").alias("cache_read"),
        F.sum("cost_units").alias("cost_units"),
    )
    return per_user.groupBy("cost_date", "department", "model_name").agg(
        F.count("user_email").alias("active_users"),
        F.sum("input").alias("total_input_tokens"),
        F.sum("output").alias("total_output_tokens"),
        F.sum("cache_creation").alias("total_cache_creation_tokens"),
        F.sum("cache_read").alias("total_cache_read_tokens"),
        F.sum("cost_units").alias("total_cost_units"),
    )


def department_cost_rollup(costs: DataFrame) -> DataFrame:
    """Spend by (department, model) with subtotals; ``level`` is 0 for a detail row."""
    detail = costs.groupBy("department", "model_name").agg(F.sum("cost_units").alias("units"))
    return (
        detail.rollup("department", "model_name")
        .agg(F.grouping_id().cast("bigint").alias("level"), F.sum("units").alias("total_cost_units"))
        .withColumn("total_cost_usd", usd("total_cost_units"))
    )


def daily_users_approx(costs: DataFrame, error: float = 0.02) -> DataFrame:
    """Daily actives and sessions as sketches: one pass over raw rows, sketches merge, ``error`` is the relative deviation."""
    return costs.groupBy(F.to_date("event_timestamp").alias("metric_date")).agg(
        F.approx_count_distinct("user_email", error).alias("active_users"),
        F.approx_count_distinct("session_id", error).alias("sessions"),
    )


def leak_alerts(events: DataFrame) -> DataFrame:
    """Every text that held a secret, from prompts, responses and tool traffic, in one pass.

    The redacted text is the evidence; the secret itself never leaves.
    """
    sources = [c for c in ("prompt_text", "response_text", "tool_input", "tool_output") if c in events.columns]
    texts = F.filter(
        F.array(*[F.struct(F.lit(c.removesuffix("_text")).alias("source"), F.col(c).alias("text")) for c in sources]),
        lambda item: item["text"].isNotNull(),
    )
    kept = [c for c in ("event_id", "event_timestamp", "user_email", "department", "session_id") if c in events.columns]
    return (
        events.select(*kept, F.inline(texts))
        .filter(will_be_flagged("text"))
        .select(
            F.to_date("event_timestamp").alias("alert_date"), *kept, "source", redact("text").alias("flagged_text")
        )
    )


def stored_leak_alerts(tables: dict[str, DataFrame]) -> DataFrame:
    """``leak_alerts`` from the redacted silver tables: every stored text that carries a tag."""
    texts = (("prompts", "prompt_text"), ("responses", "response_text"), ("tool_executions", "tool_input"),
             ("tool_executions", "tool_output"))
    found = None
    for table, text in texts:
        rows = tables[table].filter(is_flagged(text))
        department = F.col("department") if "department" in rows.columns else F.lit(None).cast("string")
        part = rows.select(
            F.to_date("event_timestamp").alias("alert_date"), "event_timestamp", "user_email", department.alias("department"),
            "session_id", F.lit(text.removesuffix("_text")).alias("source"), F.col(text).alias("flagged_text"),
        )
        found = part if found is None else found.unionByName(part)
    return found


def prompt_leak_audit(prompts: DataFrame) -> DataFrame:
    """The audit view over redacted prompts."""
    return prompts.filter(is_flagged("prompt_text")).select(
        F.to_date("event_timestamp").alias("audit_date"),
        "event_timestamp",
        "user_email",
        "department",
        "session_id",
        F.col("prompt_text").alias("flagged_content_snippet"),
    )


def executive_daily_kpis(costs: DataFrame) -> DataFrame:
    """Daily actives, sessions, tokens and spend.

    Two distinct counts over raw rows would triple them (one copy per distinct column). They
    run over one row per (day, session, user) instead.
    """
    tokens = F.col("input_tokens") + F.col("output_tokens") + F.col("cache_creation_tokens") + F.col("cache_read_tokens")
    per_session = costs.groupBy(F.to_date("event_timestamp").alias("metric_date"), "session_id", "user_email").agg(
        F.sum(tokens).alias("tokens"), F.sum("cost_units").alias("units")
    )
    return (
        per_session.groupBy("metric_date")
        .agg(
            F.count_distinct("user_email").alias("active_developers_dau"),
            F.count_distinct("session_id").alias("total_sessions"),
            F.sum("tokens").alias("total_tokens_consumed"),
            F.sum("units").alias("_units"),
        )
        .withColumns(
            {
                "total_spend_usd": usd_rounded("_units"),
                "avg_spend_per_dev_usd": rounded_ratio("_units", "(active_developers_dau * 1000000)", 0) / 100,
            }
        )
        .drop("_units")
    )


def tool_adoption_matrix(tools: DataFrame) -> DataFrame:
    return (
        _tool_days(tools)
        .select(
            F.col("execution_date").alias("metric_date"),
            "tool_name",
            "total_executions",
            "unique_users",
            "failed_executions",
            rounded_ratio("failed_executions", "total_executions", 2, scale=100).alias("error_rate_pct"),
            rounded_ratio("_ms", "_timed", 2).alias("avg_duration_ms"),
        )
    )


def department_cost_view(costs: DataFrame) -> DataFrame:
    labelled = costs.withColumn("department", F.coalesce("department", F.lit("Unassigned")))
    return department_cost_attribution(labelled).select(
        F.col("cost_date").alias("metric_date"),
        "department",
        "model_name",
        "active_users",
        "total_input_tokens",
        "total_output_tokens",
        "total_cache_read_tokens",
        usd_rounded("total_cost_units").alias("total_cost_usd"),
    )


def daily_org_usage(daily_users: DataFrame) -> DataFrame:
    measures = ("sessions", "prompts", "responses", "tool_events", "input_tokens", "output_tokens", "cost_units")
    return daily_users.groupBy("usage_date", "org_id").agg(*[sum_long(m).alias(m) for m in measures])
