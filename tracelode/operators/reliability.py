"""Retries, recovery, tool outcomes, prompt traces, compaction, span timing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.functions.measures import count_if, rounded_ratio
from tracelode.operators.sliced import Running, micros, paired, running, unpaired

# Fixed value: default number of retries; a request that used them all made one attempt more.
MAX_RETRIES = 10


def _exhausted(max_retries: int) -> Column:
    return (F.col("event_name") == "api_error") & (F.col("attempt") >= max_retries + 1)


def retry_exhausted(events: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Requests that ran out of retries, by day, model and status."""
    return (
        events.filter(F.col("event_name") == "api_error")
        .groupBy("event_date", "model", "status_code")
        .agg(F.count("*").alias("errors"), count_if(_exhausted(max_retries)).alias("exhausted"))
    )


def session_recovery(
    events: DataFrame,
    recovered_by: tuple[str, ...] = ("api_request", "assistant_response"),
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """Sessions with an exhausted request: did a later request get through?

    Two latest times per session decide it; no self-join and no sort.
    """
    failed, at = _exhausted(max_retries), F.col("event_timestamp")
    served = F.col("event_name").isin(*recovered_by)
    ends = (
        events.filter(F.col("session_id").isNotNull() & (failed | served))
        .groupBy("session_id")
        .agg(
            count_if(failed).alias("exhausted"),
            F.max(F.when(failed, at)).alias("last_exhausted_at"),
            F.max(F.when(served, at)).alias("_served"),
        )
    )
    return ends.filter("exhausted > 0").select(
        "session_id",
        "exhausted",
        "last_exhausted_at",
        F.when(F.col("_served") > F.col("last_exhausted_at"), "recovered").otherwise("stalled").alias("outcome"),
    )


def api_latency(events: DataFrame) -> DataFrame:
    """Request durations by day and model: exact median, 95th percentile and maximum.

    Counted per whole millisecond first, so the percentiles see one row per distinct duration.
    """
    timed = events.filter((F.col("event_name") == "assistant_response") & F.col("latency_ms").isNotNull())
    histogram = timed.groupBy("event_date", "model", "latency_ms").agg(F.count("*").alias("n"))
    return histogram.groupBy("event_date", "model").agg(
        F.sum("n").alias("requests"),
        F.round(F.percentile("latency_ms", 0.5, F.col("n")), 3).alias("p50_ms"),
        F.round(F.percentile("latency_ms", 0.95, F.col("n")), 3).alias("p95_ms"),
        F.max("latency_ms").alias("max_ms"),
    )


def tool_success(events: DataFrame) -> DataFrame:
    """Frequency, success rate and mean time of each tool."""
    return (
        events.filter(F.col("event_name") == "tool_result")
        .groupBy("tool_name")
        .agg(
            F.count("*").alias("results"),
            count_if(F.col("exit_code") == 0).alias("succeeded"),
            count_if(F.col("exit_code") != 0).alias("failed"),
            F.sum("duration_ms").alias("_ms"),
            F.count("duration_ms").alias("_timed"),
        )
        .withColumns(
            {
                "success_rate_pct": rounded_ratio("succeeded", "(succeeded + failed)", 2, scale=100),
                "avg_duration_ms": rounded_ratio("_ms", "_timed", 2),
            }
        )
        .drop("_ms", "_timed")
    )


def tool_errors(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col("error_type").isNotNull())
        .groupBy("tool_name", "error_type")
        .agg(F.count("*").alias("errors"))
    )


def tool_decision_outcome(events: DataFrame) -> DataFrame:
    """Decisions and the results that carry the same ``tool_use_id``, as one grouping.

    A rejected call should have no result; ``outcome`` says what was found.
    """
    name = F.col("event_name")
    calls = (
        events.filter(F.col("tool_use_id").isNotNull())
        .groupBy("tool_use_id")
        .agg(
            count_if((name == "tool_decision") & (F.col("decision") == "reject")).alias("_rejects"),
            count_if((name == "tool_decision") & (F.col("decision") == "accept")).alias("_accepts"),
            count_if(name == "tool_result").alias("results"),
            count_if((name == "tool_result") & (F.col("exit_code") != 0)).alias("failures"),
        )
        .withColumn("decision", F.when(F.col("_rejects") > 0, "reject").when(F.col("_accepts") > 0, "accept"))
        .drop("_rejects", "_accepts")
    )
    outcome = (
        F.when((F.col("decision") == "reject") & (F.col("results") == 0), "rejected")
        .when(F.col("decision") == "reject", "result_after_reject")
        .when(F.col("results") == 0, "no_result")
        .when(F.col("failures") > 0, "failed")
        .otherwise("executed")
    )
    return calls.withColumn("outcome", outcome)


def prompt_trace(events: DataFrame) -> DataFrame:
    """Every event a prompt set off, with its step and offset; both NULL for an event without session or sequence.

    Rows, not one list per prompt: a prompt of any length streams out in parallel.
    """
    is_prompt = F.col("event_name") == "user_prompt"
    at = micros(F.col("event_timestamp"))
    start = paired(F.col("event_sequence"), at)
    traced = running(
        events,
        ["session_id"],
        [(F.floor(F.col("event_sequence") / 100_000).cast("bigint"),)],
        ["event_sequence"],
        {"_start": Running("max", F.when(is_prompt, start))},
    )
    first, started = unpaired("_start")
    return traced.filter(F.col("_start").isNotNull() | F.col("event_sequence").isNull() | F.col("session_id").isNull()).select(
        "session_id",
        "prompt_id",
        (F.col("event_sequence") - first).alias("step"),
        "event_sequence",
        "event_name",
        F.floor((at - started) / 1000).cast("bigint").alias("offset_ms"),
    )


def compaction_ratio(compactions: DataFrame) -> DataFrame:
    """Tokens before and after successful compactions, by day and trigger."""
    return (
        compactions.groupBy("event_date", "trigger")
        .agg(
            F.count("*").alias("compactions"),
            count_if(F.col("success") == "true").alias("succeeded"),
            F.sum(F.when(F.col("success") == "true", F.col("pre_tokens"))).alias("pre_tokens"),
            F.sum(F.when(F.col("success") == "true", F.col("post_tokens"))).alias("post_tokens"),
        )
        .withColumn("remaining_pct", rounded_ratio("post_tokens", "pre_tokens", 2, scale=100))
    )


def tool_wait_breakdown(spans: DataFrame) -> DataFrame:
    """Permission wait against execution time, per tool.

    The two child spans of a call meet by grouping on ``tool_use_id``, not by a join.
    """
    wait = F.col("span_type") == "tool.blocked_on_user"
    calls = spans.groupBy("tool_use_id").agg(
        F.max(F.when(wait, F.col("tool_name"))).alias("tool_name"),
        F.sum(F.when(wait, F.col("duration_ms"))).alias("wait_ms"),
        F.sum(F.when(~wait, F.col("duration_ms"))).alias("execute_ms"),
    )
    return (
        calls.groupBy("tool_name")
        .agg(
            F.count("*").alias("calls"),
            F.count("execute_ms").alias("executed_calls"),
            F.sum("wait_ms").alias("wait_ms"),
            F.sum("execute_ms").alias("execute_ms"),
        )
        .withColumn("wait_share_pct", rounded_ratio("wait_ms", "(wait_ms + execute_ms)", 2, scale=100))
    )
