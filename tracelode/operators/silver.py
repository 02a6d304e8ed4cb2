"""Silver: typed, redacted facts and the session table, from canonical events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelode import schemas
from tracelode.functions.keys import surrogate_key
from tracelode.functions.measures import count_if, sum_long
from tracelode.functions.pricing import Price, cost_units, reported_or_priced
from tracelode.functions.redact import redact
from tracelode.functions.times import epoch_seconds
from tracelode.operators.dedupe import keep_first


def _fields(events: DataFrame, schema: T.StructType, computed: dict[str, Column]) -> list[Column]:
    """The columns of a table contract: computed, taken from the events, or a typed NULL."""
    out = []
    for field in schema:
        if field.name in computed:
            column = computed[field.name]
        elif field.name in events.columns:
            column = F.col(field.name)
        else:
            column = F.lit(None)
        out.append(column.cast(field.dataType).alias(field.name))
    return out


def _key(events: DataFrame, kind: str, *parts: str) -> Column:
    """Surrogate key, NULL for events that do not carry all its parts."""
    if not set(parts) <= set(events.columns):
        return F.lit(None)
    return surrogate_key(*parts, F.lit(kind))


def told_apart_by(events: DataFrame) -> Column:
    """The reported time of events without a sequence number, NULL for others.

    Not the ingest time that stands in for a missing one: a re-delivery has another.
    """
    time = "reported_timestamp" if "reported_timestamp" in events.columns else "event_timestamp"
    return F.when(F.col("event_sequence").isNull(), F.col(time))


def unique_events(events: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key. Ties are broken by time and then by content, so a rerun agrees.

    Events without a sequence number are told apart by their time. Without that, all of a
    session's would share one key and only one of them would be kept.
    """
    content = F.xxhash64(*[f.name for f in events.schema if not isinstance(f.dataType, T.VariantType)])
    named = [c for c in ("message_uuid",) if c in events.columns]
    timed = events.withColumn("_time", told_apart_by(events))
    return keep_first(timed, [*keys, *named, "_time"], ["event_timestamp", content]).drop("_time")


def prompts(events: DataFrame, dedupe: bool = True) -> DataFrame:
    """``dedupe=False`` is for a source that already holds each event once."""
    found = events.filter(F.col("event_name") == "user_prompt")
    if dedupe:
        found = unique_events(found, ["session_id", "prompt_id", "event_sequence"])
    computed = {
        "prompt_sk": _key(events, "prompt", "session_id", "prompt_id", "event_sequence"),
        "model_name": F.col("model"),
        "prompt_text": redact("prompt_text"),
        "prompt_length": F.length("prompt_text"),
    }
    return found.select(*_fields(events, schemas.SILVER_PROMPTS, computed))


def responses(events: DataFrame, dedupe: bool = True) -> DataFrame:
    found = events.filter(F.col("event_name") == "assistant_response")
    if dedupe:
        found = unique_events(found, ["session_id", "prompt_id", "event_sequence"])
    tokens = [F.col(c) for c in ("completion_tokens", "output_tokens") if c in events.columns]
    computed = {
        "response_sk": _key(events, "response", "session_id", "prompt_id", "event_sequence"),
        "model_name": F.col("model"),
        "response_text": redact("response_text"),
        "response_length": F.length("response_text"),
        "completion_tokens": F.coalesce(*tokens) if tokens else F.lit(None),
    }
    return found.select(*_fields(events, schemas.SILVER_RESPONSES, computed))


def tool_executions(events: DataFrame, dedupe: bool = True) -> DataFrame:
    """Decisions and results; ``event_name`` tells them apart."""
    found = events.filter(F.col("event_name").isin(*schemas.TOOL_EVENTS))
    if dedupe:
        found = unique_events(found, ["session_id", "event_sequence", "tool_name"])
    computed = {
        "tool_event_sk": _key(events, "tool", "session_id", "event_sequence", "tool_name"),
        "tool_input": redact("tool_input") if "tool_input" in events.columns else F.lit(None),
        "tool_output": redact("tool_output") if "tool_output" in events.columns else F.lit(None),
    }
    return found.select(*_fields(events, schemas.SILVER_TOOL_EXECUTIONS, computed))


def token_costs(events: DataFrame, prices: dict[str, Price] | None = None, dedupe: bool = True) -> DataFrame:
    """One priced row per response. De-duplicated, or a re-delivery would inflate the spend.

    ``cost_units`` is the reported cost, else the price list's, as everywhere; ``list_cost_units`` is always the list's.
    """
    found = events.filter(F.col("event_name") == "assistant_response")
    if dedupe:
        found = unique_events(found, ["session_id", "prompt_id", "event_sequence"])
    computed = {
        "response_sk": _key(events, "response", "session_id", "prompt_id", "event_sequence"),
        "model_name": F.col("model"),
        "cost_units": reported_or_priced(events, prices),
        "list_cost_units": cost_units(prices, model="model"),
        **{c: F.coalesce(F.col(c), F.lit(0)) for c in events.columns if c.endswith("_tokens")},
    }
    return found.select(*_fields(events, schemas.SILVER_TOKEN_COSTS, computed))


def session_parts(events: DataFrame) -> DataFrame:
    """Session measures that can be merged: minima, maxima and counts.

    Grouped by the text attributes as well, so that only fixed-width values are aggregated:
    a minimum over text would make Spark sort all events instead of hashing them. Rows
    without a session are left out: they belong to no session.
    """
    name = F.col("event_name")
    return (
        events.filter(F.col("session_id").isNotNull())
        .groupBy("session_id", "user_email", "department")
        .agg(
            F.min("event_timestamp").alias("session_start"),
            F.max("event_timestamp").alias("session_end"),
            count_if(name == "user_prompt").alias("total_prompts"),
            count_if(name == "assistant_response").alias("total_responses"),
            count_if(name.isin(*schemas.TOOL_EVENTS)).alias("total_tool_calls"),
        )
    )


def merge_sessions(parts: DataFrame) -> DataFrame:
    """Sessions from parts, for instance of many micro-batches: late events need no recompute."""
    merged = parts.groupBy("session_id").agg(
        F.min("user_email").alias("user_email"),
        F.min("department").alias("department"),
        F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"),
        F.sum("total_prompts").alias("total_prompts"),
        F.sum("total_responses").alias("total_responses"),
        F.sum("total_tool_calls").alias("total_tool_calls"),
    )
    duration = epoch_seconds(F.col("session_end")) - epoch_seconds(F.col("session_start"))
    return merged.withColumn("session_duration_sec", duration)


def sessions(events: DataFrame) -> DataFrame:
    return merge_sessions(session_parts(events))


def sessions_by_user(events: DataFrame) -> DataFrame:
    """Sessions per (session, organisation, user) with token and cost totals.

    The user's address and the version are grouping keys first, as in ``session_parts``.
    """
    name = F.col("event_name")
    texts = [c for c in ("user_email", "app_version") if c in events.columns]
    priced = events.withColumn("cost_units", reported_or_priced(events))
    return (
        priced.filter(F.col("session_id").isNotNull())
        .groupBy("session_id", "org_id", "user_account_uuid", *texts)
        .agg(
            F.min("event_timestamp").alias("started_at"),
            F.max("event_timestamp").alias("last_event_at"),
            count_if(name == "user_prompt").alias("prompt_count"),
            count_if(name == "assistant_response").alias("response_count"),
            count_if(name.isin(*schemas.TOOL_EVENTS)).alias("tool_call_count"),
            sum_long("input_tokens").alias("total_input_tokens"),
            sum_long("output_tokens").alias("total_output_tokens"),
            sum_long("cost_units").alias("total_cost_units"),
        )
        .groupBy("session_id", "org_id", "user_account_uuid")
        .agg(
            *[F.min(c).alias(c) for c in texts],
            F.min("started_at").alias("started_at"),
            F.max("last_event_at").alias("last_event_at"),
            *[F.sum(c).alias(c) for c in ("prompt_count", "response_count", "tool_call_count", "total_input_tokens",
                                          "total_output_tokens", "total_cost_units")],
        )
    )


def users(events: DataFrame) -> DataFrame:
    """User dimension. Rolled up per session first, so the distinct count sees few rows."""
    per_session = (
        events.filter(F.col("user_account_uuid").isNotNull())
        .groupBy("user_account_uuid", "session_id", "user_email", "department")
        .agg(
            F.min("event_timestamp").alias("first_seen"),
            F.max("event_timestamp").alias("last_seen"),
            F.count("*").alias("events"),
        )
    )
    return per_session.groupBy("user_account_uuid").agg(
        F.min("user_email").alias("user_email"),
        F.min("department").alias("department"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.count_distinct("session_id").alias("sessions"),
        F.sum("events").alias("events"),
    )


def facts(events: DataFrame, dedupe: bool = True) -> dict[str, DataFrame]:
    """The four fact tables of one set of events."""
    return {
        "prompts": prompts(events, dedupe),
        "responses": responses(events, dedupe),
        "tool_executions": tool_executions(events, dedupe),
        "token_costs": token_costs(events, dedupe=dedupe),
    }


def table_counts(events: DataFrame) -> DataFrame:
    """Rows each silver table gets, from one pass: an event names the tables it feeds."""
    name = F.col("event_name")
    tables = F.array_compact(
        F.array(
            F.when(name == "user_prompt", F.lit("prompts")),
            F.when(name == "assistant_response", F.lit("responses")),
            F.when(name == "assistant_response", F.lit("token_costs")),
            F.when(name.isin(*schemas.TOOL_EVENTS), F.lit("tool_executions")),
            F.when(F.col("session_id").isNotNull(), F.lit("sessions")),
        )
    )
    fed = events.select("session_id", F.explode(tables).alias("table_name"))
    per_session = fed.groupBy("table_name", "session_id").agg(F.count("*").alias("n"))
    return per_session.groupBy("table_name").agg(
        F.sum(F.when(F.col("table_name") == "sessions", 1).otherwise(F.col("n"))).cast("bigint").alias("row_count")
    )
