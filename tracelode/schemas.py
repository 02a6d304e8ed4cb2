"""Table contracts."""

from __future__ import annotations

from pyspark.sql import types as T

# The event names of the contract, and its required fields.
EVENT_NAMES = (
    "user_prompt",
    "assistant_response",
    "api_request",
    "api_error",
    "api_request_body",
    "api_response_body",
    "tool_result",
    "tool_decision",
    "session_start",
    "other",
)
REQUIRED_FIELDS = ("event_name", "event_timestamp", "session_id", "org_id")
TOOL_EVENTS = ("tool_decision", "tool_result")


def _table(**fields: str) -> T.StructType:
    types = {
        "string": T.StringType(),
        "long": T.LongType(),
        "int": T.IntegerType(),
        "double": T.DoubleType(),
        "ts": T.TimestampNTZType(),
        "date": T.DateType(),
        "variant": T.VariantType(),
        "binary": T.BinaryType(),
        "instant": T.TimestampType(),
    }
    return T.StructType([T.StructField(name, types[kind], True) for name, kind in fields.items()])


BRONZE = _table(
    payload="variant",
    event_name="string",
    ingested_at="instant",
    source_file="string",
    ingest_year="int",
    ingest_month="int",
    ingest_day="int",
)

SILVER_PROMPTS = _table(
    prompt_sk="string",
    session_id="string",
    prompt_id="string",
    event_sequence="long",
    event_timestamp="ts",
    org_id="string",
    user_account_uuid="string",
    user_email="string",
    department="string",
    model_name="string",
    prompt_text="string",
    prompt_length="int",
    prompt_tokens="long",
)

SILVER_RESPONSES = _table(
    response_sk="string",
    session_id="string",
    prompt_id="string",
    message_uuid="string",
    event_sequence="long",
    event_timestamp="ts",
    org_id="string",
    user_email="string",
    model_name="string",
    response_text="string",
    response_length="int",
    completion_tokens="long",
    latency_ms="long",
)

SILVER_TOOL_EXECUTIONS = _table(
    tool_event_sk="string",
    session_id="string",
    prompt_id="string",
    event_sequence="long",
    event_timestamp="ts",
    org_id="string",
    user_account_uuid="string",
    user_email="string",
    event_name="string",
    tool_name="string",
    tool_input="string",
    tool_output="string",
    decision="string",
    duration_ms="long",
    exit_code="int",
)

SILVER_TOKEN_COSTS = _table(
    response_sk="string",
    session_id="string",
    user_email="string",
    department="string",
    event_timestamp="ts",
    model_name="string",
    input_tokens="long",
    output_tokens="long",
    cache_creation_tokens="long",
    cache_read_tokens="long",
    cost_units="long",
    list_cost_units="long",
)

SILVER_SESSIONS = _table(
    session_id="string",
    user_email="string",
    department="string",
    session_start="ts",
    session_end="ts",
    total_prompts="long",
    total_responses="long",
    total_tool_calls="long",
    session_duration_sec="long",
)

SILVER = {
    "prompts": SILVER_PROMPTS,
    "responses": SILVER_RESPONSES,
    "tool_executions": SILVER_TOOL_EXECUTIONS,
    "token_costs": SILVER_TOKEN_COSTS,
}


def processed(schema: T.StructType) -> T.StructType:
    """A table as a job wrote it, with the time of the job."""
    return T.StructType([*schema, *_table(processed_at="instant")])


def stored(schema: T.StructType) -> T.StructType:
    """A silver fact table as stored: by batch and day."""
    return T.StructType([*processed(schema), *_table(batch_id="long", event_date="date")])


SESSION_PARTS = T.StructType([*[f for f in SILVER_SESSIONS if f.name != "session_duration_sec"], *_table(batch_id="long")])

SESSION_DAYS = _table(
    session_id="string",
    org_id="string",
    user_account_uuid="string",
    usage_date="date",
    prompts="long",
    responses="long",
    tool_events="long",
    input_tokens="long",
    output_tokens="long",
    cost_units="long",
    batch_id="long",
)

DURATIONS = _table(hour="ts", model="string", durations="binary", requests="long", batch_id="long")

TOOL_COUNTS = _table(
    window_start="ts", window_end="ts", tool_name="string", results="long", duration_ms="long", batch_id="long"
)
