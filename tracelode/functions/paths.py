"""Canonical fields and where they may sit in a raw record.

One pass over the record, then a coalesce per field over four physical shapes: flat snake columns,
flat dotted keys, an ``attributes`` object (dotted or nested), and ``body.attributes``
(dotted or nested).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracelode.functions.times import as_utc


@dataclass(frozen=True)
class Field:
    """``names``: synonyms, in order. A dot separates the levels of the nested spelling."""

    type: str
    names: tuple[str, ...]


# The field names of the four shapes.
FIELDS: dict[str, Field] = {
    "event_name": Field("string", ("event_name", "event.name")),
    "event_timestamp": Field("timestamp", ("event_timestamp", "event.timestamp")),
    "event_sequence": Field("bigint", ("event_sequence", "event.sequence")),
    "session_id": Field("string", ("session_id", "session.id")),
    "prompt_id": Field("string", ("prompt_id", "prompt.id")),
    "message_uuid": Field("string", ("message_uuid", "message.uuid")),
    "tool_use_id": Field("string", ("tool_use_id", "tool.use_id")),
    "org_id": Field("string", ("org_id", "org.id")),
    "pipeline_environment": Field("string", ("pipeline_environment", "pipeline.environment")),
    "user_account_uuid": Field("string", ("user_account_uuid", "user.account_uuid")),
    "user_email": Field("string", ("user_email", "user.email")),
    "department": Field("string", ("department", "org.department")),
    "app_version": Field("string", ("app_version", "app.version")),
    "model": Field("string", ("model", "model.name")),
    "prompt_text": Field("string", ("prompt_text", "user_prompt", "prompt", "prompt.text")),
    "prompt_length": Field("bigint", ("prompt_length",)),
    "prompt_tokens": Field("bigint", ("prompt_tokens", "prompt.token_count")),
    "response_text": Field("string", ("response_text", "response", "assistant_response", "response.text")),
    "response_length": Field("bigint", ("response_length",)),
    "completion_tokens": Field("bigint", ("completion_tokens", "response.token_count")),
    "latency_ms": Field("bigint", ("latency_ms", "response.latency_ms")),
    "tool_name": Field("string", ("tool_name", "tool.name")),
    "tool_input": Field("string", ("tool_input", "tool.input")),
    "tool_output": Field("string", ("tool_output", "tool.output")),
    "duration_ms": Field("bigint", ("duration_ms", "tool.duration_ms")),
    "exit_code": Field("int", ("exit_code", "tool.exit_code")),
    "decision": Field("string", ("decision", "tool.decision")),
    "success": Field("string", ("success",)),
    "attempt": Field("int", ("attempt",)),
    "input_tokens": Field("bigint", ("input_tokens", "tokens.input")),
    "output_tokens": Field("bigint", ("output_tokens", "tokens.output")),
    "cache_read_tokens": Field("bigint", ("cache_read_tokens", "tokens.cache_read")),
    "cache_creation_tokens": Field("bigint", ("cache_creation_tokens", "tokens.cache_creation")),
    "cost_usd": Field("double", ("cost_usd",)),
}

# Names under which one producer writes a text and another an object.
TEXT_OR_OBJECT = ("model", "prompt", "response")


def _leaf_type(field: Field, as_text: bool = False) -> str:
    return "string" if as_text or field.type == "timestamp" else field.type


def _object_type(fields: tuple[str, ...], as_text: bool = False) -> str:
    """DDL of one attribute object that holds any spelling of the fields."""
    flat: dict[str, str] = {}
    nested: dict[str, dict[str, str]] = {}
    for field in (FIELDS[f] for f in fields):
        for name in field.names:
            flat[name] = "variant" if name in TEXT_OR_OBJECT else _leaf_type(field, as_text)
            if "." in name:
                outer, inner = name.split(".")
                nested.setdefault(outer, {})[inner] = _leaf_type(field, as_text)
    members = [f"`{name}`: {kind}" for name, kind in flat.items()]
    for outer, inner in nested.items():
        if outer not in TEXT_OR_OBJECT:
            members.append(f"`{outer}`: struct<{', '.join(f'`{n}`: {k}' for n, k in inner.items())}>")
        elif outer not in flat:
            members.append(f"`{outer}`: variant")
    return f"struct<{', '.join(members)}>"


def record(payload: Column, fields: tuple[str, ...], as_text: bool = False) -> Column:
    """The record as one struct with room for the fields in all shapes: a single pass.

    A value of an unexpected type becomes NULL; it does not fail the job. ``as_text`` keeps every
    value as it is written.
    """
    inner = _object_type(fields, as_text)
    body = f"struct<name: string, timestamp: string, attributes: {inner}>"
    return F.try_variant_get(payload, "$", f"{inner[:-1]}, attributes: {inner}, body: {body}>")


def _spellings(holder: Column, field: Field, as_text: bool) -> list[Column]:
    out = []
    for name in field.names:
        flat = holder.getField(name)
        if name in TEXT_OR_OBJECT:
            is_text = F.schema_of_variant(flat) == "STRING"
            out.append(F.when(is_text, F.try_variant_get(flat, "$", "string")))
            continue
        out.append(flat)
        if "." in name:
            outer, inner = name.split(".")
            if outer in TEXT_OR_OBJECT:
                out.append(F.try_variant_get(holder.getField(outer), f"$.{inner}", _leaf_type(field, as_text)))
            else:
                out.append(holder.getField(outer).getField(inner))
    return out


def pick(rec: Column, field: str, as_text: bool = False) -> Column:
    """The first spelling of the field that has a value, as the contract type or as text."""
    body = rec.getField("body")
    found = [
        column
        for holder in (rec, rec.getField("attributes"), body.getField("attributes"))
        for column in _spellings(holder, FIELDS[field], as_text)
    ]
    if field == "event_name":
        found.append(body.getField("name"))
    if field == "event_timestamp":
        written = F.coalesce(*found, body.getField("timestamp"))
        return written if as_text else as_utc(F.try_to_timestamp(written))
    return F.coalesce(*found)


def strip_namespace(name: Column) -> Column:
    """``agent.user_prompt`` and ``user_prompt`` are the same event."""
    return F.regexp_replace(name, r"^[A-Za-z0-9_-]+\.", "")
