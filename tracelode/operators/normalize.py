"""Raw records to canonical events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.functions import paths
from tracelode.functions.times import as_utc

# Extracted for every record; the rest of the contract on demand.
CORE_FIELDS = (
    "event_name", "event_timestamp", "event_sequence", "session_id", "prompt_id", "message_uuid", "tool_use_id",
    "org_id", "user_account_uuid", "user_email", "department", "app_version", "model", "prompt_text",
    "prompt_tokens", "response_text", "completion_tokens", "latency_ms", "tool_name", "tool_input", "tool_output",
    "duration_ms", "exit_code", "decision", "attempt", "input_tokens", "output_tokens", "cache_read_tokens",
    "cache_creation_tokens", "cost_usd",
)


def normalize(
    raw: DataFrame,
    payload: str = "payload",
    fields: tuple[str, ...] = CORE_FIELDS,
    ingest_time: str | None = "ingested_at",
) -> DataFrame:
    """Canonical events from a VARIANT column; all other columns are kept.

    ``event_name`` loses its namespace and defaults to ``other``, ``org_id`` to ``unknown``.
    ``event_timestamp`` falls back to the ingest time; ``reported_timestamp`` is what the record
    says. A missing session stays NULL: a default would gather all such rows under one hot key.
    """
    columns: dict[str, Column] = {f: paths.pick(F.col("_record"), f) for f in fields}
    if "event_name" in columns:
        columns["event_name"] = F.coalesce(paths.strip_namespace(columns["event_name"]), F.lit("other"))
    if "org_id" in columns:
        columns["org_id"] = F.coalesce(columns["org_id"], F.lit("unknown"))
    if "event_timestamp" in columns and ingest_time in raw.columns:
        columns["reported_timestamp"] = columns["event_timestamp"]
        columns["event_timestamp"] = F.coalesce(columns["event_timestamp"], as_utc(F.col(ingest_time)))
    kept = [c for c in raw.columns if c not in columns and c != payload]
    records = raw.withColumn("_record", paths.record(F.col(payload), fields))
    out = records.select(*kept, *[c.alias(n) for n, c in columns.items()])
    return out.withColumn("event_date", F.to_date("event_timestamp")) if "event_timestamp" in columns else out


def written_fields(raw: DataFrame, fields: tuple[str, ...], payload: str = "payload") -> DataFrame:
    """The fields as the record writes them, as text: no defaults, no types, NULL where it has none."""
    kept = [c for c in raw.columns if c not in fields and c != payload]
    records = raw.withColumn("_record", paths.record(F.col(payload), fields, as_text=True))
    columns = {f: paths.pick(F.col("_record"), f, as_text=True) for f in fields}
    if "event_name" in columns:
        columns["event_name"] = paths.strip_namespace(columns["event_name"])
    return records.select(*kept, *[c.alias(n) for n, c in columns.items()])


def parse_lines(lines: DataFrame, text: str = "line") -> DataFrame:
    """JSON text to a VARIANT ``payload``, NULL where the line is no JSON object."""
    record = F.ltrim(F.col(text), F.lit("\ufeff \t"))
    return lines.withColumn("payload", F.when(record.startswith("{"), F.try_parse_json(record)))


def drop_empty(events: DataFrame, name: str = "event_name", body: str = "body") -> DataFrame:
    """Without the records that have neither a name nor a body."""
    return events.filter(F.col(name).isNotNull() | F.col(body).isNotNull())


def upsert_attributes(events: DataFrame, values: dict[str, str], attributes: str = "attributes") -> DataFrame:
    """Set attributes on a MAP column; a value already there is replaced."""
    added = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    kept = F.map_filter(F.col(attributes), lambda key, _: ~key.isin(*values))
    return events.withColumn(attributes, F.map_concat(kept, added))


def stamp(events: DataFrame, instance: str) -> DataFrame:
    """Mark records with the time and the collector that took them in."""
    return events.withColumns({"ingestion_time": F.current_timestamp(), "collector_instance": F.lit(instance)})


# Fixed value: content limit in characters.
CONTENT_LIMIT = 61_440


def truncate_text(df: DataFrame, text: str, limit: int = CONTENT_LIMIT) -> DataFrame:
    """Cut a text column at ``limit`` characters; adds ``<text>_length`` and ``<text>_truncated``."""
    return df.withColumns(
        {
            f"{text}_length": F.length(text),
            f"{text}_truncated": F.length(text) > limit,
            text: F.substring(text, 1, limit),
        }
    )


def gate_content(df: DataFrame, switches: dict[str, bool | Column], placeholder: str = "<REDACTED>") -> DataFrame:
    """Keep a content column only where its switch is on; NULL stays NULL."""
    gated = {
        name: F.when(F.col(name).isNull(), F.lit(None))
        .when(F.lit(on) if isinstance(on, bool) else on, F.col(name))
        .otherwise(F.lit(placeholder))
        for name, on in switches.items()
    }
    return df.withColumns(gated)
