"""Contract checks, redaction statistics, verdicts, role views, retention, security signals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.functions import redact as r
from tracelode.functions.keys import surrogate_key
from tracelode.functions.times import epoch_seconds, utc_column
from tracelode.schemas import EVENT_NAMES, REQUIRED_FIELDS

INTEGER_FIELDS = ("event_sequence", "prompt_length", "response_length", "input_tokens", "output_tokens",
                  "cache_read_tokens", "cache_creation_tokens")


#: Every field that ``with_violations`` looks at.
CONTRACT_FIELDS = (*REQUIRED_FIELDS, *INTEGER_FIELDS, "cost_usd")


def with_violations(records: DataFrame) -> DataFrame:
    """Check string-typed records against the event contract.

    ``violations`` is a comma-separated list in a fixed order, '' for a valid record.
    """
    checks: list[Column] = []
    for field in REQUIRED_FIELDS:
        checks.append(F.when(F.col(field).isNull(), F.lit(f"missing:{field}")))
    checks.append(F.when(~F.col("event_name").isin(*EVENT_NAMES), F.lit("enum:event_name")))
    time = F.col("event_timestamp")
    checks.append(F.when(time.isNotNull() & F.try_to_timestamp(time).isNull(), F.lit("format:event_timestamp")))
    for field in INTEGER_FIELDS:
        if field in records.columns:
            value = F.col(field)
            checks.append(F.when(value.isNotNull() & value.try_cast("bigint").isNull(), F.lit(f"type:{field}")))
    if "cost_usd" in records.columns:
        value = F.col("cost_usd")
        checks.append(F.when(value.isNotNull() & value.try_cast("double").isNull(), F.lit("type:cost_usd")))
    return records.withColumn("violations", F.concat_ws(",", *checks))


def split_valid(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    checked = with_violations(records)
    return checked.filter("violations = ''").drop("violations"), checked.filter("violations <> ''")


def violation_counts(records: DataFrame) -> DataFrame:
    found = with_violations(records).select(F.explode(F.split("violations", ",")).alias("violation"))
    return found.filter("violation <> ''").groupBy("violation").agg(F.count("*").alias("records"))


def length_mismatches(df: DataFrame, text: str, declared: str) -> DataFrame:
    """Rows whose declared length is not the length of the text."""
    actual = F.length(text)
    return df.filter(actual != F.col(declared)).withColumn("actual_length", actual)


def redaction_counts(
    df: DataFrame, text: str, by: list[str], rules: tuple[r.Rule, ...] = r.SECRET_RULES
) -> DataFrame:
    """Hits and texts hit, per rule and group. One pass over the texts, then a small unpivot."""
    found = df.select(*by, r.hits(text, rules).alias("_hits")).select(
        *by, *[F.col("_hits")[i].cast("bigint").alias(f"_{rule.name}") for i, rule in enumerate(rules)]
    )
    sums = found.groupBy(*by).agg(
        *[
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.sum(f"_{rule.name}").alias("hits"),
                F.count_if(F.col(f"_{rule.name}") > 0).alias("texts"),
            ).alias(rule.name)
            for rule in rules
        ]
    )
    return sums.select(*by, F.inline(F.array(*[rule.name for rule in rules])))


def verdicts(
    prompts: DataFrame, text: str, rules: tuple[r.Rule, ...] = r.SECRET_RULES + r.PERSONAL_RULES
) -> DataFrame:
    """Allow or deny each prompt. ``reason`` is the first rule that matched, ``matched`` all of
    them. The log carries no text."""
    matched = r.matched_rules(text, rules)
    return prompts.select(
        *[c for c in prompts.columns if c != text],
        matched.alias("_matched"),
    ).select(
        *[c for c in prompts.columns if c != text],
        F.array_join("_matched", ",").alias("matched"),
        F.when(F.size("_matched") > 0, "deny").otherwise("allow").alias("verdict"),
        F.get("_matched", F.lit(0)).alias("reason"),
    )


def shadow_report(judged: DataFrame) -> DataFrame:
    """What enforcement would deny, per rule."""
    hit = judged.filter("verdict = 'deny'").select(F.explode(F.split("matched", ",")).alias("rule"), "reason")
    return hit.groupBy("rule").agg(
        F.count("*").alias("would_deny"),
        F.count_if(F.col("reason") == F.col("rule")).alias("as_first_reason"),
    )


# What each role may read. '*' stands for every table of the layer.
ROLE_GRANTS = {
    "executive": ("executive_daily_kpis", "tool_adoption_matrix", "department_cost_view"),
    "security_audit": ("prompt_leak_audit", "silver.*"),
    "data_engineering": ("*",),
}
TEXT_COLUMNS = ("prompt_text", "response_text", "tool_input", "tool_output", "flagged_text", "flagged_content_snippet")


def view_for_role(role: str, table: str, df: DataFrame) -> DataFrame:
    """The table as the role may see it; a table outside its grants is refused."""
    layer = table.split(".")[0] + ".*"
    if not {"*", table, layer} & set(ROLE_GRANTS.get(role, ())):
        raise PermissionError(f"{role} may not read {table}")
    if role == "executive":
        return df.drop(*TEXT_COLUMNS)
    return df


def masked_transcript(rows: DataFrame) -> DataFrame:
    """Prompts, responses or transcript lines for export: users as keys, texts without secrets and personal data.

    Best before prompts and responses are joined: afterwards a prompt's text is masked once for each response.
    """
    masks = {
        "user_account_uuid": F.when(F.col("user_account_uuid").isNotNull(), surrogate_key("user_account_uuid")),
        **{c: r.redact(c, r.SECRET_RULES + r.PERSONAL_RULES) for c in ("prompt_text", "response_text")},
    }
    return rows.withColumns({c: mask for c, mask in masks.items() if c in rows.columns})


# Days after which something falls due.
RETENTION_DAYS = {"cool": 7, "archive": 90, "quarantine": 30, "stage": 3, "bronze_history": 7, "silver_history": 30}


def expired_quarantine(bronze: DataFrame, as_of: date) -> DataFrame:
    """Folders of malformed lines that are due for deletion: folder, reason. Only partition columns are read."""
    day = F.make_date("ingest_year", "ingest_month", "ingest_day")
    old = bronze.filter((F.col("malformed") == 1) & (F.datediff(F.lit(as_of), day) > RETENTION_DAYS["quarantine"]))
    names = ("batch_id", "malformed", "ingest_year", "ingest_month", "ingest_day")
    folder = F.concat_ws("/", *[F.concat(F.lit(f"{n}="), F.col(n).cast("string")) for n in names])
    return old.select(folder.alias("folder"), F.lit("quarantine").alias("reason")).distinct()


def retention(partitions: DataFrame, as_of: Column | date, day: str = "event_date") -> DataFrame:
    """Lifecycle action per day partition: raw tiers, and what is due for deletion elsewhere."""
    end = as_of if isinstance(as_of, Column) else F.lit(as_of)
    aged = partitions.withColumn("age_days", F.datediff(end, day))
    age = F.col("age_days")
    due = {name: age > days for name, days in RETENTION_DAYS.items()}
    return aged.withColumns(
        {
            "raw_tier": F.when(due["archive"], "archive").when(due["cool"], "cool").otherwise("hot"),
            "quarantine_action": F.when(due["quarantine"], "purge").otherwise("keep"),
            "stage_action": F.when(due["stage"], "purge").otherwise("keep"),
            "bronze_history": F.when(due["bronze_history"], "vacuum").otherwise("keep"),
            "silver_history": F.when(due["silver_history"], "vacuum").otherwise("keep"),
        }
    )


# Command patterns worth a review.
RISKY_COMMANDS = {
    "download": r"\b(?:curl|wget)\b",
    "package_install": r"\bpip3?\s+install\b",
    "dynamic_code": r"\beval\b",
}


def risky_commands(tools: DataFrame) -> DataFrame:
    """Tool calls whose command matches a risky pattern, one row per pattern."""
    command = F.get_json_object("tool_input", "$.command")
    risks = F.array_compact(F.array(*[F.when(command.rlike(p), F.lit(n)) for n, p in RISKY_COMMANDS.items()]))
    return tools.filter(command.isNotNull()).select(
        "event_id", "event_date", "session_id", "user_email", "tool_name", command.alias("command"),
        F.explode(risks).alias("risk"),
    )


def security_signals(events: DataFrame) -> DataFrame:
    """Events behind the audit questions, by day and signal, in one pass: what was refused and what went through."""
    name = F.col("event_name")
    rules = {
        "tool_call_denied": (name == "tool_decision") & (F.col("decision") == "reject"),
        "permission_escalation": (name == "permission_mode_changed") & (F.col("to_mode") == "bypass"),
        "hook_blocked": (name == "hook_execution_complete") & (F.col("num_blocking") > 0),
        "auth_failure": (name == "auth") & (F.col("success") == "false"),
        "login": (name == "auth") & (F.col("success") == "true") & (F.col("action") == "login"),
        "logout": (name == "auth") & (F.col("success") == "true") & (F.col("action") == "logout"),
        "mcp_server_failure": (name == "mcp_server_connection") & (F.col("status") == "failed"),
        "mcp_server_connected": (name == "mcp_server_connection") & (F.col("status") == "connected"),
        "unofficial_plugin": (name == "plugin_installed") & (F.col("is_official") == "false"),
        "official_plugin": (name == "plugin_installed") & (F.col("is_official") == "true"),
        "command_run": (name == "tool_result") & (F.col("tool_name") == "Bash"),
        "command_rejected": (name == "tool_decision") & (F.col("decision") == "reject") & (F.col("tool_name") == "Bash"),
        "file_touched": (name == "tool_result") & F.get_json_object("tool_input", "$.file_path").isNotNull(),
    }
    allowed = (name == "tool_decision") & (F.col("decision") == "accept")
    by_source = F.when(allowed, F.concat(F.lit("tool_call_allowed:"), F.coalesce("decision_source", F.lit("unknown"))))
    signals = F.array_compact(F.array(by_source, *[F.when(rule, F.lit(signal)) for signal, rule in rules.items()]))
    per_user = (
        events.select("event_date", "user_email", F.explode(signals).alias("signal"))
        .groupBy("event_date", "signal", "user_email")
        .agg(F.count("*").alias("n"))
    )
    return per_user.groupBy("event_date", "signal").agg(
        F.sum("n").alias("events"), F.count("user_email").alias("users")
    )


def ingest_lag(events: DataFrame, ingested_at: str, breach_seconds: int, by: list[str]) -> DataFrame:
    """Lag between event and ingest: exact median and 95th percentile, maximum, breaches.

    Lags are whole seconds. They are counted per distinct value first, so a group with most
    of the rows sends one row per value to the percentile.
    """
    lag = epoch_seconds(utc_column(events, ingested_at)) - epoch_seconds(utc_column(events, "event_timestamp"))
    histogram = events.select(*by, lag.alias("lag")).groupBy(*by, "lag").agg(F.count("*").alias("n"))
    return histogram.groupBy(*by).agg(
        F.sum("n").alias("events"),
        F.round(F.percentile("lag", 0.5, F.col("n")), 3).alias("p50_seconds"),
        F.round(F.percentile("lag", 0.95, F.col("n")), 3).alias("p95_seconds"),
        F.max("lag").alias("max_seconds"),
        F.sum(F.when(F.col("lag") > breach_seconds, F.col("n")).otherwise(0)).alias("breaches"),
    ).withColumn("breached", F.col("breaches") > 0)
