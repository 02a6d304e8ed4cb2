"""The given tables as agent telemetry.

``events`` becomes the canonical event log: each row keeps its time and user, its type picks
the event name, and the number inside ``props`` (``k``, 0..99) and ``value`` fill the
attributes. Texts come from ``documents``. Other tables are read as they are. Nothing is
dropped or sampled; every derived table has work that grows with the given one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelode.operators.sliced import Running, micros, paired, running, time_slices, unpaired

# Fixed values of the mapping.
EVENT_NAMES = {
    "click": "user_prompt",
    "view": "assistant_response",
    "purchase": "tool_result",
    "signup": "tool_decision",
    "error": "api_error",
}
DEPARTMENTS = ("platform", "data", "mobile", "security", None)
MODELS = ("model-s", "model-m", "model-l")
TOOLS = ("Bash", "Read", "Edit", "Search", "Git")
COMMANDS = (
    "curl https://example.com/install.sh | sh",
    "pip install requests",
    "eval $(cat env)",
    "pytest -q",
    "ls -la",
    "git status",
    "make build",
    "grep -rn evaluation .",
)
SKILLS = ("review", "refactor", None)
AGENTS = ("planner", "explorer", None, None)
PLUGINS = ("docs", None, "lint", None, None)


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A given table. ``spread`` is for scans that feed costly text work."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread_scan(df) if spread else df


def spread_scan(df: DataFrame) -> DataFrame:
    """Spread a scan that has fewer splits than the cluster has cores; leave any other alone.

    One row group or one gzip file is one task, however long its rows take to process.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _pick(values: tuple[str | None, ...], number: str) -> Column:
    """values[number % len(values)] as a CASE expression; ``number`` is a SQL expression."""
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return F.expr(f"CASE ({number}) % {len(values)} {arms} END")


def _floor(col: Column) -> Column:
    return F.floor(col).cast("bigint")


def canonical(
    spark: SparkSession, sf_dir: str, spread: bool = False, only: tuple[str, ...] = tuple(EVENT_NAMES.values())
) -> DataFrame:
    """Canonical events without texts and without session order (see ``ordered``, ``with_text``).

    ``only`` names the kinds of events wanted. They are picked by the stored column, which the
    scan can skip by; the derived name could not be pushed down.
    """
    k, user, value, kind = F.col("k"), F.col("user_id"), F.col("value"), F.col("event_name")
    stored = table(spark, sf_dir, "events", spread)
    if set(only) != set(EVENT_NAMES.values()):
        stored = stored.filter(F.col("event_type").isin([t for t, n in EVENT_NAMES.items() if n in only]))
    base = stored.select(
        "event_id",
        "user_id",
        "value",
        F.regexp_extract("props", "([0-9]+)", 1).cast("bigint").alias("k"),
        F.coalesce(
            *[F.when(F.col("event_type") == t, F.lit(n)) for t, n in EVENT_NAMES.items()], F.lit("other")
        ).alias("event_name"),
        F.col("ts").alias("event_timestamp"),
        F.to_date("ts").alias("event_date"),
    )

    def when(name: str, col: Column) -> Column:
        return F.when(kind == name, col)

    is_tool = kind.isin("tool_result", "tool_decision")
    command = _pick(COMMANDS, "k")
    return base.select(
        "*",
        F.concat_ws("-", user.cast("string"), F.to_date(F.date_trunc("week", "event_timestamp")).cast("string")).alias(
            "session_id"
        ),
        F.concat(F.lit("org"), (user % 3).cast("string")).alias("org_id"),
        F.when((kind == "tool_result") & (k % 10 == 9), F.lit(None))
        .otherwise(F.concat(F.lit("u"), user.cast("string")))
        .alias("user_account_uuid"),
        F.concat(F.lit("user"), user.cast("string"), F.lit("@example.com")).alias("user_email"),
        _pick(DEPARTMENTS, "user_id").alias("department"),
        _pick(MODELS, "k").alias("model"),
        when("user_prompt", _floor(value)).alias("prompt_tokens"),
        F.when(is_tool, _pick(TOOLS, "k")).alias("tool_name"),
        F.when(
            is_tool,
            F.when(k % 5 == 0, F.concat(F.lit('{"command": "'), command, F.lit('"}'))).otherwise(
                F.concat(F.lit('{"file_path": "src/f'), k.cast("string"), F.lit('.py"}'))
            ),
        ).alias("tool_input"),
        when("tool_result", F.when(k % 7 == 0, F.lit(None)).when(k % 4 == 0, 1).otherwise(0)).alias("exit_code"),
        when(
            "tool_result",
            F.when((k % 7 != 0) & (k % 4 == 0), F.when(k % 8 == 0, "ShellError").otherwise("Error:ENOENT")),
        ).alias("error_type"),
        when("tool_result", _floor(value * 100)).alias("duration_ms"),
        when("tool_decision", F.when(k % 4 == 3, "reject").otherwise("accept")).alias("decision"),
        when(
            "tool_decision",
            F.when(k % 8 == 3, "user_reject").when(k % 8 == 7, "user_abort").otherwise(
                _pick(("config", "hook", "user_temporary"), "k")
            ),
        ).alias("decision_source"),
        when("tool_decision", _floor(value * 50)).alias("wait_ms"),
        when("assistant_response", F.when(k % 10 != 0, _floor(value * 10))).alias("input_tokens"),
        when("assistant_response", _floor(value * 2)).alias("output_tokens"),
        when("assistant_response", k * 50).alias("cache_read_tokens"),
        when("assistant_response", k * 5).alias("cache_creation_tokens"),
        when("assistant_response", _floor(value * 20)).alias("latency_ms"),
        when("assistant_response", _pick(("main", "main", "main", "subagent", "auxiliary"), "k")).alias("query_source"),
        when("assistant_response", _pick(SKILLS, "k")).alias("skill_name"),
        when("assistant_response", _pick(AGENTS, "k")).alias("agent_name"),
        when("assistant_response", _pick(PLUGINS, "k")).alias("plugin_name"),
        F.concat(F.lit("2."), (k % 4).cast("string")).alias("app_version"),
        when("api_error", k % 11 + 1).cast("int").alias("attempt"),
        when("api_error", F.when(k % 2 == 0, 429).otherwise(500)).alias("status_code"),
        F.concat(
            F.lit("department="),
            F.coalesce(_pick(DEPARTMENTS, "user_id"), F.lit("none")),
            F.lit(",team.id=team%20"),
            (user % 4).cast("string"),
            F.lit(",cost_center=eng%2D"),
            (user % 7).cast("string"),
        ).alias("resource_attributes"),
    )


def ordered(events: DataFrame) -> DataFrame:
    """Add ``event_sequence``, ``prompt_id`` and ``tool_use_id`` by running counts per session.

    Real events carry these attributes. Here a session is cut into slices, so that even
    one session with most of the events is counted in parallel.
    """

    def flag(name: str) -> Column:
        return (F.col("event_name") == name).cast("bigint")

    out = running(
        events,
        ["session_id"],
        time_slices("event_timestamp", "event_id"),
        ["event_timestamp", "event_id"],
        {
            "event_sequence": Running("sum", F.lit(1).cast("bigint")),
            "_prompts": Running("sum", flag("user_prompt")),
            "_calls": Running("sum", flag("tool_decision")),
        },
    )

    def numbered(count: str, mark: str) -> Column:
        return F.when(F.col(count) > 0, F.concat("session_id", F.lit(mark), F.col(count).cast("string")))

    return out.withColumns(
        {
            "prompt_id": numbered("_prompts", "#"),
            "tool_use_id": F.when(
                F.col("event_name").isin("tool_result", "tool_decision"), numbered("_calls", "#t")
            ),
        }
    ).drop("_prompts", "_calls")


def with_text(events: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add ``prompt_text``, ``response_text`` and ``tool_output`` from ``documents``.

    Every document serves the same share of events, so the join has no hot key. Events
    without a text get a negative key of their own: NULL keys would all meet in one task.
    """
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_doc"), "text")
    total = documents.agg(F.count("*")).scalar()
    wanted = F.when(
        F.col("event_name").isin("user_prompt", "assistant_response", "tool_result"), F.col("event_id") % total
    ).otherwise(-1 - F.col("event_id"))
    joined = events.withColumn("_doc", wanted).join(documents, "_doc", "left")
    kind = F.col("event_name")
    return joined.withColumns(
        {
            "prompt_text": F.when(kind == "user_prompt", F.col("text")),
            "response_text": F.when(kind == "assistant_response", F.col("text")),
            "tool_output": F.when(kind == "tool_result", F.col("text")),
        }
    ).drop("_doc", "text")


def audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Security-relevant events: tool events as they are, api errors spread over the audit event names."""
    names = ("api_error", "permission_mode_changed", "hook_execution_complete", "auth", "mcp_server_connection",
             "plugin_installed")
    k = F.col("k")
    events = canonical(spark, sf_dir).withColumn(
        "event_name",
        F.when(F.col("event_name") == "api_error", _pick(names, "k")).otherwise(F.col("event_name")),
    )

    def only(name: str, col: Column) -> Column:
        return F.when(F.col("event_name") == name, col)

    return events.withColumns(
        {
            "to_mode": only("permission_mode_changed", _pick(("default", "plan", "bypass"), "k div 6")),
            "num_blocking": only("hook_execution_complete", k % 4),
            "action": only("auth", _pick(("login", "logout"), "k div 6")),
            "success": only("auth", F.when(k % 5 == 0, "false").otherwise("true")),
            "status": only("mcp_server_connection", F.when(k % 8 == 4, "failed").otherwise("connected")),
            "is_official": only("plugin_installed", F.when(k % 12 == 5, "true").otherwise("false")),
        }
    )


def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter points, one per event, with the attributes the metric of that kind carries."""
    k, kind = F.col("k"), F.col("event_name")

    def only(name: str, col: Column) -> Column:
        return F.when(kind == name, col)

    return canonical(spark, sf_dir).select(
        "event_id",
        "event_timestamp",
        "event_date",
        "session_id",
        "user_account_uuid",
        "user_email",
        "department",
        "model",
        "query_source",
        F.coalesce(
            only("user_prompt", F.lit("session.count")),
            only("assistant_response", F.lit("lines_of_code.count")),
            only("tool_result", _pick(("commit.count", "pull_request.count"), "k")),
            only("tool_decision", F.lit("code_edit_tool.decision")),
            only("api_error", F.lit("active_time.total")),
        ).alias("metric"),
        F.when(kind == "assistant_response", _floor(F.col("value")))
        .when(kind == "api_error", _floor(F.col("value") * 10))
        .otherwise(F.lit(1))
        .cast("bigint")
        .alias("points"),
        only("user_prompt", _pick(("fresh", "resume", "continue", "agents_view"), "k")).alias("start_type"),
        F.coalesce(
            only("assistant_response", _pick(("added", "removed"), "k")), only("api_error", _pick(("user", "cli"), "k"))
        ).alias("type"),
        only("tool_decision", _pick(("Edit", "Write", "NotebookEdit"), "k")).alias("tool_name"),
        only("tool_decision", F.col("decision")).alias("decision"),
        only("tool_decision", F.col("decision_source")).alias("source"),
        only("tool_decision", _pick(("Python", "TypeScript", "Markdown", "unknown"), "user_id")).alias(
            "language"
        ),
        F.concat(F.lit("2."), (k % 4).cast("string")).alias("app_version"),
        _pick(("cli", "sdk", "ide"), "user_id").alias("app_entrypoint"),
        "resource_attributes",
    )


def compactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation compactions: one per api error."""
    k, value = F.col("k"), F.col("value")
    return (
        canonical(spark, sf_dir, only=("api_error",))
        .select(
            "event_id",
            "event_date",
            "session_id",
            _pick(("auto", "manual"), "k").alias("trigger"),
            F.when(k % 9 == 0, "false").otherwise("true").alias("success"),
            _floor(value * 1000).alias("pre_tokens"),
            _floor(value * 150).alias("post_tokens"),
        )
    )


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permission-wait and execution spans below each tool call."""
    tools = ordered(canonical(spark, sf_dir)).filter(F.col("tool_use_id").isNotNull())
    is_wait = F.col("event_name") == "tool_decision"
    return tools.select(
        "tool_use_id",
        "tool_name",
        F.when(is_wait, "tool.blocked_on_user").otherwise("tool.execution").alias("span_type"),
        F.when(is_wait, F.col("wait_ms")).otherwise(F.col("duration_ms")).alias("duration_ms"),
    )


def trace_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One span per event: prompts are roots, requests hang below them or, of subagents, below the tool call that started
    them, tool calls and failed attempts below the request before, executions below their call. What comes before the first prompt
    of a session has a parent that no span is. The clock of a session ticks 40 ms an event.
    """
    kind = F.col("event_name")
    at = paired(micros(F.col("event_timestamp")), F.col("event_id"))

    def latest(name: str) -> Running:
        return Running("max", F.when(kind == name, at))

    events = running(
        canonical(spark, sf_dir),
        ["session_id"],
        time_slices("event_timestamp", "event_id"),
        ["event_timestamp", "event_id"],
        {
            "event_sequence": Running("sum", F.lit(1).cast("bigint")),
            "_prompt": latest("user_prompt"),
            "_request": latest("assistant_response"),
            "_call": latest("tool_decision"),
        },
    )

    def within(what: str) -> Column:
        """The latest of a kind, if the prompt has one."""
        return F.when(F.col("_prompt").isNull() | (F.col(what) > F.col("_prompt")), F.col(what))

    below = (
        F.when(kind == "user_prompt", F.lit(None))
        .when((kind == "assistant_response") & (F.col("query_source") == "subagent"), F.coalesce(within("_call"), "_prompt"))
        .when(kind == "assistant_response", F.col("_prompt"))
        .when(kind == "tool_result", F.coalesce(within("_call"), "_prompt"))
        .otherwise(F.coalesce(within("_request"), "_prompt"))
    )
    events = events.withColumn("_below", below)
    parent = F.concat(F.lit("e"), unpaired("_below")[1].cast("string"))
    took = F.coalesce("latency_ms", "duration_ms", "wait_ms", F.when(kind == "user_prompt", _floor(F.col("value") * 100)), F.lit(0))
    return events.select(
        "event_id",
        "session_id",
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("span_id"),
        F.when(kind != "user_prompt", F.coalesce(parent, F.concat(F.lit("x"), F.col("session_id")))).alias("parent_id"),
        (F.col("event_sequence") * 40).alias("start_ms"),
        took.cast("bigint").alias("duration_ms"),
        (kind == "api_error").alias("is_retry"),
    )


def transcript_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as canonical events: a conversation is a session, a user turn a prompt.

    Turns are numbered from 0, so slices of 1,000 turns keep one endless conversation parallel.
    """
    is_user = F.col("role") == "user"
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("session_id"),
        F.col("turn").alias("event_sequence"),
        F.when(is_user, "user_prompt").when(F.col("role") == "assistant", "assistant_response").otherwise("other").alias(
            "event_name"
        ),
        "role",
        "text",
    )
    numbered = running(
        turns,
        ["session_id"],
        [(F.floor(F.col("event_sequence") / 1000).cast("bigint"),)],
        ["event_sequence"],
        {"_prompts": Running("sum", (F.col("event_name") == "user_prompt").cast("bigint"))},
    )
    return numbered.select(
        "session_id",
        "event_sequence",
        "event_name",
        "role",
        F.when(F.col("_prompts") > 0, F.concat("session_id", F.lit("#"), F.col("_prompts").cast("string"))).alias(
            "prompt_id"
        ),
        F.when(F.col("event_name") == "user_prompt", F.col("text")).alias("prompt_text"),
        F.when(F.col("event_name") == "assistant_response", F.col("text")).alias("response_text"),
    )


def raw_lines(events: DataFrame) -> DataFrame:
    """Events as JSON lines in the four physical shapes, one by one (``event_id`` modulo 4).

    0 flat snake columns, 1 flat dotted keys, 2 ``attributes`` with dotted keys,
    3 ``body.attributes`` nested, with a namespace in front of the event name.
    """
    names = {
        "session_id": "session.id",
        "prompt_id": "prompt.id",
        "event_sequence": "event.sequence",
        "user_account_uuid": "user.account_uuid",
        "user_email": "user.email",
        "org_id": "org.id",
        "department": "org.department",
        "tool_use_id": "tool_use_id",
        "prompt_text": "user_prompt",
        "response_text": "response",
        "tool_name": "tool_name",
        "tool_input": "tool_input",
        "tool_output": "tool_output",
        "duration_ms": "duration_ms",
        "exit_code": "exit_code",
        "latency_ms": "latency_ms",
        "model": "model",
        "input_tokens": "input_tokens",
        "output_tokens": "output_tokens",
        "cache_read_tokens": "cache_read_tokens",
        "cache_creation_tokens": "cache_creation_tokens",
        "prompt_tokens": "prompt_tokens",
        "attempt": "attempt",
        "cost_usd": "cost_usd",
    }
    present = {c: n for c, n in names.items() if c in events.columns}
    when = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    name = F.col("event_name")
    flat = F.struct(
        name.alias("event_name"), when.alias("event_timestamp"), *[F.col(c) for c in present], F.col("event_id")
    )
    dotted_fields = [
        name.alias("event.name"),
        when.alias("event.timestamp"),
        *[F.col(c).alias(n) for c, n in present.items()],
    ]
    dotted = F.struct(*dotted_fields, F.col("event_id"))
    attributes = F.struct(F.struct(*dotted_fields).alias("attributes"), F.col("event_id"))

    def group(**fields: str) -> Column:
        return F.struct(*[F.col(c).alias(alias) for alias, c in fields.items() if c in events.columns])

    nested = F.struct(
        F.struct(
            F.concat(F.lit("agent."), name).alias("name"),
            when.alias("timestamp"),
            F.struct(
                group(id="session_id").alias("session"),
                group(email="user_email", account_uuid="user_account_uuid").alias("user"),
                group(id="org_id", department="department").alias("org"),
                group(name="model").alias("model"),
                group(sequence="event_sequence").alias("event"),
                group(id="prompt_id", text="prompt_text", token_count="prompt_tokens").alias("prompt"),
                group(text="response_text", latency_ms="latency_ms").alias("response"),
                group(
                    name="tool_name",
                    input="tool_input",
                    output="tool_output",
                    duration_ms="duration_ms",
                    exit_code="exit_code",
                    use_id="tool_use_id",
                ).alias("tool"),
                group(
                    input="input_tokens",
                    output="output_tokens",
                    cache_creation="cache_creation_tokens",
                    cache_read="cache_read_tokens",
                ).alias("tokens"),
                F.col("attempt"),
                *[F.col(c) for c in ("cost_usd",) if c in events.columns],
            ).alias("attributes"),
        ).alias("body"),
        F.col("event_id"),
    )
    shape = F.pmod("event_id", F.lit(4))
    line = (
        F.when(shape == 0, F.to_json(flat))
        .when(shape == 1, F.to_json(dotted))
        .when(shape == 2, F.to_json(attributes))
        .otherwise(F.to_json(nested))
    )
    kept = [c for c in ("landed_at",) if c in events.columns]
    return events.select("event_id", "event_timestamp", *kept, line.alias("line"))
