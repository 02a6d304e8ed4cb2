"""The jobs a scheduler calls: bronze, silver, gold, serving. Each can be run again at any time."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelode import schemas
from tracelode.operators import audit, gold, silver, usage
from tracelode.operators.normalize import normalize
from tracelode.session import InTurn, configure, together
from tracelode.sources import manifest, serving, sinks
from tracelode.streaming import bronze as bronze_stream
from tracelode.streaming import silver as silver_stream

FACT_TABLES = tuple(schemas.SILVER)


def run_bronze(spark: SparkSession, landing: str, root: str, glob: str = "*.jsonl.gz", max_files: int = 1000) -> None:
    configure(spark)
    bronze_stream.ingest(spark, landing, f"{root}/bronze", f"{root}/_checkpoints/bronze", max_files, glob)


def run_silver(
    spark: SparkSession,
    root: str,
    watermark: str = "1 day",
    max_files: int = 1000,
    files_per_day: int | None = None,
) -> None:
    """New bronze rows, without re-deliveries, into the silver tables."""
    configure(spark)
    events = silver_stream.once(silver_stream.bronze_events(spark, f"{root}/bronze", max_files), watermark)
    silver_stream.fan_out(events, lambda name: f"{root}/silver/{name}", f"{root}/_checkpoints/silver", files_per_day)


def read_silver(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The silver tables. Their schemas are given: a table without rows yet has no files to ask."""
    tables = {
        name: manifest.read(spark, f"{root}/silver/{name}", schemas.stored(schema)) for name, schema in schemas.SILVER.items()
    }
    tables["sessions"] = silver_stream.read_sessions(spark, f"{root}/silver/session_parts")
    tables["session_days"] = silver_stream.read_session_days(spark, f"{root}/silver/session_days")
    return tables


#: Tables that grow by a folder per micro-batch, and the columns they are partitioned by below it.
BATCH_TABLES: dict[str, tuple[T.StructType, list[str]]] = {
    **{name: (schemas.stored(schema), ["event_date"]) for name, schema in schemas.SILVER.items()},
    "session_parts": (schemas.SESSION_PARTS, []),
    "session_days": (schemas.SESSION_DAYS, []),
}


def run_compaction(
    spark: SparkSession, root: str, upto: int | None = None, target_bytes: int = manifest.TARGET_BYTES
) -> dict[str, manifest.Compaction]:
    """Merge the small files that the batches of the silver stream have left. Readers and the stream may go on meanwhile.

    Each table is a compaction of its own; they run at the same time. Their checks take turns, and once one fails no other
    table passes.
    """
    checks = InTurn()
    merges = [
        partial(manifest.compact, spark, f"{root}/silver/{name}", schema, partitions, upto, target_bytes, checks)
        for name, (schema, partitions) in BATCH_TABLES.items()
    ]
    return dict(zip(BATCH_TABLES, together(spark, merges), strict=True))


def run_retention(spark: SparkSession, root: str, as_of: datetime, dry_run: bool = True) -> dict[str, list[str]]:
    """Folders that fall due: replaced silver files after 30 days, quarantined lines after 30 days. A dry run only names them.

    What a version in use names is never among them: the manifest decides, not the age of a folder.
    """
    day = audit.RETENTION_DAYS
    out = {}
    for name in BATCH_TABLES:
        path = f"{root}/silver/{name}"
        due = manifest.expired(spark, path, as_of - timedelta(days=day["silver_history"]))
        out[f"silver/{name}"] = manifest.delete(spark, path, due, dry_run)
    quarantine = audit.expired_quarantine(spark.read.parquet(f"{root}/bronze"), as_of.date())
    out["bronze"] = manifest.delete(spark, f"{root}/bronze", quarantine, dry_run)
    return out


def gold_tables(tables: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, str]]:
    """Gold tables with the date each is partitioned by. Transcripts are stored masked."""
    lines = _masked_lines(tables["prompts"], tables["responses"])
    return {
        "daily_user_metrics": (gold.daily_user_metrics(tables["sessions"]), "usage_date"),
        "tool_adoption_summary": (gold.tool_adoption_summary(tables["tool_executions"]), "execution_date"),
        "department_cost_attribution": (gold.department_cost_attribution(tables["token_costs"]), "cost_date"),
        "security_leak_alerts": (gold.stored_leak_alerts(tables), "alert_date"),
        "daily_user_usage": (usage.daily_usage(tables["session_days"]), "usage_date"),
        "compliance_transcript_lines": (lines, "prompt_date"),
    }


def _masked_lines(prompts: DataFrame, responses: DataFrame) -> DataFrame:
    lines = usage.transcript_lines(audit.masked_transcript(prompts), audit.masked_transcript(responses))
    return lines.withColumn("prompt_date", F.to_date("prompt_ts"))


def _only_days(rows: DataFrame, days: DataFrame, day: str) -> DataFrame:
    """Rows of the given days. Reduced to one row per day, the days are small enough for Spark to
    broadcast by itself; on a partition column the scan then skips all other partitions."""
    return rows.join(days.select(F.col("day").alias(day)).distinct(), day, "left_semi")


def _of_sessions(rows: DataFrame, sessions: DataFrame) -> DataFrame:
    return rows.join(sessions.select("session_id").distinct(), "session_id", "left_semi")


def _start_days(parts: DataFrame, changed: DataFrame, since_batch: int) -> DataFrame:
    """The days the changed sessions start on now, and those they started on before."""
    of_changed = _of_sessions(parts, changed)
    before = F.when(F.col("batch_id") < since_batch, F.col("session_start"))
    starts = of_changed.groupBy("session_id").agg(F.min("session_start").alias("now"), F.min(before).alias("before"))
    both = starts.select(F.explode(F.array("now", "before")).alias("start"))
    return both.filter(F.col("start").isNotNull()).select(F.to_date("start").alias("day")).distinct()


def touched_gold(
    spark: SparkSession, root: str, tables: dict[str, DataFrame], since_batch: int
) -> dict[str, tuple[DataFrame, str]]:
    """Gold cut to the days that batches from ``since_batch`` on have changed, each complete.

    A late event changes its own old day, and through its session the day the session
    started, the days the session's usage falls on, and the prompts of the session.
    """

    def new(df: DataFrame) -> DataFrame:
        return df.filter(F.col("batch_id") >= since_batch)

    cut = {}
    for name in FACT_TABLES:
        cut[name] = _only_days(tables[name], new(tables[name]).select(F.col("event_date").alias("day")), "event_date")

    def stored(name: str, schema: T.StructType) -> DataFrame:
        return manifest.read(spark, f"{root}/silver/{name}", schema)

    parts = stored("session_parts", schemas.SESSION_PARTS)
    changed = new(parts).select("session_id")
    started = tables["sessions"].withColumn("day", F.to_date("session_start"))
    start_days = _start_days(parts, changed, since_batch)
    cut["sessions"] = _only_days(started, start_days, "day").drop("day")

    days = tables["session_days"]
    usage_days = _of_sessions(days, changed).select(F.col("usage_date").alias("day"))
    cut["session_days"] = _of_sessions(days, _only_days(days, usage_days, "usage_date"))

    # All responses of the sessions whose prompts are shown again lie between the first start
    # and the last end of those sessions; no other partition of the responses is read.
    prompt_days = _of_sessions(tables["prompts"], changed).select(F.col("event_date").alias("day"))
    asked = _only_days(tables["prompts"], prompt_days, "event_date")
    span = _of_sessions(tables["sessions"], asked)
    first, last = (span.agg(F.to_date(f(c))).scalar() for f, c in ((F.min, "session_start"), (F.max, "session_end")))
    answers = tables["responses"].filter(F.col("event_date").between(first, last))

    out = gold_tables(cut)
    out["daily_user_usage"] = (_only_days(out["daily_user_usage"][0], usage_days, "usage_date"), "usage_date")
    out["compliance_transcript_lines"] = (_masked_lines(asked, _of_sessions(answers, asked)), "prompt_date")

    # A day of alerts is made of three tables; all three are read for a day that any of them has changed.
    texts = ("prompts", "responses", "tool_executions")
    alert_days = None
    for name in texts:
        touched = new(tables[name]).select(F.col("event_date").alias("day")).distinct()
        alert_days = touched if alert_days is None else alert_days.union(touched)
    complete = {name: _only_days(tables[name], alert_days, "event_date") for name in texts}
    out["security_leak_alerts"] = (gold.stored_leak_alerts(complete), "alert_date")
    return out


def run_gold(spark: SparkSession, root: str, since_batch: int | None = None) -> None:
    """Recompute gold, or only the days that changed since a silver batch.

    Then only the partitions of those days are replaced. A late event can move the start of
    the only session of a day to the day before; the partition left without rows is emptied.
    """
    tables = read_silver(spark, root)
    if since_batch is None:
        for name, (df, date) in gold_tables(tables).items():
            sinks.write_table(df, f"{root}/gold/{name}", [date], stamp=True)
        return
    out = touched_gold(spark, root, tables, since_batch)
    for name, (df, date) in out.items():
        sinks.write_table(df, f"{root}/gold/{name}", [date], only_touched=True, stamp=True)
    parts = manifest.read(spark, f"{root}/silver/session_parts", schemas.SESSION_PARTS)
    changed = parts.filter(F.col("batch_id") >= since_batch).select("session_id")
    left = _start_days(parts, changed, since_batch).join(
        tables["sessions"].select(F.to_date("session_start").alias("day")).distinct(), "day", "left_anti"
    )
    df, date = out["daily_user_metrics"]
    sinks.empty_partitions(df, f"{root}/gold/daily_user_metrics", date, left)


def run_sync(
    spark: SparkSession, root: str, target: Callable[[str], dict[str, str]], format: str = "parquet"
) -> list[str]:
    """Gold tables, sessions and costs to the serving store."""
    stored = read_silver(spark, root)
    tables = {
        name: spark.read.schema(schemas.processed(df.schema)).parquet(f"{root}/gold/{name}")
        for name, (df, _) in gold_tables(stored).items()
    }
    tables |= {"sessions": stored["sessions"], "token_costs": stored["token_costs"]}
    return sinks.sync_tables(tables, target, format)


def run_sync_changed(spark: SparkSession, root: str, target: str) -> dict[str, serving.Synced]:
    """The same tables to files below ``target``, only the days that differ from what is there."""
    stored = read_silver(spark, root)
    out = {}
    for name, (df, date) in gold_tables(stored).items():
        table = spark.read.schema(schemas.processed(df.schema)).parquet(f"{root}/gold/{name}").drop("processed_at")
        out[name] = serving.sync_changed(table, date, f"{target}/{name}")
    sessions = stored["sessions"].withColumn("start_date", F.to_date("session_start"))
    out["sessions"] = serving.sync_changed(sessions, "start_date", f"{target}/sessions")
    out["token_costs"] = serving.sync_changed(stored["token_costs"].drop("processed_at"), "event_date", f"{target}/token_costs")
    return out


def sessions_from_scratch(spark: SparkSession, root: str) -> DataFrame:
    """Sessions recomputed from bronze: what the merged parts must equal."""
    return silver.sessions(normalize(bronze_stream.read_bronze(spark, f"{root}/bronze")))
