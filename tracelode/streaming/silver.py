"""Bronze to silver as a stream."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelode import schemas
from tracelode.functions.times import as_instant, as_utc
from tracelode.operators import silver, sketches, usage
from tracelode.operators.normalize import normalize
from tracelode.session import together
from tracelode.sources import manifest
from tracelode.sources.sinks import write_table
from tracelode.streaming.bronze import PARTITIONS as BRONZE_PARTITIONS

# What a re-delivery repeats; ``told_apart`` is the reported time of events without a sequence number.
EVENT_KEY = ["session_id", "event_name", "prompt_id", "message_uuid", "event_sequence", "told_apart"]


def bronze_events(spark: SparkSession, bronze: str, max_files: int = 1000) -> DataFrame:
    """New bronze rows as canonical events. Files of malformed lines are not listed, so none of ``max_files`` is one."""
    schema = T.StructType(
        [
            T.StructField("payload", T.VariantType()),
            T.StructField("ingested_at", T.TimestampType()),
            T.StructField("source_file", T.StringType()),
            T.StructField("malformed", T.IntegerType()),
        ]
    )
    reader = spark.readStream.schema(schema).option("basePath", bronze).option("maxFilesPerTrigger", str(max_files))
    return normalize(reader.parquet(f"{bronze}/batch_id=*/malformed=0").drop("malformed"))


def once(events: DataFrame, watermark: str, keys: list[str] = EVENT_KEY) -> DataFrame:
    """Drop re-deliveries that come within ``watermark`` of the first delivery."""
    keyed = events.withColumn("told_apart", silver.told_apart_by(events)).withWatermark("ingested_at", watermark)
    return keyed.dropDuplicatesWithinWatermark(keys).drop("told_apart")


def fan_out(
    events: DataFrame,
    target: Callable[[str], str],
    checkpoint: str,
    files_per_day: int | None = None,
) -> None:
    """Write the silver tables from each micro-batch, then stop when all input is done.

    The batch is normalised once and kept while its writes run, on disk where memory does not
    hold it, without the columns of bronze that no silver table has. It is read a few times only, so packing it
    costs more than it saves. The source bounds a batch by files or bytes. The first write fills what is kept, the others
    then run at the same time. Every write replaces the batch's own folder, so a repeated batch changes nothing. ``session_parts`` and
    ``session_days`` hold mergeable measures per batch: a late event adds a part, and no
    session is recomputed.

    ``files_per_day`` is for a backfill of many days: rows are brought together by day first,
    or each task would write a small file for every day.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.conf.set("spark.sql.inMemoryColumnarStorage.compressed", "false")  # the stream's own session
        kept = batch.drop("source_file", "batch_id", *BRONZE_PARTITIONS).persist()
        try:
            writes = []
            for name, parts in (("session_parts", silver.session_parts(kept)), ("session_days", usage.session_days(kept))):
                writes.append(partial(write_table, parts, f"{target(name)}/batch_id={batch_id}"))
            for name, facts in silver.facts(kept, dedupe=False).items():
                dated = facts.withColumn("event_date", F.to_date("event_timestamp"))
                folder = f"{target(name)}/batch_id={batch_id}"
                writes.append(partial(write_table, dated, folder, ["event_date"], files_per_partition=files_per_day, stamp=True))
            writes[0]()
            together(batch.sparkSession, writes[1:])
        finally:
            kept.unpersist()

    query = (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_sessions(spark: SparkSession, parts: str) -> DataFrame:
    return silver.merge_sessions(manifest.read(spark, parts, schemas.SESSION_PARTS))


def read_session_days(spark: SparkSession, parts: str) -> DataFrame:
    return usage.merge_session_days(manifest.read(spark, parts, schemas.SESSION_DAYS))


TOOL_DAY_KEYS = ["window_start", "window_end", "tool_name"]


def tool_counts(events: DataFrame, width: str = "1 day") -> DataFrame:
    """Tool results per tool and tumbling window. Counts of several batches add up."""
    results = events.filter(F.col("event_name") == "tool_result")
    window = F.window(as_instant(F.col("event_timestamp")), width)
    return (
        results.groupBy(window.alias("w"), "tool_name")
        .agg(F.count("*").alias("results"), F.sum("duration_ms").alias("duration_ms"))
        .select(
            as_utc(F.col("w.start")).alias("window_start"),
            as_utc(F.col("w.end")).alias("window_end"),
            "tool_name",
            "results",
            "duration_ms",
        )
    )


def count_tools(events: DataFrame, target: str, checkpoint: str, width: str = "1 day") -> None:
    """Write the tool counts of each micro-batch, then stop when all input is done.

    Files do not arrive in the order of their events, so a window is never closed: a late event
    adds to its window's counts through a part of its own batch, and the result does not depend on how
    files fall into batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_table(tool_counts(batch, width), f"{target}/batch_id={batch_id}")

    query = (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_tool_counts(spark: SparkSession, parts: str) -> DataFrame:
    found = manifest.read(spark, parts, schemas.TOOL_COUNTS)
    return found.groupBy(*TOOL_DAY_KEYS).agg(F.sum("results").alias("results"), F.sum("duration_ms").alias("duration_ms"))


def sketch_durations(events: DataFrame, target: str, checkpoint: str) -> None:
    """Write hourly sketches of the request times of each micro-batch, then stop when all input is done. A late event adds a part."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_table(sketches.duration_hours(batch), f"{target}/batch_id={batch_id}")

    query = (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_durations(spark: SparkSession, parts: str) -> DataFrame:
    """hour, model, durations and requests: the sketches of all batches, merged."""
    return sketches.merged_durations(manifest.read(spark, parts, schemas.DURATIONS), "hour", "model")
