"""Landed JSON lines: batch and stream readers with audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelode.functions import paths
from tracelode.operators.normalize import parse_lines


def _with_audit(lines: DataFrame) -> DataFrame:
    now = F.current_timestamp()
    return lines.select(
        F.col("value").alias("line"),
        now.alias("ingested_at"),
        F.col("_metadata.file_path").alias("source_file"),
        F.year(now).alias("ingest_year"),
        F.month(now).alias("ingest_month"),
        F.dayofmonth(now).alias("ingest_day"),
    )


def event_name(payload: Column) -> Column:
    """The name alone, as a real column: only a column can be pruned by statistics."""
    return paths.strip_namespace(paths.pick(paths.record(payload, ("event_name",)), "event_name"))


def with_payload(lines: DataFrame) -> DataFrame:
    """Parse each line once; ``payload`` is NULL for a malformed one."""
    return parse_lines(lines).withColumn("event_name", event_name(F.col("payload")))


def read_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Batch read of all files, plain or gzip. A gzip file is one task, whatever its size."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _with_audit(reader.text(path))


def stream_lines(
    spark: SparkSession,
    path: str,
    max_files: int = 1000,
    glob: str | None = None,
    max_bytes: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """The same as a stream that takes up to ``max_files`` new files, or ``max_bytes``, per micro-batch.

    With ``archive`` finished files are moved there, so that the driver's listing of the landing
    stays as short as what is new.
    """
    limit = ("maxBytesPerTrigger", max_bytes) if max_bytes else ("maxFilesPerTrigger", str(max_files))
    reader = spark.readStream.option(*limit).option("recursiveFileLookup", "true")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _with_audit(reader.text(path))


def copy_into(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Batch load into (payload, ingested_at, file_name); malformed lines are left out. ``loads`` keeps a history of what was loaded."""
    parsed = with_payload(read_lines(spark, path, glob))
    return parsed.filter(F.col("payload").isNotNull()).select(
        "payload", "ingested_at", F.col("source_file").alias("file_name")
    )


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """Raw request and response bodies, one JSON document per file.

    ``body_ref`` is the file path, as the events name it. Documents are read one per row; the
    number of files per task is up to Spark's split packing.
    """
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return files.select(
        F.col("_metadata.file_path").alias("body_ref"),
        F.regexp_extract("_metadata.file_name", r"\.(request|response)\.json$", 1).alias("kind"),
        F.octet_length("value").cast("bigint").alias("body_length"),
        F.try_parse_json("value").alias("payload"),
    )


def rescued(lines: DataFrame, known: list[str], text: str = "line") -> DataFrame:
    """Top-level attributes outside the contract, as a map of JSON texts in ``_rescued``."""
    attributes = F.from_json(F.col(text), "map<string,string>")
    return lines.withColumn("_rescued", F.map_filter(attributes, lambda key, _: ~key.isin(known)))
