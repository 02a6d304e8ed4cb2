"""Incremental ingest of landed JSON lines into bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelode.sources import landing

PARTITIONS = ["malformed", "ingest_year", "ingest_month", "ingest_day"]


def ingest(
    spark: SparkSession,
    source: str,
    bronze: str,
    checkpoint: str,
    max_files: int = 1000,
    glob: str | None = None,
    max_bytes: str | None = None,
    archive: str | None = None,
) -> None:
    """Take in all files not seen yet, then stop.

    Each micro-batch replaces its own ``batch_id=N`` folder, so a batch that is run again
    after a failure leaves no second copy. Malformed lines are set aside below
    ``malformed=1`` by the same write: one parse, one pass, nothing kept in memory.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = landing.with_payload(batch)
        malformed = F.col("payload").isNull()
        out = parsed.withColumn("malformed", malformed.cast("int")).withColumn("line", F.when(malformed, F.col("line")))
        out.write.mode("overwrite").partitionBy(*PARTITIONS).parquet(f"{bronze}/batch_id={batch_id}")

    query = (
        landing.stream_lines(spark, source, max_files, glob, max_bytes, archive)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    return spark.read.parquet(bronze).filter("malformed = 0").drop("line", "malformed")


def read_quarantine(spark: SparkSession, bronze: str) -> DataFrame:
    return spark.read.parquet(bronze).filter("malformed = 1").drop("payload", "event_name", "malformed")
