"""Table writers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelode.session import together

MAX_RECORDS_PER_FILE = 5_000_000


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    only_touched: bool = False,
    files_per_partition: int | None = None,
    stamp: bool = False,
) -> None:
    """Overwrite a parquet table; a new schema simply replaces the old one.

    ``only_touched`` replaces just the partitions the new rows belong to. Rows are not moved
    before the write unless ``files_per_partition`` asks for it; then each partition value is
    spread over that many tasks, so one large day does not end up in one task. The spread is
    a hash of the row, not a random number: a task that runs again makes the same rows.
    ``stamp`` adds the time of the job as ``processed_at``.
    """
    out = df
    if partition_by and files_per_partition:
        content = [f.name for f in df.schema if not isinstance(f.dataType, (T.VariantType, T.MapType))]
        spread = F.pmod(F.xxhash64(*content), F.lit(files_per_partition))
        out = df.withColumn("_file", spread).repartition(*partition_by, "_file").drop("_file")
    if stamp:
        out = out.withColumn("processed_at", F.current_timestamp())
    writer = out.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if only_touched:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def empty_partitions(df: DataFrame, path: str, date: str, days: DataFrame) -> None:
    """Replace the partitions of some days by empty ones: an overwrite by partition does not
    reach a day that has no new rows. ``days`` holds calendar days, one row each."""
    nothing = df.drop(date).limit(0)
    for (day,) in days.select(F.col("day").cast("string")).collect():
        nothing.write.mode("overwrite").parquet(f"{path}/{date}={day}")


def register(spark: SparkSession, name: str, path: str) -> None:
    """A temporary view over a stored table."""
    spark.read.parquet(path).createOrReplaceTempView(name)


def register_table(spark: SparkSession, database: str, name: str, path: str, schema: T.StructType,
                   partitions: list[str]) -> None:
    """A catalogue table over stored files; run again to pick up new partitions."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet {by} LOCATION '{path}'")
    if partitions:
        spark.sql(f"ALTER TABLE {database}.{name} RECOVER PARTITIONS")


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files gained columns over time: old rows have NULL in the new ones."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def sync_tables(
    tables: dict[str, DataFrame],
    target: Callable[[str], dict[str, str]],
    format: str = "parquet",
) -> list[str]:
    """Overwrite one remote table per entry. ``target`` gives the writer options of a table:
    a path for files, or url, dbtable and credentials for a warehouse connector. The tables are written at the same time."""
    if tables:
        spark = next(iter(tables.values())).sparkSession
        writers = [df.write.format(format).mode("overwrite").options(**target(name)) for name, df in tables.items()]
        together(spark, [writer.save for writer in writers])
    return list(tables)


def stage_export(df: DataFrame, path: str, day: str, format: str = "csv") -> None:
    """Extract for an external loader, below year=/month=/day=."""
    out = df.withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})
    writer = out.write.mode("overwrite").partitionBy("year", "month", "day")
    if format == "csv":
        writer = writer.option("header", "true").option("escape", '"')
    writer.format(format).save(path)
