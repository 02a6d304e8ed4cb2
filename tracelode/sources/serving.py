"""Serving tables that receive only the days that have changed.

A table at the target is a set of days, each in the folder of the sync that brought it, and a manifest that says which. A sync compares
checksums per day with the newest manifest, writes the days that differ to a folder of its own, and then publishes a manifest, as one file, by
one rename. Readers see all of a sync or nothing of it; a sync that stops leaves a folder that no manifest names, and the next one
takes its place. Two syncs of one table at a time are not meant to be.
"""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAYS = T.StructType(
    [
        T.StructField("day", T.StringType()),
        T.StructField("sync", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("checksum", T.DecimalType(38, 0)),
        T.StructField("version", T.LongType()),
    ]
)
#: How Spark names the folder of a NULL.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class Synced(NamedTuple):
    days: int
    moved: int
    removed: int


def _newest(spark: SparkSession, target: str) -> tuple[int, dict[str | None, tuple[int, int, int]]]:
    """Version, and sync, rows and checksum of each day; -1 and nothing before the first sync."""
    path = f"{target}/_manifests"
    try:
        rows = spark.read.schema(DAYS).option("basePath", path).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1, {}
    version = rows.agg(F.max("version")).first()[0]
    days = rows.filter((F.col("version") == version) & F.col("sync").isNotNull()).collect()  # one row a day
    return version, {r["day"]: (r["sync"], r["rows"], int(r["checksum"])) for r in days}


def checksums(df: DataFrame, day: str) -> DataFrame:
    """day, rows and checksum: the same for the same rows in any order."""
    plain = sorted(f.name for f in df.schema if not isinstance(f.dataType, (T.VariantType, T.MapType)))
    total = F.sum(F.xxhash64(*plain).cast("decimal(38,0)")).cast("decimal(38,0)")
    return df.groupBy(F.col(day).cast("string").alias("day")).agg(F.count("*").alias("rows"), total.alias("checksum"))


def sync_changed(df: DataFrame, day: str, target: str) -> Synced:
    """Bring ``target`` up to ``df``, which is read twice: for the checksums, and the days that differ."""
    spark = df.sparkSession
    version, old = _newest(spark, target)
    new = {r["day"]: (r["rows"], int(r["checksum"])) for r in checksums(df, day).collect()}  # one row a day
    moved = [d for d in new if d not in old or old[d][1:] != new[d]]
    removed = [d for d in old if d not in new]
    if not moved and not removed and version >= 0:
        return Synced(len(new), 0, 0)
    version += 1
    if moved:
        text = F.col(day).cast("string")
        wanted = text.isin([d for d in moved if d is not None])
        wanted = wanted | text.isNull() if None in moved else wanted
        df.filter(wanted).write.mode("overwrite").partitionBy(day).parquet(f"{target}/data/sync={version}")
    sent = set(moved)
    rows = [(d, version if d in sent else old[d][0], n, Decimal(total)) for d, (n, total) in new.items()] or [(None, None, None, None)]
    publish(spark.createDataFrame(rows, T.StructType(DAYS.fields[:-1])), f"{target}/_manifests/version={version}")
    return Synced(len(new), len(moved), len(removed))


def publish(days: DataFrame, path: str) -> None:
    days.coalesce(1).write.mode("overwrite").parquet(path)


def read(spark: SparkSession, target: str, schema: T.StructType, day: str) -> DataFrame:
    """The table as the newest manifest has it."""
    _, days = _newest(spark, target)
    paths = [f"{target}/data/sync={sync}/{day}={_NO_DAY if d is None else d}" for d, (sync, _, _) in days.items()]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{target}/data").parquet(*paths).select(*schema.names)
