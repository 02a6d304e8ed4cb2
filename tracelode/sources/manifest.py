"""Which files a stored table is made of: merging of small files, and what may be deleted.

A stream leaves one folder per micro-batch and day. ``compact`` rewrites the small files of finished batches as few large
ones below ``_compacted`` and then publishes a manifest: the list of the files that stand for all batches up to one. Readers take
the files of the newest manifest and the folders of later batches, so they see the old files or the new ones, never both. A manifest is
one file, which appears by one rename; a run that stops before leaves files that no manifest names, and nobody reads them.

Replaced files stay until ``expired`` lists them as old enough for every reader to have moved on; ``delete`` removes them. One job at
a time may compact a table.
"""

from __future__ import annotations

import uuid
from contextlib import AbstractContextManager, nullcontext
from datetime import datetime
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelode.session import scratch_dir

FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("upto", T.LongType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("version", T.LongType()),
    ]
)
#: A merged file has about so many bytes; a file of half of that or more is left alone.
TARGET_BYTES = 128 << 20


class Snapshot(NamedTuple):
    """A published version: its files stand for all batches up to ``upto``."""

    version: int
    upto: int
    paths: list[str]


def published(spark: SparkSession, path: str) -> DataFrame | None:
    """The files of every version, None if there is no version yet."""
    try:
        return spark.read.schema(FILES).option("basePath", f"{path}/_manifests").parquet(f"{path}/_manifests")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def snapshot(spark: SparkSession, path: str) -> Snapshot | None:
    """The newest version. Its list of files comes to the driver, as the listing of a folder does."""
    rows = published(spark, path)
    newest = rows.agg(F.max("version")).first()[0] if rows is not None else None
    if newest is None:
        return None
    files = rows.filter(F.col("version") == newest).select("path", "upto").collect()
    return Snapshot(newest, files[0]["upto"], [f["path"] for f in files if f["path"]])


def _parts(spark: SparkSession, path: str, schema: T.StructType, batches: tuple[int | None, int | None] = (None, None)) -> list[DataFrame]:
    """The table as parts that each read one kind of files, of the batches after the first and up to the second number."""
    after, upto = batches
    now = snapshot(spark, path)
    wanted = F.lit(True)
    for number, test in ((after, F.col("batch_id").__gt__), (upto, F.col("batch_id").__le__)):
        wanted = wanted if number is None else wanted & test(number)
    out = []
    later = spark.read.schema(schema).parquet(path)
    out.append(later.filter(wanted if now is None else wanted & (F.col("batch_id") > now.upto)))
    if now is not None:
        merged = [p for p in now.paths if "/_compacted/" in p]
        alone = [p for p in now.paths if "/_compacted/" not in p]
        for files, base in ((merged, f"{path}/_compacted"), (alone, path)):
            if files:
                out.append(spark.read.schema(schema).option("basePath", base).parquet(*files).filter(wanted))
    return out


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that a stream writes: the newest version and the batches after it. Its schema has ``batch_id``."""
    parts = [p.select(*schema.names) for p in _parts(spark, path, schema)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _files(parts: list[DataFrame], partitions: list[str]) -> DataFrame:
    """path, bytes, rows and partition values of the files; only their footers are read."""
    found = None
    for part in parts:
        own = part.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"), *partitions)
        own = own.groupBy("path", "bytes", *partitions).agg(F.count("*").alias("rows"))
        found = own if found is None else found.unionByName(own)
    return found


def plan(files: DataFrame, partitions: list[str], target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``files`` with ``bin``: small files of a partition, in the order of their paths, filled into bins of about ``target_bytes``.

    NULL for a file that stays: a large one, or the only one of its bin.
    """
    small = F.col("bytes") * 2 < target_bytes
    before = Window.partitionBy(*partitions, "small").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("bytes").over(before), F.lit(0))
    bins = files.withColumn("small", small).withColumn("bin", F.when(F.col("small"), F.floor(filled / target_bytes)))
    together = F.count("*").over(Window.partitionBy(*partitions, "small", "bin"))
    return bins.withColumn("bin", F.when((together > 1) & F.col("bin").isNotNull(), F.col("bin"))).drop("small")


def checksum(rows: DataFrame) -> tuple[int, int]:
    """Number of rows, and the sum of their hashes: the same for the same rows in any order and any files."""
    plain = [f.name for f in rows.schema if not isinstance(f.dataType, (T.VariantType, T.MapType))]
    total = F.sum(F.xxhash64(*sorted(plain)).cast("decimal(38,0)"))
    found = rows.agg(F.count("*").alias("n"), total.alias("s")).first()
    return found["n"], int(found["s"] or 0)


class Compaction(NamedTuple):
    files_before: int
    files_after: int
    rows: int
    #: The version published, None if there was nothing to merge.
    version: int | None


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partitions: list[str],
    upto: int | None = None,
    target_bytes: int = TARGET_BYTES,
    checks: AbstractContextManager[None] | None = None,
) -> Compaction:
    """Merge the small files of the batches up to ``upto``, then publish the new version.

    By default the newest batch stays out, since it may still be being written; a later batch shows that the ones before are
    complete. The rewritten rows are compared by checksum before they are published, inside ``checks`` if given.
    """
    now = snapshot(spark, path)
    if upto is None:
        newest = spark.read.schema(schema).parquet(path).agg(F.max("batch_id")).first()[0]
        upto = -1 if newest is None else newest - 1
    if now is not None:
        upto = max(upto, now.upto)
    parts = _parts(spark, path, schema, (None, upto))
    planned = plan(_files(parts, partitions), partitions, target_bytes)
    kept = scratch_dir(spark, "compaction")
    planned.write.parquet(kept)
    planned = spark.read.schema(planned.schema).parquet(kept)
    before = planned.agg(F.count("*").alias("n"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count("bin").alias("small")).first()
    if not before["small"]:
        return Compaction(before["n"], before["n"], before["rows"], None)

    moving = planned.filter("bin is not null").select(F.col("path").alias("_path"), "bin")
    rows = None
    for part in parts:
        own = part.select(*schema.names, F.col("_metadata.file_path").alias("_path")).join(moving, "_path").drop("_path")
        rows = own if rows is None else rows.unionByName(own)
    run = f"{path}/_compacted/run={uuid.uuid4().hex}"
    dealt = rows.repartition(*partitions, "bin").drop("bin") if partitions else rows.repartition("bin").drop("bin")
    writer = dealt.write
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(run)
    written = spark.read.schema(schema).option("basePath", f"{path}/_compacted").parquet(run)
    with checks or nullcontext():
        if checksum(written.select(*schema.names)) != checksum(rows.select(*schema.names)):
            raise RuntimeError(f"{run} does not hold the rows of the files it replaces; nothing was published")
    new = _files([written], partitions)
    files = planned.filter("bin is null").drop("bin").unionByName(new)
    version = 0 if now is None else now.version + 1
    publish(spark, path, files, upto, version)
    after = snapshot(spark, path)
    return Compaction(before["n"], len(after.paths), before["rows"], version)


def publish(spark: SparkSession, path: str, files: DataFrame, upto: int, version: int) -> None:
    """The new version, as one file, which appears by one rename."""
    rows = files.select("path", "bytes", "rows", F.lit(upto).cast("bigint").alias("upto"), F.current_timestamp().alias("published_at"))
    rows.coalesce(1).write.parquet(f"{path}/_manifests/version={version}")


def expired(spark: SparkSession, path: str, as_of: datetime | Column) -> DataFrame:
    """Folders that no reader needs any more: folder, reason. ``as_of``: versions replaced before it have no readers left.

    A batch folder may go if a version stands for it and no version in use names a file in it; a merged run, if no version in use
    names a file in it and a later version has been published. Without a version nothing may go.
    """
    rows = published(spark, path)
    if rows is None:
        return spark.createDataFrame([], "folder string, reason string")
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    # Before the first version readers took all folders as they were: a version of no batches.
    times = rows.groupBy("version").agg(F.max("published_at").alias("at"), F.max("upto").alias("upto"))
    first = spark.createDataFrame([(-1, -1)], "version long, upto long").select("version", F.lit(None).cast("timestamp").alias("at"), "upto")
    replaced = F.lead("at").over(Window.orderBy("version"))  # one row a version
    times = times.unionByName(first).withColumn("replaced_at", replaced)
    in_use = times.filter(F.col("replaced_at").isNull() | (F.col("replaced_at") >= moment))
    covered = in_use.agg(F.min("upto")).first()[0]
    folder = F.regexp_extract("path", r"/((?:_compacted/run|batch_id)=[^/]*)/", 1)
    named = rows.filter(F.col("path").isNotNull()).select("version", folder.alias("folder")).distinct()
    needed = named.join(in_use.select("version"), "version", "left_semi").select("folder").distinct()
    batches = spark.read.schema("batch_id bigint").parquet(path).filter(F.col("batch_id") <= covered).select("batch_id").distinct()
    batches = batches.select(F.concat(F.lit("batch_id="), F.col("batch_id").cast("string")).alias("folder"), F.lit("merged").alias("reason"))
    runs = named.filter(F.col("folder").startswith("_compacted")).select("folder", F.lit("replaced").alias("reason")).distinct()
    return batches.unionByName(runs).join(needed, "folder", "left_anti")


def delete(spark: SparkSession, path: str, folders: DataFrame, dry_run: bool = True) -> list[str]:
    """Remove the folders below ``path``; a dry run only names them. One call of the file system a folder."""
    names = sorted(r["folder"] for r in folders.select("folder").collect())
    if not dry_run:
        jvm = spark._jvm
        for name in names:
            target = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return names
