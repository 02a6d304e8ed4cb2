"""Loads with a history: what a folder held when it was loaded, so that a second load takes only what is new.

The ledger has one row per file seen: its path, size, time, number of lines and a checksum of them. A file that is listed with the same path, size and
time is not opened again. Of the others the checksum is taken; lines that have been loaded from any file before are not loaded
again under a new name. A file whose lines have changed is loaded anew, and readers see its latest lines only.

A load writes its rows first and its part of the ledger then, as one file. Rows without a ledger are of a load that stopped; nobody reads
them, and the next load replaces them.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelode.sources import landing

LEDGER = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("lines", T.LongType()),
        T.StructField("checksum", T.DecimalType(38, 0)),
        T.StructField("status", T.StringType()),
        T.StructField("load_id", T.LongType()),
    ]
)
ROWS = T.StructType(
    [
        T.StructField("payload", T.VariantType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("load_id", T.LongType()),
    ]
)


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def history(spark: SparkSession, table: str) -> DataFrame:
    """All entries of the ledger of a table."""
    return _stored(spark, f"{table}/ledger", LEDGER)


def _listed(spark: SparkSession, folder: str, glob: str | None) -> DataFrame:
    """path, bytes and modified_at of the files below a folder; none is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    names = {"path": "file_path", "bytes": "file_size", "modified_at": "file_modification_time"}
    return reader.load(folder).select(*[F.col(f"_metadata.{name}").alias(own) for own, name in names.items()])


def load_new(spark: SparkSession, folder: str, table: str, glob: str | None = None) -> int:
    """Load what is new below ``folder`` into ``table``; the number of files that were loaded.

    The names of new files come to the driver, as a listing does. Of new files with the same lines the first by path is loaded.
    """
    known = history(spark, table)
    seen = known.select("path", "bytes", "modified_at").distinct()
    fresh = _listed(spark, folder, glob).join(seen, ["path", "bytes", "modified_at"], "left_anti")
    files = fresh.collect()
    if not files:
        return 0
    last = known.agg(F.max("load_id")).first()[0]
    load_id = 0 if last is None else last + 1
    paths = [f["path"] for f in files]
    text = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
    sums = text.groupBy("path").agg(
        F.count("*").alias("lines"), F.sum(F.xxhash64("value").cast("decimal(38,0)")).cast("decimal(38,0)").alias("checksum")
    )
    entries = spark.createDataFrame(files, fresh.schema).join(sums, "path", "left").fillna(0, ["lines"])
    entries = entries.withColumn("checksum", F.coalesce("checksum", F.lit(0).cast("decimal(38,0)")))
    # Lines that no path holds any more are loaded again when they come back.
    current = _current(known).select("lines", "checksum").distinct().withColumn("old", F.lit(True))
    first = F.row_number().over(Window.partitionBy("lines", "checksum").orderBy("path")) == 1
    marked = entries.join(current, ["lines", "checksum"], "left").withColumn("first", first)
    status = F.when(F.col("old"), "same").when(F.col("first"), "loaded").otherwise("same")
    marked = marked.select("path", "bytes", "modified_at", "lines", "checksum", status.alias("status"))
    marked = spark.createDataFrame(marked.collect(), T.StructType(LEDGER.fields[:-1]))  # one row a new file
    new = sorted(r["path"] for r in marked.filter("status = 'loaded'").collect())
    if new:
        rows = landing.copy_into(spark, new)
        rows.write.mode("overwrite").parquet(f"{table}/rows/load_id={load_id}")
    marked.coalesce(1).write.parquet(f"{table}/ledger/load_id={load_id}")
    return len(new)


def _current(known: DataFrame) -> DataFrame:
    """The entry that brought the lines of each path's latest entry: one for the same lines, whatever paths hold them."""
    newest = known.withColumn("rank", F.row_number().over(Window.partitionBy("path").orderBy(F.desc("load_id")))).filter("rank = 1")
    wanted = newest.select("lines", "checksum").distinct()
    brought = known.filter("status = 'loaded'").join(wanted, ["lines", "checksum"], "left_semi")
    last = Window.partitionBy("lines", "checksum").orderBy(F.desc("load_id"), "path")
    return brought.withColumn("rank", F.row_number().over(last)).filter("rank = 1").drop("rank")


def read(spark: SparkSession, table: str) -> DataFrame:
    """payload, ingested_at, file_name and load_id: the lines that the files of the folder held when they were last loaded.

    Lines are those of the latest entry of every path; a file that lost its lines to a change is not read any more, unless another
    path still has them.
    """
    held = _current(history(spark, table)).select(F.col("path").alias("file_name"), "load_id")
    return _stored(spark, f"{table}/rows", ROWS).join(held, ["file_name", "load_id"], "left_semi")


def counts(spark: SparkSession, table: str) -> DataFrame:
    """Files and lines by load and status."""
    return history(spark, table).groupBy("load_id", "status").agg(F.count("*").alias("files"), F.sum("lines").alias("lines"))
