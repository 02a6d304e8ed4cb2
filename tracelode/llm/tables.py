"""The given tables, stored intermediate results, and the identity of a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelode.session import scratch_dir

#: Bits of a filter of keys: 4 MB for every executor, however many the keys. A page is what one of Spark's bitmaps holds.
FILTER_BITS, PAGE_BITS = 1 << 25, 1 << 15
#: Shuffle files go when the rows are written, not when the driver next collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: cuts lineage, survives lost executors."""
    conf, path = df.sparkSession.conf, scratch_dir(df.sparkSession, name)
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    return df.sparkSession.read.parquet(path)


def text_key() -> Column:
    """With doc_id, names a document: rows equal in both are the same text, whatever scan reads them."""
    return F.xxhash64("text").alias("text_key")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose crc32 of the id as text leaves 2 modulo 4; an id that is null is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


#: As it is read back. Were it any other, a join would cast it, and what follows would not see that its rows are together already.
_DOCUMENT = "struct<doc_id: bigint, text_key: bigint>"


def document(doc_id: str = "doc_id", key: str = "text_key") -> Column:
    """One non-null value that names a document, to join and group by; a null id equals a null id."""
    return F.struct(F.col(doc_id).cast("long").alias("doc_id"), F.col(key).alias("text_key")).cast(_DOCUMENT)


def whole(docs: DataFrame) -> DataFrame:
    """One column, ``row``, that holds all columns of a row: nothing that is added to it can clash with them."""
    names = [c.replace("`", "``") for c in docs.columns]
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))


def whole_document() -> Column:
    """``document`` of a row of ``whole``."""
    return F.struct(F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64("row.text").alias("text_key")).cast(_DOCUMENT)


def sifted(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """``rows`` with ``maybe``: whether ``key`` may be among the one column of ``keys``. Only rows without it are certain not to be.

    Every row with one of the keys has it, and of the others few, unless the keys are about as many as the bits. So an exact join with the keys
    need only move the rows that have it. ``keys`` are read here once more, so they should be stored.
    """

    def place(of: str) -> Column:
        return F.pmod(F.xxhash64(of), F.lit(FILTER_BITS))

    bits = keys.select(place(keys.columns[0]).alias("_bit")).distinct()
    bits = bits.select(F.shiftright("_bit", 15).alias("_page"), (F.col("_bit") % PAGE_BITS).alias("_bit")).repartition("_page")
    pages = bits.groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    met = rows.withColumn("_at", place(key)).withColumn("_page", F.shiftright("_at", 15)).join(F.broadcast(pages), "_page", "left")
    byte = F.substring("_bits", F.floor(F.col("_at") % PAGE_BITS / 8).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (F.col("_at") % 8).cast("int"))
    return met.withColumn("maybe", F.coalesce(bit == 1, F.lit(False))).drop("_at", "_page", "_bits")
