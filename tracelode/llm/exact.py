"""Exact dedup by composable polynomial fingerprints.

A text's fingerprint is its bytes, without ``[\\x20\\x09-\\x0D]``, read as a polynomial modulo two
primes. Chunks are hashed on their own and combined by ``h(ab) = h(a) * r**len(b) + h(b)``, so a
huge text is never held as one array of wide numbers. Texts of equal length and fingerprint are then compared chunk by
chunk; a fingerprint that stands for several texts is told apart by sha256.

Null texts count as empty, and all empty texts are equal. A null doc_id never stays before another
of the same length. Rows equal in doc_id and text are one document stored twice: they form a group, and one of them stays. No rows give
no rows; a text of any length is read in chunks; extra columns are not read, or kept as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracelode.llm.tables import document, stored, text_key, whole, whole_document
from tracelode.llm.words import SPACE, text_buffers

#: Primes below 2**31: a product of a byte and a power, summed over a chunk, stays below 2**64.
PRIMES = (2147483647, 2147483629)
RADIX = (1_000_003_957, 1_640_531_527)
CHUNK = 1 << 16

GROUP = ["length", "fp1", "fp2"]


def _falling_powers(radix: int, prime: int, n: int) -> np.ndarray:
    out, x = np.empty(n, np.uint64), 1
    for i in range(n - 1, -1, -1):
        out[i] = x
        x = x * radix % prime
    return out


def combine(left: tuple[int, int], right: tuple[int, int], radix: int, prime: int) -> tuple[int, int]:
    """Fingerprint and length of two texts put together."""
    return (left[0] * pow(radix, right[1], prime) + right[0]) % prime, left[1] + right[1]


class Fingerprinter:
    def __init__(self, primes: tuple[int, ...] = PRIMES, chunk: int = CHUNK):
        self.chunk = chunk
        self.fields = [(r % p, p, _falling_powers(r % p, p, chunk)) for r, p in zip(RADIX, primes)]

    def __call__(self, data: np.ndarray) -> list[int]:
        out = []
        for radix, prime, powers in self.fields:
            whole = (0, 0)
            for at in range(0, len(data), self.chunk):
                part = data[at : at + self.chunk]
                value = int((part * powers[self.chunk - len(part) :]).sum() % np.uint64(prime))
                whole = combine(whole, (value, len(part)), radix, prime)
            out.append(whole[0])
        return out


def fingerprints(docs: DataFrame, primes: tuple[int, ...] = PRIMES, chunk: int = CHUNK) -> DataFrame:
    """doc_id, text_key, n_chars, length (bytes), fp1, fp2 and text_sha256 of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Fingerprinter(primes, chunk)
        for batch in batches:
            offsets, data = text_buffers(batch.column("text"))
            length, prints, digests = [], [], []
            for a, b in zip(offsets[:-1], offsets[1:]):
                kept = data[a:b][~SPACE[data[a:b]]]
                length.append(len(kept))
                prints.append(hasher(kept))
                digests.append(hashlib.sha256(kept).hexdigest())
            fp = np.array(prints, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), batch.column("n_chars"), pa.array(length, pa.int64()),
                 pa.array(fp[:, 0]), pa.array(fp[:, 1]), pa.array(digests, pa.string())],
                names=["doc_id", "text_key", "n_chars", *GROUP, "text_sha256"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long"), "text", text_key(), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars")
    )
    return rows.mapInArrow(run, "doc_id long, text_key long, n_chars long, length long, fp1 long, fp2 long, text_sha256 string")


def _text_chunks(rows: DataFrame, chunk: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = text_buffers(batch.column("text"))
            row, number, part = [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                kept = data[a:b][~SPACE[data[a:b]]].tobytes()
                for k, at in enumerate(range(0, len(kept), chunk)):
                    row.append(i)
                    number.append(k)
                    part.append(kept[at : at + chunk])
            keys = batch.select(GROUP).take(pa.array(row, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*keys.columns, pa.array(number, pa.int32()), pa.array(part, pa.binary())], names=[*GROUP, "number", "part"]
            )

    return rows.mapInArrow(run, "length long, fp1 long, fp2 long, number int, part binary")


def exact_groups(docs: DataFrame, primes: tuple[int, ...] = PRIMES, chunk: int = CHUNK) -> DataFrame:
    """doc_id, text_key, keep_id, group_size, kept, text_sha256: one row per row of ``docs``.

    Of equal texts the one with the most code points stays, then the smallest doc_id.
    """
    prints = stored(fingerprints(docs, primes, chunk), "exact-prints")

    # A text of one chunk or many, of a fingerprint that occurs more than once, is compared byte by byte. Equal
    # chunks are merged on the map side, so a group of any size reaches a reducer as a few rows.
    shared = prints.groupBy(*GROUP).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    members = prints.join(shared, GROUP, "left_semi").select(document().alias("document"), *GROUP).distinct()
    texts = docs.select("doc_id", "text", text_key()).select(document().alias("document"), "text")
    texts = texts.join(members, "document").select("text", *GROUP)
    variants = _text_chunks(texts, chunk).groupBy(*GROUP, "number", "part").agg(F.count("*").alias("n"))
    mixed = variants.groupBy(*GROUP, "number").agg(F.count("*").alias("n")).filter("n > 1").select(*GROUP).distinct()

    apart = mixed.withColumn("apart", F.lit(True))
    rows = prints.join(apart, GROUP, "left").withColumn("split", F.when(F.col("apart"), F.col("text_sha256"))).drop("apart")
    rows = stored(rows, "exact-groups")

    key = [*GROUP, "split"]
    best = rows.groupBy(*key).agg(
        F.count("*").alias("group_size"),
        F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("id"), "text_key")).alias("best"),
    )
    once = rows.groupBy(*key, "doc_id", "text_key", "text_sha256").agg(F.count("*").cast("int").alias("times"))
    # A split is only null where the fingerprint stands for one text.
    key = [*GROUP, F.coalesce("split", F.lit("")).alias("split")]
    once, best = once.select("doc_id", "text_key", "text_sha256", "times", *key), best.select("group_size", "best", *key)
    joined = once.join(best, [*GROUP, "split"]).select(
        "doc_id",
        "text_key",
        F.bitwise_not("best.id").alias("keep_id"),
        "group_size",
        (F.bitwise_not("best.id").eqNullSafe(F.col("doc_id")) & (F.col("best.text_key") == once["text_key"])).alias("stays"),
        "text_sha256",
        F.explode(F.sequence(F.lit(1), "times")).alias("copy"),
    )
    return joined.select(
        "doc_id", "text_key", "keep_id", "group_size", (F.col("stays") & (F.col("copy") == 1)).alias("kept"), "text_sha256"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns."""
    stay = exact_groups(docs).filter("kept").select(document().alias("stays"))
    rows = whole(docs).withColumn("document", whole_document()).join(stay, F.col("document") == F.col("stays"))
    # A document stored twice comes twice. The join has brought its rows together, so this needs no shuffle.
    numbered = rows.withColumn("copy", F.row_number().over(Window.partitionBy("document").orderBy("document")))
    return numbered.filter("copy = 1").select("row.*")
