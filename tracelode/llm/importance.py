"""Target-distribution importance resampling: documents are drawn by how much likelier their features are under a target corpus.

Features are all runs of 1 to ``n`` consecutive words, joined by one space; a feature's bucket is the CRC-32 of its bytes modulo
``BUCKETS``. A bucket's gain is the logarithm of its share of the target's features over its share of the documents', in thousandths. A
document's weight is the floored mean of its features' gains; its score adds Gumbel noise from a hash of its id, so that the highest
scores are a weighted sample without replacement.

*Length-bucketed CRC matrices.* Of the features of a stretch of text, the distinct ones are grouped by length into matrices of bytes, a row
a feature. One column after another updates the CRCs of all rows, and the buckets are scattered back to where the features stand. Features
over ``WIDE`` bytes are rare and long; those go through the library's routine one by one.

*Scale.* Both corpora are read once for ``BUCKETS`` counts and the documents once more for their weights; texts are never shuffled. Ranks
come from a histogram of the scores, which are integers in a narrow range: only documents at or over the lowest drawn score are sorted,
in ranges, and each range counts on from the totals of those before it.

Words are runs without ASCII separators (``WORDS``), A-Z lower-cased. Null and empty texts have no features, weight 0. A null doc_id is hashed as an
empty string and comes after all ids in a tie. Repeated rows (same id and text) are drawn one by one, their ranks follow each other. Without
documents of enough words, or without rows, none is drawn; with an empty target all gains are those of no features. Extra columns are
not read. Whole texts are worked on, a text beyond a megabyte alone, in about thirty times its bytes.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.llm.tables import stored
from tracelode.llm.words import LOWER, chunks, hash_words, split

BUCKETS = 10_000
#: Longest feature in words, least words of a document that can be drawn, percent that are drawn.
N, LEAST_WORDS, PERCENT = 1, 20, 10
SEED = "2024"
#: Features of more bytes are hashed one by one.
WIDE = 64
#: Features of a long text that are grouped at once.
SLICE = 1 << 18

#: Separators of words: ASCII other than digits and letters.
WORDS = np.zeros(256, bool)
WORDS[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


def _crc_table() -> np.ndarray:
    """CRC-32 of each byte, by its reflected polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def crc_columns(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of a matrix of bytes, all rows together, column by column."""
    crc = np.full(len(matrix), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(matrix.T):
        crc = _CRC[(crc ^ column) & 0xFF] ^ (crc >> np.uint32(8))
    return crc ^ np.uint32(0xFFFFFFFF)


def crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each feature, a stretch of ``data``; each distinct one of a length is computed once."""
    if len(starts) > SLICE:
        cuts = range(0, len(starts), SLICE)
        return np.concatenate([crcs(data, starts[i : i + SLICE], ends[i : i + SLICE]) for i in cuts])
    out = np.zeros(len(starts), np.uint32)
    sizes = ends - starts
    names = hash_words(data, starts, ends)
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for group in np.split(order, cuts) if len(order) else []:
        size = int(sizes[group[0]])
        _, first, back = np.unique(names[group], return_index=True, return_inverse=True)
        heads = starts[group[first]]
        if size > WIDE:
            done = np.array([zlib.crc32(data[a : a + size].tobytes()) for a in heads], np.uint32)
            out[group] = done[back]
            same = np.array([data[a : a + size].tobytes() == data[h : h + size].tobytes() for a, h in zip(starts[group], heads[back])], bool)
        else:
            places = np.arange(size)
            matrix = data[heads[:, None] + places]
            out[group] = crc_columns(matrix)[back]
            same = (data[starts[group][:, None] + places] == matrix[back]).all(axis=1)
        for i in group[~same]:  # different features of one 64-bit hash
            out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes())
    return out


def features(column: pa.Array, n: int = N) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of rows: first row, words of each row, row of each feature, bucket of each feature."""
    for i, _, offsets, data in chunks(column):
        data = LOWER[data]
        starts, ends, counts = split(data, offsets, WORDS)
        if n > 1:  # the words again, one space between them
            sizes = ends - starts
            to = np.cumsum(sizes + 1) - (sizes + 1)
            line = np.full(int((sizes + 1).sum()), 0x20, np.uint8)
            at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            line[at + np.repeat(to, sizes)] = data[at + np.repeat(starts, sizes)]
            data, starts, ends = line, to, to + sizes
        rows = np.repeat(np.arange(len(counts)), counts)
        row, bucket = [], []
        for k in range(1, n + 1):
            if len(starts) < k:
                break
            whole = rows[: len(rows) - k + 1] == rows[k - 1 :]
            row.append(rows[: len(rows) - k + 1][whole])
            bucket.append(crcs(data, starts[: len(starts) - k + 1][whole], ends[k - 1 :][whole]) % BUCKETS)
        none = np.zeros(0, np.int64)
        yield i, counts, np.concatenate(row or [none]), np.concatenate(bucket or [none]).astype(np.int64)


def bucket_counts(texts: DataFrame, n: int = N) -> np.ndarray:
    """Features in each bucket, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, _, bucket in features(batch.column("text"), n):
                total += np.bincount(bucket, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    counts = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for r in counts.collect():  # at most BUCKETS
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of smoothed shares."""
    s, t = int(source.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log(((b + 1.0) * s) / ((a + 1.0) * t))) for a, b in zip(source.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, n: int = N) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, count, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for i, counts, row, bucket in features(batch.column("text"), n):
                m = len(counts)
                words[i : i + m] = counts
                count[i : i + m] = np.bincount(row, minlength=m)
                np.add.at(total, i + row, gain[bucket])
            mean = np.where(count > 0, total // np.maximum(count, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words), pa.array(count), pa.array(mean)], names=["doc_id", "n_words", "n_features", "weight"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: str = SEED) -> Column:
    """Floored thousandths of Gumbel noise from a hash of the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """``rows`` of eligible, doc_id and score with rank 1 to ``drawn``, by falling score, then rising doc_id; null for all others."""
    scores = rows.filter("eligible").groupBy("score").agg(F.count("*").alias("n"))
    left, least = drawn, None
    for r in sorted(scores.collect(), reverse=True):  # integers in a range of some ten thousand, however many documents
        if left <= 0:
            break
        left, least = left - r["n"], r["score"]
    none = F.lit(None).cast("long")
    if least is None:
        return rows.withColumn("rank", none)
    high = F.col("eligible") & (F.col("score") >= least)
    # Rows that are the same in all that is compared are told apart by their place, so that a range never has to hold all of them.
    top = rows.filter(high).withColumn("place", F.monotonically_increasing_id())
    top = top.orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "weight", "n_features", "place")
    top = top.withColumn("range", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    top = stored(top.drop("place"), "ranked")
    sizes = sorted(top.groupBy("range").agg(F.count("*").alias("n")).collect())  # one row a range
    upto = accumulate((r["n"] for r in sizes), initial=0)
    before = rows.sparkSession.createDataFrame([(r["range"], b) for r, b in zip(sizes, upto)], "range int, before long")
    top = top.join(before, "range")
    rank = F.col("before") + F.col("at") + 1
    top = top.withColumn("rank", F.when(rank <= drawn, rank))
    return rows.filter(~high).withColumn("rank", none).unionByName(top.select(*rows.columns, "rank"))


def resampled(
    docs: DataFrame, target: DataFrame, n: int = N, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: str = SEED
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, eligible, rank (null if not drawn) of every row of ``docs``."""
    gain = gains(bucket_counts(docs, n), bucket_counts(target, n))
    rows = weights(docs, gain, n).withColumn("score", F.col("weight") + noise(seed)).withColumn("eligible", F.col("n_words") >= least_words)
    rows = stored(rows, "scores")
    return ranked(rows, percent * rows.filter("eligible").count() // 100)
