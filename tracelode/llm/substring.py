"""Removal of word sequences that occur more than once, by level-wise doubling.

A window is ``window`` consecutive words of one document; every word covered by a window that also starts
elsewhere goes. Windows are not compared one by one:

1. *Anchors.* Of the runs of 16 words in a window, the one with the smallest hash is its anchor.
   Equal windows have equal anchors at equal places, so windows are found through about one anchor
   per ten words, and none is missed.
2. *Doubling.* Anchors repeated at one length alone are extended to twice that length, 16, 32, 64
   words, until none survives or the length covers a window from any place between two anchors.
   An anchor repeated at that last length proves all windows inside it. One that is not repeated at a length
   that fits into its window rules the window out.
3. *Edges.* Windows that no anchor rules out and none proves (those about the ends of a shared passage) are
   counted on their own, against one occurrence of each proven stretch.

Documents that are the same words throughout are told apart first, and one of them takes part with double weight, so
a group of copies costs as much as two. Counts are sums with map-side combining and lookups are equi joins.

Null and empty texts have no words and keep the sha256 of the empty string. Repeated rows repeat each other's windows. Texts shorter than a
window keep all words; no rows give no rows. Extra columns are not read. Whole texts are worked on, a text beyond a megabyte alone, in some
thirty times its bytes. Stretches that prove windows are told apart by 128 bits, single windows by 96.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelode.llm.tables import document, stored, text_key
from tracelode.llm.words import chunks, hash_words, mix, signed, split, windows

WINDOW = 35
#: Words of a seed, at most; not more than half a window, but one.
SEED = 16


def levels(window: int, seed: int) -> list[int]:
    """Lengths above the seed: doubled until one covers a window from any place between two anchors."""
    out = [2 * seed]
    while out[-1] < 2 * window - seed:
        out.append(2 * out[-1])
    return out


def least_places(hashes: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window the place of its least seed hash, the first of equals; and the seed hashes of the text."""
    if len(hashes) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams, span = windows(hashes, seed), window - seed + 1
    at, size = np.arange(len(grams)), 1
    while size < span:
        step = min(size, span - size)
        left, right = at[:-step], at[step:]
        at = np.where(grams[left] <= grams[right], left, right)
        size += step
    return at, grams


def _anchors(least: np.ndarray) -> np.ndarray:
    """The distinct places; they never decrease from window to window."""
    return least[np.concatenate([[True], least[1:] != least[:-1]])] if len(least) else least


def _fixed(hashes: np.ndarray, at: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of exactly ``length`` words from each place, equal in every text."""
    return windows(hashes, length, seed)[at]


def _ladder(hashes: np.ndarray, at: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of ``length`` words from each place; where the text ends before, of those up to the end and their number."""
    out = np.zeros(len(at), np.uint64)
    whole = at + length <= len(hashes)
    if whole.any():
        out[whole] = _fixed(hashes, at[whole], length, seed)
    for i in np.flatnonzero(~whole):
        rest = hashes[at[i] :]
        out[i] = windows(rest, len(rest), seed)[0] ^ np.uint64(0x5851F42D4C957F2D * (len(rest) + 1) & ((1 << 64) - 1))
    return out


def ruled_out(least: np.ndarray, at: np.ndarray, level: np.ndarray, window: int) -> np.ndarray:
    """For each window, whether its anchor is unrepeated at the seed's or at another length that fits into the window."""
    own = level[np.searchsorted(at, least)]
    return (own == 0) | (least + 2 * own <= np.arange(len(least)) + window)


def _word_rows(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each row: its number, its words' hashes, the bytes around it, and where in them its words start and end."""
    for i, _, offsets, data in chunks(column):
        starts, ends, counts = split(data, offsets)
        hashes = hash_words(data, starts, ends)
        upto = np.concatenate([[0], np.cumsum(counts)])
        for k in range(len(counts)):
            a, b = upto[k], upto[k + 1]
            yield i + k, hashes[a:b], data, starts[a:b], ends[a:b]


def _second(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Another hash of each word."""
    lo = starts[0]
    return hash_words(data[lo : ends[-1]], starts - lo, ends - lo, seed=1)


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words with one space between."""
    if not len(starts):
        return b""
    return b" ".join(data[starts[0] : ends[-1]].tobytes().split())


def _surveyed(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """doc_id, text_key, n_words, kept_sha256 (of all words), same (names the word sequence), anchor places and hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, digests, names, places, prints = [], [], [], [], []
            for _, hashes, data, starts, ends in _word_rows(batch.column("text")):
                text = _joined(data, starts, ends)
                least, grams = least_places(hashes, window, seed)
                at = _anchors(least)
                n_words.append(len(starts))
                digests.append(hashlib.sha256(text).hexdigest())
                names.append(xxhash.xxh3_128_digest(text))
                places.append(at.astype(np.int32))
                prints.append(signed(grams[at]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(n_words, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(names, pa.binary()), pa.array(places, pa.list_(pa.int32())), pa.array(prints, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "n_words", "kept_sha256", "same", "at", "gram"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_key(), "text")
    schema = "doc_id long, text_key long, n_words long, kept_sha256 string, same binary, at array<int>, gram array<long>"
    return rows.mapInArrow(run, schema)


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys whose rows weigh two or more together."""
    return rows.groupBy(*keys).agg(F.sum("weight").alias("weight")).filter("weight >= 2").select(*keys)


def _extended(texts: DataFrame, lengths: list[int]) -> DataFrame:
    """row, at, weight and the hash of each length, for the repeated anchors of each text; of the last length a second one, ``g``.

    The last length is what proves windows, so it is told apart by 128 bits.
    """
    names = [f"h{n}" for n in lengths] + ["g"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, weights, hits = (batch.column(c) for c in ("row", "weight", "hit"))
            out: list[list[np.ndarray]] = [[] for _ in range(3 + len(names))]
            for i, hashes, *words in _word_rows(batch.column("text")):
                at = np.sort(hits[i].values.to_numpy()).astype(np.int64)
                made = [np.full(len(at), rows[i].as_py()), at, np.full(len(at), weights[i].as_py())]
                ladders = [*(_ladder(hashes, at, n) for n in lengths), _ladder(_second(*words), at, lengths[-1], 1)]
                for store, x in zip(out, [*made, *map(signed, ladders)]):
                    store.append(x)
            columns = [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in out]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "at", "weight", *names])

    return texts.mapInArrow(run, "row long, at long, weight long, " + ", ".join(f"{n} long" for n in names))


def _levels_of(marks, at: np.ndarray, hit: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Longest repeated length of each anchor, and whether it stands for others of that last length."""
    level, first = np.where(np.isin(at, hit), seed, 0), np.zeros(len(at), bool)
    for mark in marks.as_py() or []:
        k = np.searchsorted(at, mark["at"])
        level[k] = max(level[k], mark["level"])
        first[k] |= mark["first"]
    return level, first


def _edges(texts: DataFrame, window: int, seed: int, top: int) -> DataFrame:
    """row, at, weight, asks, h, g of the windows to count: the open ones, and one occurrence of each proven one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, weights, hits, marks = (batch.column(c) for c in ("row", "weight", "hit", "marks"))
            out: list[list[np.ndarray]] = [[] for _ in range(6)]
            for i, hashes, data, starts, ends in _word_rows(batch.column("text")):
                least, _ = least_places(hashes, window, seed)
                at, n = _anchors(least), len(least)
                level, first = _levels_of(marks[i], at, hits[i].values.to_numpy(), seed)
                proven, shown = np.zeros(n, bool), np.zeros(n, bool)
                for a, s in zip(at, np.where(level == top, 1 + first, 0)):
                    stretch = slice(a, max(a, min(a + top, len(hashes)) - window + 1))
                    if s:
                        proven[stretch] = True
                    if s == 2:
                        shown[stretch] = True
                asks = ~proven & ~ruled_out(least, at, level, window)
                places = np.flatnonzero(asks | shown)
                if len(places):
                    second = _second(data, starts, ends)
                    made = (np.full(len(places), rows[i].as_py()), places,
                            np.where(shown[places], 2, weights[i].as_py()), asks[places].astype(np.int64),
                            signed(_fixed(hashes, places, window)), signed(_fixed(second, places, window, 1)) >> 32)
                    for store, x in zip(out, made):
                        store.append(x)
            columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(t.to_pandas_dtype())) for c, t in zip(columns, kinds)],
                names=["row", "at", "weight", "asks", "h", "g"],
            )

    return texts.mapInArrow(run, "row long, at int, weight int, asks int, h long, g int")


def _cut(texts: DataFrame, window: int, seed: int, top: int, with_text: bool) -> DataFrame:
    """row, n_removed, kept_sha256, spans (first word and end of what goes) and, if wanted, the kept text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hits, marks, found = (batch.column(c) for c in ("row", "hit", "marks", "found"))
            out = []
            for i, hashes, data, starts, ends in _word_rows(batch.column("text")):
                at = _anchors(least_places(hashes, window, seed)[0])
                level, _ = _levels_of(marks[i], at, hits[i].values.to_numpy(), seed)
                change = np.zeros(len(hashes) + 1, np.int64)
                proven = at[level == top]
                proven = proven[np.minimum(proven + top, len(hashes)) - proven >= window]
                single = np.array(found[i].as_py() or [], np.int64)
                np.add.at(change, np.concatenate([proven, single]), 1)
                np.add.at(change, np.concatenate([np.minimum(proven + top, len(hashes)), single + window]), -1)
                gone = np.cumsum(change)[:-1] > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                kept = b" ".join(data[a:b].tobytes() for a, b in zip(starts[~gone], ends[~gone]))
                spans = [{"first": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])]
                out.append((rows[i].as_py(), int(gone.sum()), hashlib.sha256(kept).hexdigest(), spans, kept if with_text else None))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])),
                     pa.binary())
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)]
            columns[4] = columns[4].cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n_removed", "cut_sha256", "spans", "kept_text"])

    schema = "row long, n_removed long, cut_sha256 string, spans array<struct<first long, end long>>, kept_text string"
    return texts.mapInArrow(run, schema)


def without_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """doc_id, text_key, n_words, n_removed, kept_sha256, spans, kept_text (null unless ``with_text`` and words went)."""
    if window < 1:
        raise ValueError("a window has a word at least")
    seed = max(1, min(SEED, window // 2))
    lengths = levels(window, seed)
    top = lengths[-1]
    survey = _surveyed(docs, window, seed).withColumn("row", F.monotonically_increasing_id())
    survey = stored(survey, "survey")

    copies = survey.groupBy("same").agg(F.count("*").alias("copies"), F.min("row").alias("row"))
    copies = stored(copies, "copies")
    long_enough = survey.filter(F.col("n_words") >= window)
    taking_part = long_enough.join(copies, ["same", "row"]).withColumn("weight", F.least("copies", F.lit(2)))
    taking_part = stored(taking_part.select("row", "doc_id", "text_key", "n_words", "weight", "at", "gram"), "part")

    # Level of the seed: which anchors occur twice.
    each = taking_part.select("row", "weight", F.explode(F.arrays_zip("at", "gram")).alias("x"))
    each = each.select("row", "weight", F.col("x.at").alias("at"), F.col("x.gram").alias("gram"))
    # Stored, what is repeated is a table of its own: a join with it can be split where one key has very many rows.
    hits = each.join(stored(_repeated(each, "gram"), "repeated"), "gram", "left_semi").groupBy("row").agg(F.collect_list("at").alias("hit"))
    hopeful = stored(taking_part.select("row", "doc_id", "text_key", "weight").join(hits, "row"), "hopeful")
    texts = docs.select("doc_id", text_key(), "text").select(document().alias("document"), "text")
    hopeful = hopeful.select(document().alias("document"), "row", "weight", "hit")
    texts = stored(texts.join(hopeful, "document").drop("document"), "texts")

    # Doubling: only what is repeated at one length is counted at the next.
    alive = stored(_extended(texts, lengths), "level")
    marks = None
    for n in lengths:
        key = [f"h{n}"] if n != top else [f"h{n}", "g"]
        counted = alive.groupBy(*key).agg(F.sum("weight").alias("total"), F.min(F.struct("row", "at")).alias("first"))
        kept = alive.join(stored(counted.filter("total >= 2").select(*key, "first"), "repeated"), key)
        kept = stored(kept.withColumn("first", F.col("first") == F.struct("row", "at")), "level")
        mark = kept.select("row", F.struct("at", F.lit(n).alias("level"), "first").alias("mark"))
        marks = mark if marks is None else marks.union(mark)
        alive = kept.drop("first")
    marks = marks.groupBy("row").agg(F.collect_list("mark").alias("marks"))
    marked = texts.join(marks, "row", "left")

    # Windows that are neither proven nor ruled out.
    edges = stored(_edges(marked, window, seed, top), "edges")
    found = edges.filter("asks = 1").join(stored(_repeated(edges, "h", "g"), "repeated"), ["h", "g"], "left_semi")
    found = found.groupBy("row").agg(F.collect_set("at").alias("found"))
    # A text of double weight goes as a whole, and may have come twice.
    cut = marked.filter("weight = 1").join(found, "row", "left")
    cut = stored(_cut(cut, window, seed, top, with_text), "cut")

    rows = survey.select("row", "doc_id", "text_key", "n_words", "kept_sha256", "same")
    rows = rows.join(copies.select("same", "copies"), "same").join(cut, "row", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    whole = (F.col("copies") > 1) & (F.col("n_words") >= window)
    one_span = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_words").alias("end")))
    return rows.select(
        "doc_id",
        "text_key",
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(nothing)).otherwise(F.coalesce("cut_sha256", "kept_sha256")).alias("kept_sha256"),
        F.when(whole, one_span).otherwise(F.col("spans")).alias("spans"),
        F.when(whole, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )
