"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Every word shingle is hashed once. The hash's first bits choose one of BINS bins, and each bin keeps
its least hash. An empty bin takes the value of the first filled bin in a fixed random order of its own (optimal densification). Of
each bin's value the low eight bits are stored. Of two documents' bins, chance makes 1/256 equal; with that taken
out, the share of equal bins estimates the Jaccard likeness of their shingle sets.

Words are runs without ``[\\x20\\x09-\\x0D]``; a text of fewer words than a shingle has all its words as one. Null counts as
an empty text; texts without words have an empty fingerprint, are wholly like each other and not at all like others. Documents of one doc_id
follow each other by a hash of their text, so copies are neighbours. A null doc_id sorts after all others in descending order. A single
document is its own next; no rows give no rows. Extra columns are not read. Whole texts are hashed; a text has to fit in memory some thirty times.
"""

from __future__ import annotations

import random
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelode.llm.tables import stored

BINS = 128
BITS = 8
SHINGLE = 5
#: Fillers of an empty bin that are tried one by one, before all others are looked at together.
TRIES = 24
#: Bytes of text that are put in order at once; a longer document is alone in its range.
RANGE_BYTES = 1 << 27


def _orders(bins: int) -> list[list[int]]:
    """For each bin all others in a fixed random order."""
    out = []
    for b in range(bins):
        others = [x for x in range(bins) if x != b]
        random.Random(b).shuffle(others)
        out.append(others)
    return out


def _numbers(text: Column) -> Column:
    return F.split(text, ",").cast("array<int>")


def with_lanes(rows: DataFrame, text: str, name: str, bins: int = BINS, shingle: int = SHINGLE) -> DataFrame:
    """``rows`` with ``name``: the low eight bits of each bin, less 128, an empty array for a text without words."""
    shift = 64 - (bins - 1).bit_length()
    keep = [c for c in rows.columns]
    words = F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\x09-\\x0D]+"), lambda w: w != "")
    rows = rows.select(*keep, F.transform(words, lambda w: F.xxhash64(w)).alias("_w"))
    runs = F.transform(
        F.sequence(F.lit(1), F.size("_w") - (shingle - 1)),
        lambda i: F.xxhash64(*[F.element_at("_w", i + k) for k in range(shingle)]),
    )
    whole = F.array(F.xxhash64("_w"))
    shingles = F.when(F.size("_w") >= shingle, runs).when(F.size("_w") > 0, whole).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select(*keep, F.sort_array(shingles).alias("_s"))
    # Sorted, the hashes of a bin stand together, the least first.
    first = F.filter("_s", lambda x, i: (i == 0) | (F.shiftright(x, shift) != F.shiftright(F.get("_s", i - 1), shift)))
    rows = rows.select(*keep, first.alias("_m"))
    rows = rows.select(*keep, "_m", F.transform("_m", lambda x: (F.shiftright(x, shift) + bins // 2).cast("int")).alias("_b"))
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.get("_m", F.array_position("_b", b).cast("int") - 1)
    )
    dense = F.when(F.size("_m") == bins, F.col("_m")).otherwise(dense)
    rows = rows.select(*keep, F.size("_m").alias("_n"), dense.alias("_d"))
    orders = _orders(bins)
    # As text, which the optimizer turns into constant arrays: thousands of literals would be planned one by one.
    table = [_numbers(F.lit(",".join(str(o[k]) for o in orders))) for k in range(min(TRIES, bins - 1))]
    every = F.split(F.lit(";".join(",".join(map(str, o)) for o in orders)), ";")
    filled = F.transform(
        "_d",
        lambda x, b: F.coalesce(
            x,
            *[F.get("_d", F.get(t, b)) for t in table],
            F.get(F.filter(F.transform(_numbers(F.get(every, b)), lambda p: F.get("_d", p)), lambda v: v.isNotNull()), F.lit(0)),
        ),
    )
    filled = F.when(F.col("_n") < bins, filled).otherwise(F.col("_d"))
    lanes = F.when(F.col("_n") == 0, F.array().cast("array<tinyint>")).otherwise(
        F.transform(filled, lambda x: (x.bitwiseAND(F.lit((1 << BITS) - 1)) - 128).cast("tinyint"))
    )
    return rows.select(*keep, lanes.alias(name))


def packed(lanes: str | Column) -> Column:
    """Two hexadecimal digits per bin."""
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x.cast("int") + 128)), 2, "0")), "")


def likeness(left: str, right: str, bins: int = BINS) -> Column:
    """Estimated Jaccard likeness from the stored bits, chance matches taken out; 0 to 1."""
    equal = F.size(F.filter(F.arrays_zip(F.col(left).alias("l"), F.col(right).alias("r")), lambda x: x["l"] == x["r"]))
    chance = 1.0 / (1 << BITS)
    estimate = (equal / bins - chance) / (1 - chance)
    return (
        F.when((F.size(left) == 0) & (F.size(right) == 0), 1.0)
        .when((F.size(left) == 0) | (F.size(right) == 0), 0.0)
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), estimate)))
    )


class Ranges(NamedTuple):
    """The least key of each range of documents, in order. Keys are (no id, ~doc_id, text_key), so that ids fall."""

    bounds: list[tuple[int, int, int]]

    def _bound(self, at: Column) -> Column:
        columns = (F.split(F.lit(",".join(str(b[k]) for b in self.bounds)), ",").cast("array<bigint>") for k in range(3))
        return F.struct(*[F.get(c, at).alias(n) for c, n in zip(columns, KEY)])

    def of(self, key: Column) -> Column:
        """Number of the range that holds a key, by halving."""
        steps = [1 << j for j in range((len(self.bounds) - 1).bit_length() - 1, -1, -1)]
        if not steps:
            return F.lit(0)

        def step(at: Column, size: Column) -> Column:
            return F.when((at + size < len(self.bounds)) & (self._bound(at + size) <= key), at + size).otherwise(at)

        return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)

    def begins(self, part: Column, key: Column) -> Column:
        return self._bound(part) == key


KEY = ("none", "down", "text_key")


def _key() -> list[Column]:
    none = F.col("doc_id").isNull()
    return [none.cast("long").alias("none"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("down"), F.xxhash64("text").alias("text_key")]


def _ranges(keys: DataFrame, range_bytes: int) -> Ranges:
    """Ranges of about ``range_bytes``, and no fewer than a shuffle has partitions. The driver gets one key a range."""
    spark = keys.sparkSession
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // range_bytes))
    dealt = keys.select(*KEY).repartitionByRange(count, *KEY)  # a count that is asked for is not merged at run time
    least = dealt.withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.min(F.struct(*KEY)).alias("least"))
    return Ranges(sorted(tuple(r["least"]) for r in least.collect()) or [(0, 0, 0)])


def _described(rows: DataFrame) -> DataFrame:
    """The result columns of rows of doc_id, text, lanes, next_text and next_lanes."""
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    keep = [c for c in ("doc_id", "text_key") if c in rows.columns]
    rows = rows.select(*keep, F.length("text").cast("long").alias("n_chars"), "lanes", "next_lanes", edited.alias("edited"))
    rows = with_lanes(rows, "edited", "edited_lanes")
    return rows.select(
        *keep,
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        packed("lanes").alias("fingerprint"),
        packed("edited_lanes").alias("edited_fingerprint"),
        likeness("lanes", "edited_lanes").alias("near_edited"),
        likeness("lanes", "next_lanes").alias("near_next"),
    )


def _repeated(keys: DataFrame) -> DataFrame:
    """id, text_key, first (one of the rows) of the documents that come more than once."""
    seen = keys.groupBy("doc_id", "text_key").agg(F.count("*").alias("n"), F.min("row").alias("first")).filter("n > 1")
    return stored(seen.select(F.col("doc_id").alias("id"), F.col("text_key").alias("again"), "first"), "repeated")


def neighbours(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and both likenesses; columns as the contract names them.

    Keys alone are read first. They are cut into ranges of about ``range_bytes`` of text in the order of the documents; each
    range is ordered on its own, so the texts are shuffled once. The document that begins a range goes to the range
    before as well, the first of all to the last range.

    Of documents that come more than once only one takes part. Its copies follow each other, so each of the others is its own
    next; their rows are made from the keys.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keys = rows.select("doc_id", *_key(), F.octet_length("text").cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"))
    keys = stored(keys, "keys")
    rows = rows.select("doc_id", "text", *_key())
    again = _repeated(keys)
    repeats = not again.isEmpty()
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("again"))
    if repeats:
        once = rows.join(again, same, "left_semi").groupBy("doc_id", *KEY).agg(F.any_value("text").alias("text"))
        rows = rows.join(again, same, "left_anti").unionByName(once)
    ranges = _ranges(keys.dropDuplicates(KEY) if repeats else keys, range_bytes)
    rows = with_lanes(rows, "text", "lanes").withColumn("part", ranges.of(F.struct(*KEY)))
    last = len(ranges.bounds) - 1
    before = F.when(F.col("part") == 0, last).otherwise(F.col("part") - 1)
    own = F.struct(F.col("part"), F.lit(False).alias("copy"))
    places = F.when(ranges.begins(F.col("part"), F.struct(*KEY)), F.array(own, F.struct(before.alias("part"), F.lit(True).alias("copy"))))
    rows = rows.withColumn("place", F.explode(places.otherwise(F.array(own)))).select("doc_id", "text", *KEY, "lanes", "place.*")

    order = Window.partitionBy("part").orderBy("copy", *KEY)
    rows = rows.withColumn("next_text", F.lead("text").over(order)).withColumn("next_lanes", F.lead("lanes").over(order))
    out = _described(rows.filter(~F.col("copy")).drop("text_key"))
    if not repeats:
        return out
    alone = with_lanes(once.select("doc_id", "text_key", "text"), "text", "lanes")
    alone = _described(alone.withColumn("next_text", F.col("text")).withColumn("next_lanes", F.col("lanes")))
    alone = alone.withColumnsRenamed({"doc_id": "id", "text_key": "again"})
    copies = keys.select("doc_id", "text_key", "row").join(again, same & (F.col("row") != F.col("first")), "left_semi")
    return out.unionByName(copies.join(alone, same).select(*out.columns))
