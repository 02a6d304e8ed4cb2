"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence with size-derived bounds.

A document's row of the incidence matrix holds its distinct word n-grams. Rows that are equal are
one class, and only one of them is multiplied. Two rows of sizes a and b link if they share at least
``t/(1+t) * (a+b)`` n-grams, from which bounds follow; each discards pairs before they cost more:

* *Prefix.* With the columns in one fixed order, linked rows share one of their first ``n - ceil(t*n) + 1``
  n-grams. Only rows that meet in such a column can come into one block. The order puts frequent n-grams last; it steers the cost, never the result.
* *Place and size.* What can still follow a shared n-gram, and the ratio of the sizes, must reach the bound.
* *Parity.* Each row is folded to a few bits an n-gram by the parity of the n-grams that fall on each; two rows differ in at least as many n-grams as bits.
* *Counts.* Blocks of rows are multiplied a block of columns at a time and the overlaps summed up; pairs whose count and what is left of
  the shorter row stay below the bound are dropped, and rows without a pair are left out of the columns that follow.

First every row meets one head in each of its columns, the row whose n-grams are the commonest: the original of a group of copies, as a rule. What
is not connected yet meets a head out of another part of the column. Pairs that the bounds allow make parts. The rows of a part are dealt
to blocks, each two blocks meet in one task, and only counts per row and what is connected leave it, so that a group of copies of any size gives rows in
proportion to its size. Pairs of rows of different parts that the bounds allow are compared one by one. ``join`` gives every link as a row on demand.

Null texts and texts without words have no n-grams and are linked with nothing. Texts with fewer words have
their whole word sequence as one n-gram. A null doc_id is never the smallest; a group of such rows only has a null component. Repeated
rows are one class. No rows give no rows. Extra columns are not read, or kept as they are. Texts are worked on whole, a text beyond a megabyte alone, in
about twenty times its bytes; blocks are bounded by rows and by n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelode.llm.components import components
from tracelode.llm.tables import document, sifted, stored, text_key, whole, whole_document
from tracelode.llm.words import LOWER, chunks, hash_words, mix, signed, split, windows

#: Frequent n-grams that are put last, at most: 16 bytes each are sent to every executor.
FREQUENT = 1 << 18
#: What a task reports of its own most frequent n-grams, at most.
FREQUENT_PER_TASK = 1 << 16
#: Rows of a block: of a column of the product, of candidates that are compared, of a part.
BLOCK, NEAR, PART = 512, 64, 256
#: n-grams of a block, about: it has fewer rows then.
BLOCK_GRAMS = 1 << 20
#: Columns that are multiplied at once, by rows.
_CELLS = 1 << 21
#: Rounds of heads.
ROUNDS = 2
PARITY = ("odd0", "odd1", "odd2", "odd3")
#: n-grams a task gathers before it counts them.
_GATHER = 1 << 21


def gram_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Sorted hashes of the distinct n-grams of each text, A-Z lower-cased."""
    for _, _, offsets, data in chunks(column):
        data = LOWER[data]
        starts, ends, counts = split(data, offsets)
        hashes = hash_words(data, starts, ends)
        grams = windows(hashes, n)
        at = np.cumsum(counts) - counts
        for a, size in zip(at, counts):
            if size >= n:
                yield np.unique(grams[a : a + size - n + 1])
            else:  # the number of words goes in, so that it never equals an n-gram
                yield mix(windows(hashes[a : a + size], size) ^ np.uint64(size)) if size else np.zeros(0, np.uint64)


def _merge(grams: np.ndarray, counts: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal n-grams summed up; the ``keep`` largest of two or more."""
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
    total = np.add.reduceat(counts, first) if len(first) else counts
    often = total >= 2
    grams, total = grams[first][often], total[often]
    if len(total) > keep:
        largest = np.argpartition(-total, keep)[:keep]
        grams, total = grams[largest], total[largest]
    return grams, total


def frequent_grams(docs: DataFrame, n: int, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the most frequent n-grams over all documents, and in how many documents tasks saw them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        new: list[np.ndarray] = []
        gathered = 0

        def counted():
            added = np.concatenate(new) if new else np.zeros(0, np.uint64)
            return _merge(
                np.concatenate([grams, added]), np.concatenate([counts, np.ones(len(added), np.int64)]), FREQUENT_PER_TASK
            )

        for batch in batches:
            for own in gram_sets(batch.column("text"), n):
                new.append(own)
                gathered += len(own)
                if gathered >= _GATHER:
                    grams, counts = counted()
                    new, gathered = [], 0
        grams, counts = counted()
        yield pa.RecordBatch.from_arrays([pa.array(signed(grams)), pa.array(counts)], names=["gram", "n"])

    seen = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = seen.orderBy(F.desc("n"), "gram").limit(most).toArrow()
    grams = top.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(grams)
    return grams[order], top.column("n").to_numpy()[order]


def parity(grams: np.ndarray) -> np.ndarray:
    """Two to four bits an n-gram, 256 at least, as integers: whether an odd number of n-grams falls on each."""
    bits = 1 << max(8, int(2 * len(grams) - 1).bit_length())
    odd = np.bincount(((grams >> np.uint64(20)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def folded(odd: np.ndarray) -> np.ndarray:
    """The same in 256 bits."""
    return np.bitwise_xor.reduce(odd.reshape(-1, len(PARITY)), axis=0)


def overlaps(sets: list[np.ndarray], num: int, den: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the wanted pairs link, and their overlaps: the incidence times its transpose, a block of columns after another."""
    r = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    need = -(-num * (sizes[:, None] + sizes) // (num + den))
    counts = np.zeros((r, r), np.int64)
    row = np.repeat(np.arange(r), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    row, column = row[shared], column[shared]
    left = np.bincount(row, minlength=r)
    alive = wanted & (np.minimum(left[:, None], left) >= need)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    column = np.cumsum(np.concatenate([[False], column[1:] != column[:-1]])) if len(column) else column
    width = max(64, _CELLS // r)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        rows = np.flatnonzero(alive.any(axis=0) | alive.any(axis=1))
        if not len(rows):
            break
        a, b = np.searchsorted(column, [first, first + width])
        cells = np.zeros((r, min(width, int(column[-1]) + 1 - first)), np.float32)
        cells[row[a:b], column[a:b] - first] = 1
        cells = cells[rows]
        counts[np.ix_(rows, rows)] += (cells @ cells.T).astype(np.int64)
        left = left - np.bincount(row[a:b], minlength=r)
        alive &= counts + np.minimum(left[:, None], left) >= need
    return alive & (counts >= need), counts


def common(left: np.ndarray, right: np.ndarray) -> int:
    return len(np.intersect1d(left, right, assume_unique=True))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Batches that hold runs of equal keys whole, and where each run begins and ends."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        change = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            c = batch.column(k).to_numpy(zero_copy_only=False)
            change |= c[1:] != c[:-1]
        cuts = (np.flatnonzero(change) + 1).tolist()
        last = cuts[-1] if cuts else 0
        if last:
            yield batch.slice(0, last), [0, *cuts]
        held = batch.slice(last)
    if held is not None:
        yield held, [0, held.num_rows]


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists, and where each begins and ends; a null is an empty one."""
    return column.values.to_numpy(), column.offsets.to_numpy()


def _rows(docs: DataFrame, n: int, num: int, den: int, often: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, text_key, n_shingles, same (names the set), prefix, and its parity."""
    shared = docs.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count = shared.value
        for batch in batches:
            sizes, names, prefixes, odd = [], [], [], []
            for own in gram_sets(batch.column("text"), n):
                size = len(own)
                sizes.append(size)
                names.append(xxhash.xxh3_128_digest(own.tobytes()))
                rank = np.zeros(size, np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    rank = np.where(known[at] == own, count[at], 0)
                order = np.argsort(rank, kind="stable")  # by rank, then by hash
                prefixes.append(signed(own[order[: size - -(-size * num // den) + 1]]))
                odd.append(parity(own))
            short = np.array([folded(x) for x in odd], np.int64).reshape(-1, len(PARITY))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()),
                 pa.array(prefixes, pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.int64())),
                 *[pa.array(short[:, k]) for k in range(len(PARITY))]],
                names=["doc_id", "text_key", "n_shingles", "same", "prefix", "odd", *PARITY],
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_key(), "text")
    schema = "doc_id long, text_key long, n_shingles long, same binary, prefix array<long>, odd array<long>"
    return rows.mapInArrow(run, schema + "".join(f", {c} long" for c in PARITY))


def _sets(texts: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [signed(own) for own in gram_sets(batch.column("text"), n)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sets, pa.list_(pa.int64()))], names=["row", "grams"])

    return texts.mapInArrow(run, "row long, grams array<long>")


def _near(pairs: DataFrame, light: DataFrame) -> DataFrame:
    """row, spot: rows that share the least row among their partners share a spot, or several if they are many or long."""
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    homes = both.groupBy(F.col("a").alias("row")).agg(F.least("a", F.min("b")).alias("home"))
    homes = homes.join(light.select("row", "n_shingles"), "row")
    cuts = F.ceil(F.greatest(F.count("*") / NEAR, F.sum("n_shingles") / BLOCK_GRAMS))
    many = homes.groupBy("home").agg(cuts.alias("cuts"))
    cut = F.pmod(F.xxhash64("row"), F.col("cuts"))
    return homes.join(many, "home").select("row", F.xxhash64("home", cut).alias("spot"))


def _plausible(pairs: DataFrame, rows: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that sizes and full parities do not discard. A longer parity is folded to half its length."""
    for side, name in (("a", "x"), ("b", "y")):
        own = rows.select(F.col("row").alias(side), F.struct("n_shingles", "odd").alias(name))
        pairs = pairs.join(own, side)

    def half(odd: str) -> Column:
        h = F.size(odd) / 2
        return F.zip_with(F.slice(odd, F.lit(1), h.cast("int")), F.slice(odd, (h + 1).cast("int"), h.cast("int")), lambda p, q: p.bitwiseXOR(q))

    def apart(x: str | Column, y: str | Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, k: total + k)

    m, k = F.size("x.odd"), F.size("y.odd")
    differ = F.when(m == k, apart("x.odd", "y.odd")).when(m == 2 * k, apart(half("x.odd"), "y.odd")).when(k == 2 * m, apart("x.odd", half("y.odd")))
    return pairs.filter(_may_link(F.coalesce(differ, F.lit(0)), num, den)).select("a", "b")


def _linked(pairs: DataFrame, light: DataFrame, texts: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """a, b, overlap of the pairs that link. Rows near each other meet in one block; a few pairs of it are counted one by one."""
    near = stored(_near(pairs, light), "near")
    left = pairs.join(near.select(F.col("row").alias("a"), F.col("spot").alias("x")), "a")
    left = left.join(near.select(F.col("row").alias("b"), F.col("spot").alias("y")), "b").select("x", "y", "a", "b")
    left = stored(left, "dealt")
    met = left.select("x", "y", F.col("a").alias("row")).union(left.select("x", "y", F.col("b").alias("row"))).distinct()
    met = met.join(_sets(texts.join(near, "row", "left_semi"), n), "row")
    met = met.select("x", "y", F.col("row").alias("a"), F.lit(-1).cast("long").alias("b"), "grams")
    full = met.union(left.withColumn("grams", F.lit(None).cast("array<long>")))
    full = full.repartition("x", "y").sortWithinPartitions("x", "y", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, cuts in runs(batches, ["x", "y"]):
            a, b = (batch.column(c).to_numpy() for c in ("a", "b"))
            values, at = _lists(batch.column("grams"))
            sets_upto = np.concatenate([[0], np.cumsum(b < 0)])
            out: list[tuple[int, int, int]] = []
            for low, high in zip(cuts[:-1], cuts[1:]):
                middle = low + int(sets_upto[high] - sets_upto[low])
                place = {row: i for i, row in enumerate(a[low:middle].tolist())}
                sets = [values[at[i] : at[i + 1]] for i in range(low, middle)]
                x, y = ([place[r] for r in c[middle:high].tolist()] for c in (a, b))
                if len(x) <= 2 * len(sets):
                    for i, j, p, q in zip(a[middle:high].tolist(), b[middle:high].tolist(), x, y):
                        overlap = common(sets[p], sets[q])
                        if den * overlap >= num * (len(sets[p]) + len(sets[q]) - overlap):
                            out.append((i, j, overlap))
                    continue
                wanted = np.zeros((len(sets),) * 2, bool)
                wanted[x, y] = True
                linked, counts = overlaps(sets, num, den, wanted)
                yes = linked[x, y]
                out += zip(a[middle:high][yes].tolist(), b[middle:high][yes].tolist(), counts[x, y][yes].tolist())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], names=["a", "b", "overlap"])

    return full.mapInArrow(run, "a long, b long, overlap long")


def _joined_rows(linked: np.ndarray) -> np.ndarray:
    """For each row the first row it is connected with."""
    both = linked | linked.T
    first = np.arange(len(both))
    while True:
        near = np.where(both, first, len(first)).min(axis=1, initial=len(first))
        new = np.minimum(first, near)
        new = new[new]
        if (new == first).all():
            return first
        first = new


def _inside(parts: DataFrame, texts: DataFrame, n: int, num: int, den: int, links: bool) -> DataFrame:
    """row and others (rows it links with in its part); a and b of rows that links connect, or with ``links`` a, b and overlap of each link.

    Parts are row, part, n_shingles and n (rows of the class). A part's rows are dealt to blocks. Each two blocks, and each block with
    itself, meet in one task. What leaves it grows with the rows, not with the links.
    """
    cuts = F.ceil(F.greatest(F.count("*") / PART, F.sum("n_shingles") / BLOCK_GRAMS))
    many = parts.groupBy("part").agg(cuts.alias("cuts"))
    cut = parts.join(many, "part").withColumn("cut", F.pmod(F.xxhash64("row"), F.col("cuts")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("other")
    met = cut.select("row", "part", "n", "cut", other)
    met = met.select("row", "n", "part", "cut", F.least("cut", "other").alias("i"), F.greatest("cut", "other").alias("j"))
    sets = _sets(texts.join(parts, "row", "left_semi"), n)
    full = met.join(sets, "row").repartition("part", "i", "j").sortWithinPartitions("part", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, cuts in runs(batches, ["part", "i", "j"]):
            row, size, cut, i, j = (batch.column(c).to_numpy() for c in ("row", "n", "cut", "i", "j"))
            values, at = _lists(batch.column("grams"))
            edges: list[tuple[int, int, int | None]] = []
            others = np.zeros(len(row), np.int64)
            for low, high in zip(cuts[:-1], cuts[1:]):
                sets = [values[at[k] : at[k + 1]] for k in range(low, high)]
                part = row[low:high]
                linked, counts = np.zeros((len(sets),) * 2, bool), np.zeros((len(sets),) * 2, np.int64)
                if len(sets) <= 3:
                    for p in range(len(sets)):
                        for q in range(p):
                            counts[p, q] = common(sets[p], sets[q])
                            linked[p, q] = (den + num) * counts[p, q] >= num * (len(sets[p]) + len(sets[q]))
                else:
                    side = cut[low:high]
                    wanted = (part[:, None] < part) if i[low] == j[low] else (side[:, None] == i[low]) & (side == j[low])
                    linked, counts = overlaps(sets, num, den, wanted)
                others[low:high] = linked @ size[low:high] + linked.T @ size[low:high]
                if links:
                    a, b = np.nonzero(linked)
                    edges += zip(np.minimum(part[a], part[b]).tolist(), np.maximum(part[a], part[b]).tolist(), counts[a, b].tolist())
                else:
                    first = _joined_rows(linked)
                    below = np.flatnonzero(first != np.arange(len(first)))
                    edges += zip(part[first[below]].tolist(), part[below].tolist(), [None] * len(below))
            some = np.flatnonzero(others)
            m, k = len(some), len(edges)
            columns = [pa.array(row[some]), pa.array(others[some]), *[pa.nulls(m, pa.int64())] * 3]
            yield pa.RecordBatch.from_arrays(columns, names=_INSIDE)
            if edges:
                columns = [*[pa.nulls(k, pa.int64())] * 2, *[pa.array([x[c] for x in edges], pa.int64()) for c in range(3)]]
                yield pa.RecordBatch.from_arrays(columns, names=_INSIDE)

    return full.mapInArrow(run, ", ".join(f"{c} long" for c in _INSIDE))


_INSIDE = ["row", "others", "a", "b", "overlap"]


def _may_link(apart: Column, num: int, den: int) -> Column:
    """What the sizes of x and y allow, and that they differ in ``apart`` n-grams at least."""
    a, b = F.col("x.n_shingles"), F.col("y.n_shingles")
    return (F.least(a, b) * den >= F.greatest(a, b) * num) & ((a + b - apart) * (den + num) >= (a + b) * (2 * num))


def _short_parities() -> Column:
    return sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in PARITY), F.lit(0))


def _met(cells: DataFrame, num: int, den: int) -> DataFrame:
    """a, b: pairs of different parts that share a column, within the bounds. Large columns are cut into blocks."""
    cuts = cells.groupBy("gram").agg(F.ceil(F.count("*") / BLOCK).alias("cuts"))
    cells = cells.join(cuts, "gram").withColumn("cut", F.pmod(F.xxhash64("row"), F.col("cuts")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1))
    x, y = cells.withColumn("i", F.col("cut")).withColumn("j", other).alias("x"), cells.withColumn("j", F.col("cut")).withColumn("i", other).alias("y")
    total = F.col("x.n_shingles") + F.col("y.n_shingles")
    pairs = x.join(
        y,
        (F.col("x.gram") == F.col("y.gram"))
        & (F.col("x.i") == F.col("y.i"))
        & (F.col("x.j") == F.col("y.j"))
        & (F.col("x.row") < F.col("y.row"))
        & (F.col("x.part") != F.col("y.part"))
        & (F.least("x.rest", "y.rest") * (den + num) >= total * num)
        & _may_link(_short_parities(), num, den),
    )
    return pairs.select(F.col("x.row").alias("a"), F.col("y.row").alias("b")).distinct()


def _against_heads(cells: DataFrame, num: int, den: int, again: bool) -> DataFrame:
    """a, b: in each column, rows and the head among rows of about their size; heads of neighbouring sizes.

    The head is the row whose columns hold the most rows; ``again``: out of those that the column's largest part does not hold.
    """
    step = float(np.log(den / num)) if den > num else 1.0
    sized = cells.withColumn("size", F.floor(F.log(F.col("n_shingles").cast("double")) / step))
    pool = sized
    if again:
        parts = sized.groupBy("gram", "size", "part").agg(F.count("*").alias("n"))
        largest = parts.groupBy("gram", "size").agg(F.max_by("part", F.col("n")).alias("most"))
        pool = sized.join(largest, ["gram", "size"]).filter("part != most")
    kept = ("row", "part")
    heads = pool.groupBy("gram", "size").agg(*[F.max_by(c, F.col("central")).alias(c) for c in kept])
    below = heads.withColumn("size", F.col("size") + 1)
    out = []
    for rows, others in ((sized, heads), (heads, below)):
        x, y = rows.alias("x"), others.alias("y")
        met = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.size") == F.col("y.size")) & (F.col("x.part") != F.col("y.part"))
        pairs = x.join(y, met)
        out.append(pairs.select(F.least("x.row", "y.row").alias("a"), F.greatest("x.row", "y.row").alias("b")))
    return out[0].union(out[1]).distinct()


def join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, links: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Members and links. Rows link when ``den * overlap >= num * union``.

    Members, one row per row: doc_id, text_key, n_shingles, class (the same for equal sets), n_links (other rows it links with),
    component_id (the smallest doc_id reachable by links), first (the one row of its group that stays), alone (its group has no other row).
    Links: a, b, overlap of each two classes that link, once; rows of one class link with each other besides. None if they are not wanted.
    """
    rows = _rows(docs, n, num, den, frequent_grams(docs, n)).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "rows")
    lowest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("lowest")
    classes = rows.filter("n_shingles > 0").groupBy("same").agg(lowest, F.count("*").alias("n"))
    classes = stored(classes.select("same", F.col("lowest.row").alias("row"), "lowest", "n"), "classes")
    # Only the rows of classes of several are looked up.
    worded = sifted(rows.filter("n_shingles > 0"), "same", classes.filter("n > 1").select("same"))
    led = worded.filter("maybe").join(classes.select("same", "row"), ["same", "row"], "left_semi")
    leaders = worded.filter("not maybe").unionByName(led)

    # The product's columns: n-grams that stand in the prefix of two classes. ``i`` is the place in the prefix.
    cells = leaders.select("row", "n_shingles", F.posexplode("prefix").alias("i", "gram"))
    twice = cells.groupBy("gram").agg(F.count("*").alias("held")).filter("held > 1")
    cells = cells.join(twice, "gram").withColumn("rest", F.col("n_shingles") - F.col("i")).drop("i")
    cells = stored(cells, "cells")
    # How common its columns are; ties are broken by a hash.
    held = cells.groupBy("row").agg(F.sum("held").alias("sum")).select("row", (F.col("sum") + F.pmod(F.xxhash64("row"), F.lit(1 << 20)) / (1 << 20)).alias("central"))
    held = stored(held, "held")
    light = rows.select("row", "n_shingles")
    # Parts: what may link with a head, or with what may. Not compared yet, but hardly larger than the groups.
    open_ = cells.drop("held").join(held, "row").withColumn("part", F.col("row"))
    near = None
    for again in range(ROUNDS):
        pairs = stored(_plausible(_against_heads(open_, num, den, bool(again)), rows, num, den), "pairs")
        near = pairs if near is None else near.union(pairs)
        parts = components(near).withColumnRenamed("node", "row")
        open_ = open_.drop("part").join(parts, "row", "left").withColumn("part", F.coalesce("component", "row")).drop("component")
        parted = open_.groupBy("gram").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi").select("gram")
        open_ = stored(open_.join(parted, "gram", "left_semi"), "open")
        if open_.isEmpty():
            break

    apart = open_.select("gram", "row", "part", "rest").join(rows.select("row", "n_shingles", *PARITY), "row")
    pairs = stored(_plausible(_met(apart, num, den), rows, num, den), "pairs")

    # Only the texts of rows that may link are kept.
    wanted = parts.select("row").union(pairs.select("a")).union(pairs.select("b")).distinct()
    ids = stored(rows.join(wanted, "row", "left_semi").select("row", document().alias("document")), "ids")
    texts = docs.select("doc_id", text_key(), "text").select(document().alias("document"), "text")
    texts = sifted(texts, "document", ids.select("document")).filter("maybe")
    texts = stored(texts.join(ids, "document").dropDuplicates(["row"]).select("row", "text"), "texts")

    # Links inside parts, and of rows of different parts.
    inside = parts.select("row", F.col("component").alias("part")).join(light, "row").join(classes.select("row", "n"), "row")
    inside = stored(_inside(inside, texts, n, num, den, links), "inside")
    across = stored(_linked(pairs, light, texts, n, num, den), "links")
    edges = across.union(inside.filter("a is not null").select("a", "b", "overlap"))
    label = components(edges.select("a", "b")).withColumnRenamed("node", "row")
    ends = across.select(F.col("a").alias("row"), F.col("b").alias("other")).union(across.select(F.col("b").alias("row"), F.col("a").alias("other")))
    others = ends.join(classes.select(F.col("row").alias("other"), "n"), "other").groupBy("row").agg(F.sum("n").alias("others"))
    others = others.union(inside.filter("row is not null").select("row", "others")).groupBy("row").agg(F.sum("others").alias("others"))

    grouped = classes.join(label, "row", "left").withColumn("group", F.coalesce("component", "row"))
    first = grouped.groupBy("group").agg(F.min("lowest").alias("best"))
    n_links = F.col("n") - 1 + F.coalesce("others", F.lit(0))
    alone = (F.col("n") == 1) & F.col("component").isNull()
    grouped = grouped.join(first, "group").join(others, "row", "left")
    grouped = grouped.select("same", F.col("row").alias("class"), "best", n_links.alias("n_links"), alone.alias("alone"))
    out = rows.select("doc_id", "text_key", "n_shingles", "same", "row").join(grouped, "same", "left")
    members = out.select(
        "doc_id",
        "text_key",
        "n_shingles",
        F.coalesce("class", "row").alias("class"),
        F.when(F.col("n_shingles") > 0, F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        F.when(F.col("n_shingles") > 0, F.col("best.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n_shingles") > 0, F.col("best.row") == F.col("row")).otherwise(True).alias("first"),
        F.when(F.col("n_shingles") > 0, F.col("alone")).otherwise(True).alias("alone"),
    )
    return members, edges if links else None


def ngram_groups(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The members of ``join``, with their numbers of links."""
    return join(docs, n, num, den, links=False)[0]


def keep_one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each group, the one with the smallest doc_id, all columns. Rows without words all stay."""
    groups = join(docs, n, num, den, links=False)[0]
    # Only the texts of documents in groups of several rows are moved; the others stay where they are.
    settled = groups.filter("not alone").groupBy(document().alias("settled")).agg(F.max("first").alias("stays"))
    settled = stored(settled, "settled")
    rows = sifted(whole(docs).withColumn("document", whole_document()), "document", settled.select("settled"))
    bare = F.regexp_replace(F.coalesce("row.text", F.lit("")), "[ \\x09-\\x0D]", "") == ""
    moved = F.col("maybe") & ~bare
    few = rows.filter(moved).join(settled, F.col("document") == F.col("settled"), "left").filter("coalesce(stays, true)")
    # A document stored twice comes twice, and then it is one of a group.
    numbered = few.withColumn("copy", F.row_number().over(Window.partitionBy("document").orderBy("document")))
    return rows.filter(~moved).select("row.*").unionByName(numbered.filter("copy = 1").select("row.*"))
