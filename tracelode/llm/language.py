"""Language ID by prediction by partial matching over bytes.

For each language a tree of byte contexts of up to three bytes is learnt once and then frozen. A
byte's probability follows method C: seen bytes share ``n / (n + d)``, the escape ``d / (n + d)``
goes to the bytes unseen here, in the proportions of the next shorter context, down to 1/256 each.
Every context's probabilities sum to one, so the summed ``-log2`` is an exact code length. The
language with the shortest code wins.

Each language stores the bytes seen in each of its contexts and one escape per context, nothing else, so every learnt
context is used, whatever the number of languages and scripts.

Learnt from at most about ``docs_per_language`` documents of each language, chosen by a hash of
doc_id and text, of equal texts one; a language of one document is learnt from that. Texts are read whole, for learning and for
scoring, a text beyond a megabyte alone, in blocks. A null text or one without a letter gives ``und`` and score 0; so does everything if
no language could be learnt. Of languages with equal code lengths the first by name wins. Repeated rows are judged as
often as they come, alike; no rows give no rows. Columns named as the results are left out, whatever their case.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracelode.llm.tables import held_out, whole
from tracelode.llm.words import chunks, text_buffers

ORDER = 3
DOCS_PER_LANGUAGE = 1500
#: What stands before the first byte of a text.
START = 0x0A
_BLOCK = 1 << 18
RESULTS = ("lang_pred", "score", "bits_per_byte")


def _padded(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with ORDER start bytes before each, and where each text begins."""
    n = len(offsets) - 1
    out = np.full(len(data) + ORDER * (n + 1), START, np.uint8)
    begins = offsets[:-1] + ORDER * np.arange(1, n + 1)
    for a, b, at in zip(offsets[:-1], offsets[1:], begins):
        out[at : at + b - a] = data[a:b]
    return out, begins


def gram_counts(sample: DataFrame) -> DataFrame:
    """lang, gram (four bytes, oldest first, as an integer), n: over the texts of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                column = batch.column("text").filter(pa.array(langs == lang))
                for _, _, offsets, data in chunks(column):
                    text, begins = _padded(offsets, data)
                    wide = text.astype(np.int64)
                    grams = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
                    real = np.zeros(len(text), bool)
                    for at, size in zip(begins, np.diff(offsets)):
                        real[at : at + size] = True
                    gram, n = np.unique(grams[real[3:]], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)], names=["lang", "gram", "n"]
                    )

    counted = sample.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Tree:
    """Frozen code lengths of one language: seen strings of context and byte, and the escape of each context, both by order."""

    def __init__(self, gram: np.ndarray, n: np.ndarray):
        shorter, sums = np.zeros(0), np.zeros(0, np.int64)
        self.grams: list[np.ndarray] = []
        self.seen: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.escapes: list[np.ndarray] = []
        for order in range(ORDER + 1):
            key, at = np.unique(gram & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
            sums = np.bincount(at, n, len(key))
            context, of = np.unique(key >> 8, return_inverse=True)
            total, kinds = np.bincount(of, sums, len(context)), np.bincount(of, minlength=len(context))
            # A string seen in a context is also seen in the next shorter one.
            below = shorter[np.searchsorted(self.grams[-1], key & ((1 << 8 * order) - 1))] if order else np.full(len(key), 1 / 256)
            rest = 1 - np.bincount(of, below, len(context))
            escape = np.where(kinds < 256, kinds, 0)
            shorter = sums / (total + escape)[of]
            with np.errstate(divide="ignore", invalid="ignore"):
                cost = np.where(escape > 0, np.log2((total + escape) / escape) + np.log2(np.maximum(rest, 1e-300)), 0)
            self.grams.append(key)
            self.seen.append(-np.log2(shorter))
            self.contexts.append(context)
            self.escapes.append(cost)

    def bits(self, gram: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each gram after the bytes before it."""
        out = np.full(len(gram), 8.0)
        for order in range(ORDER + 1):
            key = gram & ((1 << 8 * (order + 1)) - 1)
            at, known = _find(self.contexts[order], key >> 8)
            out += np.where(known, self.escapes[order][at], 0)
            at, known = _find(self.grams[order], key)
            out = np.where(known, self.seen[order][at], out)
        return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place among the sorted keys, and whether it is there."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Model:
    """One tree per language. ``block``: bytes of text looked up at once; it steers the cost, never the result."""

    def __init__(self, langs: list[str], grams: dict[str, tuple[np.ndarray, np.ndarray]], block: int | None = None):
        self.langs, self.block = langs, block
        self.trees = [Tree(*grams[lang]) for lang in langs]

    def bits(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Code length of each text under each language."""
        n, text_sizes = len(offsets) - 1, np.diff(offsets)
        out = np.zeros((n, len(self.langs)))
        text, begins = _padded(offsets, data)
        block = self.block or _BLOCK
        for at in range(ORDER, len(text), block):
            stop = min(at + block, len(text))
            first = np.maximum(begins, at) - at
            last = np.minimum(begins + text_sizes, stop) - at
            inside = np.flatnonzero(first < last)
            if not len(inside):
                continue
            cuts = np.stack([first[inside], last[inside]], 1).ravel()
            gram = np.zeros(stop - at, np.uint32)
            for k in range(ORDER, -1, -1):
                gram = (gram << np.uint32(8)) | text[at - k : stop - k]
            gram, place = np.unique(gram, return_inverse=True)
            gram = gram.astype(np.int64)
            for i, tree in enumerate(self.trees):
                lengths = np.append(tree.bits(gram)[place], 0.0)
                out[inside, i] += np.add.reduceat(lengths, cuts)[::2]
        return out


def learn(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """The frozen model. Held-out documents and rows without a language or text are left out.

    What the driver gathers is bounded by the sample: the distinct strings of four bytes in it.
    """
    train = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), "text")
    train = train.filter(~held_out() & F.col("lang").isNotNull())
    counts = train.groupBy("lang").agg(F.count("*").alias("n")).collect()
    share = {r["lang"]: min(1.0, docs_per_language / r["n"]) for r in counts}
    if not share:
        return Model([], {})
    limit = F.create_map(*[F.lit(x) for lang, s in sorted(share.items()) for x in (lang, int(s * (1 << 30)))])
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    sample = train.filter(F.col("text").isNotNull() & (place <= limit[F.col("lang")])).select("lang", "text").distinct()
    grams = gram_counts(sample).toArrow()
    names = np.array(grams.column("lang").to_pylist(), object)
    gram, n = grams.column("gram").to_numpy(), grams.column("n").to_numpy()
    langs = sorted(set(names))
    return Model(langs, {lang: (gram[names == lang], n[names == lang]) for lang in langs})


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "ignore"))


_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


def _judged(rows: DataFrame, model: Model, und: str, text: Callable[[pa.RecordBatch], pa.Array]) -> DataFrame:
    """``rows`` with the three results; ``text`` takes the texts out of a batch."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            n = batch.num_rows
            pred, score, rate = np.full(n, und, object), np.zeros(n), np.full(n, 8.0)
            for i, j, offsets, data in chunks(text(batch)) if model.langs else ():
                bits = model.bits(offsets, data)
                best = bits.argmin(1)
                least = bits[np.arange(j - i), best]
                share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
                for k in range(i, j):
                    a, b = offsets[k - i], offsets[k - i + 1]
                    if a < b and (_LETTER[data[a : min(b, a + 64)]].any() or _has_letter(data[a:b].tobytes())):
                        pred[k], score[k], rate[k] = model.langs[best[k - i]], share[k - i], least[k - i] / (b - a)
            added = [pa.array(pred, pa.string()), pa.array(score), pa.array(rate)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *RESULTS])

    schema = StructType([*rows.schema.fields]).add("lang_pred", "string").add("score", "double").add("bits_per_byte", "double")
    return rows.mapInArrow(run, schema)


def predict(docs: DataFrame, model: Model, und: str = "und") -> DataFrame:
    """All columns of ``docs`` but those of the same names, with lang_pred, score and bits_per_byte.

    ``score`` is the winner's share when the languages are weighed by 2 to minus their code length.
    """
    rest = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in RESULTS])
    return _judged(rest, model, und, lambda batch: batch.column("text"))


def keep_recognised(docs: DataFrame, max_bits: float = 12.0) -> DataFrame:
    """The rows in a learnt language, all columns: with a letter, and not far beyond the 8 bits a byte that noise needs.

    Text like the sample takes two or three bits a byte, text full of unknown words up to eight or ten.
    """
    judged = _judged(whole(docs), learn(docs), "und", lambda batch: pc.struct_field(batch.column("row"), "text"))
    return judged.filter((F.col("lang_pred") != "und") & (F.col("bits_per_byte") < max_bits)).select("row.*")
