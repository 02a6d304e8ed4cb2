"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; the unlabelled set is a sample of all text, toxic or
not. A linear numpy classifier on the presence of word and word-stem features minimises the class-prior-corrected risk
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``: what the positives among the unlabelled
add to the negative risk is taken out again, and the rest is kept from falling below zero, where it would only fit noise.

The classifier is fitted on at most about ``positives`` and ``unlabelled`` documents, chosen by a hash of doc_id and text, whole texts.
A feature must occur in LEAST positives, three times as often in them as among the unlabelled, and pass a test of z > 3.5.
Held-out rows take no part. Every whole text is scored, a text beyond a megabyte alone, in some hundred times its bytes. Null and empty
texts have no features and get the score of the bias. Without a confirmed positive every score is 0. Repeated labels of a document count
once; one toxic label confirms it. Equal texts of the sample count once, repeated rows are scored alike; no rows give no rows. Of equally
strong features the smaller hash is taken. A column named score is replaced, other extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelode.llm.tables import held_out, stored
from tracelode.llm.words import LOWER, chunks, hash_words, mix, signed, split

POSITIVES, UNLABELLED = 6_000, 20_000
#: Features the classifier may use, at most.
FEATURES = 4096
#: Besides the whole word, its first so many bytes are features.
STEMS = (4, 5, 6, 7, 8)
THRESHOLD = 0.3
#: Positives of the sample that a feature must occur in, whatever their number.
LEAST = 3

#: Words are runs of digits, lower-case letters and bytes of non-ASCII characters.
SEPARATOR = np.ones(256, bool)
SEPARATOR[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def features(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and feature hash of every word and stem, not yet distinct."""
    data = LOWER[data]
    starts, ends, counts = split(data, offsets, SEPARATOR)
    row = np.repeat(np.arange(len(counts)), counts)
    rows, hashes = [row], [hash_words(data, starts, ends)]
    for k in STEMS:
        longer = ends - starts > k
        rows.append(row[longer])
        cut = hash_words(data, starts[longer], starts[longer] + k)
        hashes.append(mix(cut ^ np.uint64(k)))
    return np.concatenate(rows), np.concatenate(hashes)


def _distinct(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]


class Vocabulary:
    """Finds a fixed set of hashes among many."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.known = np.zeros(1 << 20, bool)
        self.known[(self.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def present(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and feature number, distinct, of the features that occur."""
        rows, hashes = features(offsets, data)
        maybe = np.flatnonzero(self.known[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        rows, hashes = rows[maybe], hashes[maybe]
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        real = self.hashes[at] == hashes if len(self.hashes) else np.zeros(0, bool)
        return _distinct(rows[real], at[real])


@dataclass
class Model:
    vocabulary: Vocabulary
    weights: np.ndarray
    bias: float

    def scores(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        rows, found = self.vocabulary.present(offsets, data)
        sums = np.bincount(rows, self.weights[found], len(offsets) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(sums, -500, 500)))


def _feature_counts(sample: DataFrame) -> DataFrame:
    """feature, p, u: in how many positive and unlabelled documents of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            positive = np.array(batch.column("positive").to_pylist(), bool)
            for i, j, offsets, data in chunks(batch.column("text")):
                rows, hashes = _distinct(*features(offsets, data))
                own = positive[i:j][rows]
                feature, inverse = np.unique(hashes, return_inverse=True)
                p = np.bincount(inverse, own, len(feature)).astype(np.int64)
                u = np.bincount(inverse, ~own, len(feature)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(signed(feature)), pa.array(p), pa.array(u)], names=["feature", "p", "u"])

    counted = sample.select("text", "positive").mapInArrow(run, "feature long, p long, u long")
    return counted.groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def _incidence(sample: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """positive and the numbers of the features present, for each document of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i, j, offsets, data in chunks(batch.column("text")):
                rows, numbers = vocabulary.present(offsets, data)
                found += np.split(numbers, np.searchsorted(rows, np.arange(1, j - i)))
            yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array(found, pa.list_(pa.int64()))], names=["positive", "found"])

    return sample.select("text", "positive").mapInArrow(run, "positive boolean, found array<long>")


def fit(positive: np.ndarray, rows: np.ndarray, found: np.ndarray, n_features: int, prior: float, steps: int = 400,
        rate: float = 0.1, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of least non-negative risk, by Adam over the whole sample. Logistic loss."""
    w = np.zeros(n_features + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    n_p, n_u = max(1, positive.sum()), max(1, (~positive).sum())
    for t in range(1, steps + 1):
        margin = np.bincount(rows, w[found], len(positive)) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))  # slope of the loss as a negative; as a positive it is p - 1
        as_negative = np.logaddexp(0, margin)
        risk = as_negative[~positive].sum() / n_u - prior * as_negative[positive].sum() / n_p
        if risk >= 0:
            slope = np.where(positive, prior * (p - 1) / n_p - prior * p / n_p, p / n_u)
        else:  # step back: lift the negative risk to zero again, by the weights alone, not by the score of all text
            slope = np.where(positive, prior * p / n_p, -p / n_u)
        g = np.append(np.bincount(found, slope[rows], n_features), slope.sum() if risk >= 0 else 0.0)
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
          prior: float | None = None, n_features: int = FEATURES) -> Model | None:
    """The fitted model, None without a confirmed positive.

    ``prior`` is the toxic share of all text; by default the share among labelled documents, or, if all labels are
    toxic, the least ratio of a strong feature's rates among unlabelled and positive documents.
    """
    marked = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n_labelled, n_toxic = marked.agg(F.count("*"), F.count(F.when(F.col("toxic") == 1, 1))).first()
    if not n_toxic:
        return None
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    some = marked.filter((F.col("toxic") == 1) & (place < int(min(1, positives / n_toxic) * (1 << 30)))).select("doc_id")
    texts = docs.select(F.col("doc_id").cast("long"), "text").filter(~held_out() & F.col("text").isNotNull())
    n_docs = max(1, docs.count())
    sample_p = texts.join(F.broadcast(some), "doc_id", "left_semi").withColumn("positive", F.lit(True))  # ids: at most ~positives
    sample_u = texts.filter(F.pmod(F.xxhash64("doc_id", "text", F.lit("u")), F.lit(1 << 30)) < int(min(1, unlabelled / n_docs) * (1 << 30)))
    # A text counts once, or the words of a text copied often would pass for signs of toxicity.
    sample = sample_p.union(sample_u.withColumn("positive", F.lit(False))).dropDuplicates(["positive", "text"])
    sample = stored(sample.select("text", "positive"), "sample")
    sizes = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return None

    rate_p, rate_u = F.col("p") / n_p, F.col("u") / n_u
    z = (rate_p - rate_u) / F.sqrt((rate_p + rate_u) / 2 * (1.0 / n_p + 1.0 / n_u))
    strong = _feature_counts(sample).filter((F.col("p") >= LEAST) & (rate_p > 3 * rate_u))
    strong = strong.withColumn("z", z).filter("z > 3.5")
    chosen = strong.orderBy(F.desc("z"), "feature").limit(n_features).collect()
    vocabulary = Vocabulary(np.array([r["feature"] for r in chosen], np.int64).view(np.uint64))
    if prior is None:
        ratios = [(r["u"] / n_u) / (r["p"] / n_p) for r in chosen[:16]]
        prior = n_toxic / n_labelled if n_toxic < n_labelled else max(1e-3, min(ratios, default=0.5))
    rows = _incidence(sample, vocabulary).toArrow()  # a bounded sample
    positive = np.array(rows.column("positive").to_pylist(), bool)
    found = rows.column("found").combine_chunks()
    counts = np.diff(found.offsets.to_numpy())
    # Toxic text cannot be more frequent than its features are; a prior above that would make the negative risk sink
    # below zero and lift the score of text without any feature instead.
    any_p, any_u = (counts[positive] > 0).mean(), (counts[~positive] > 0).mean()
    prior = min(prior, float(any_u / any_p)) if any_p > 0 and any_u > 0 else prior
    weights, bias = fit(positive, np.repeat(np.arange(len(counts)), counts), found.values.to_numpy(), len(chosen), prior)
    return Model(vocabulary, weights, bias)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``docs`` but one of the same name, with score."""
    from pyspark.sql.types import StructType

    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for i, j, offsets, data in chunks(batch.column("text")) if model else ():
                out[i:j] = model.scores(offsets, data)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "score"])

    return rest.mapInArrow(run, StructType([*rest.schema.fields]).add("score", "double"))
