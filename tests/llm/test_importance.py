"""Operator 13: CRCs by columns, counts, weights and ranks against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import brute
import corpus
import numpy as np
import pyarrow as pa
import pytest

from tracelode.llm import importance, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def feature_list(text, n):
    own = WORD.findall(brute.lower(text))
    return own, [" ".join(own[i : i + k]) for k in range(1, n + 1) for i in range(len(own) - k + 1)]


def plain(docs, target, n=1, least=20, percent=10):
    """(doc_id, n_features, weight, score, rank) of every document."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    lists = [feature_list(t, n) for _, t in docs]
    s = Counter(bucket(f) for _, fs in lists for f in fs)
    t = Counter(bucket(f) for text in target for f in feature_list(text, n)[1])
    big_s, big_t = s.total() + 10_000, t.total() + 10_000
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in s}
    rows = []
    for (doc, _), (own, fs) in zip(docs, lists):
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(own) >= least])
    order = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(order[: percent * len(order) // 100]):
        r[4] = i + 1
    return [tuple(r[:5]) for r in rows]


def got(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in df.collect()), key=repr)


def test_crcs_of_columns():
    rng = np.random.default_rng(1)
    for size in (0, 1, 2, 7, 64):
        matrix = rng.integers(0, 256, (30, size), dtype=np.uint8)
        assert importance.crc_columns(matrix).tolist() == [zlib.crc32(r.tobytes()) for r in matrix]


@pytest.mark.parametrize("slice_", [5, 1 << 18])
@pytest.mark.parametrize("collide", [False, True])
def test_crcs_of_features(monkeypatch, slice_, collide):
    monkeypatch.setattr(importance, "SLICE", slice_)
    if collide:  # all features of one length have one hash
        monkeypatch.setattr(importance, "hash_words", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    text = " ".join(["a", "bb", "a", "cc", "x" * 200, "y" * 200, "x" * 200, "é", "日本語"] * 3).encode()
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = words.split(data, np.array([0, len(data)]))
    assert importance.crcs(data, starts, ends).tolist() == [zlib.crc32(w) for w in text.split()]


@pytest.mark.parametrize("n", [1, 3])
@pytest.mark.parametrize("chunk", [30, 1 << 20])
def test_features_of_chunks(monkeypatch, n, chunk):
    monkeypatch.setattr(words, "CHUNK", chunk)
    texts = [t for _, t in corpus.documents(3)] + ["A-b_c 1.5 Ünï", "\x00\x7f", "x" * 100 + "," + "y" * 100]
    out = {}
    for i, counts, row, bucket in importance.features(pa.array(texts), n):
        for k, count in enumerate(counts):
            out[i + k] = (int(count), Counter(bucket[row == k].tolist()))
    for i, text in enumerate(texts):
        own, fs = feature_list(text, n)
        assert out[i] == (len(own), Counter(zlib.crc32(f.encode()) % 10_000 for f in fs))


@pytest.mark.parametrize("n, percent", [(1, 10), (1, 100), (2, 35)])
def test_resampled_against_brute_force(spark, n, percent):
    docs = corpus.documents(4) + corpus.documents(5)  # ids come twice, with other texts
    docs += [docs[0]] * 30 + [(None, docs[1][1])] * 20 + [(None, None), (5, "word " * 400_000)]
    target = [" ".join(corpus.words(random.Random(9), 50)), None, "", "w1 w2 w3"]
    frame = corpus.frame(spark, docs).selectExpr("*", "1 AS weight", "2 AS rank", "true AS eligible", "4 AS n_words", "'p' AS place").repartition(5)
    wanted = spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)], "item_id long, text string, bucket int")
    out = importance.resampled(frame, wanted, n=n, percent=percent)
    want = sorted(plain(docs, target, n, percent=percent), key=repr)
    rows = got(out)
    assert [r[:4] for r in rows] == [r[:4] for r in want]
    drawn = sorted(r[4] for r in rows if r[4] is not None)
    assert drawn == list(range(1, len(drawn) + 1)) and len(drawn) == sum(r[4] is not None for r in want)
    # Of rows with one id and score any may come first; what is drawn is settled up to that.
    key = lambda rows: sorted((r[4], r[3], repr(r[0])) for r in rows if r[4] is not None)
    assert key(rows) == key(want)


def test_none_drawn(spark):
    frame = corpus.frame(spark, [(i, "too few words") for i in range(30)] + [(99, None)])
    target = spark.createDataFrame([], "item_id long, text string")
    rows = importance.resampled(frame, target).collect()
    assert len(rows) == 31 and all(r["rank"] is None for r in rows)
    assert importance.resampled(frame.limit(0), target).collect() == []


def test_a_large_tie_is_cut_exactly(spark):
    """Five hundred rows of one id and text: one score, any of them may be drawn, but so many and no more."""
    docs = [(1, "a b c d e f g h i j k l m n o p q r s t")] * 500 + [(i, "u v w x y z " * 4) for i in range(2, 102)]
    rows = got(importance.resampled(corpus.frame(spark, docs), spark.createDataFrame([(1, "a b")], "item_id long, text string")))
    assert sorted(r[4] for r in rows if r[4] is not None) == list(range(1, 61))
    assert sorted((r[3], r[4]) for r in rows if r[4] is not None) == sorted((r[3], r[4]) for r in plain(docs, ["a b"]) if r[4] is not None)
