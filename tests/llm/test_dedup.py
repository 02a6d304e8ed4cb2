"""Operators 1, 4 and 9, and connected components, against brute force."""

import random
import re
import time

import brute
import corpus
import pytest
from pyspark.sql import functions as F

from tracelode.llm import components, exact, ngram_join, substring, tables


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize(("seed", "n", "num"), [(1, 3, 90), (2, 5, 80), (1, 2, 40), (5, 4, 100)])
def test_ngram_groups(spark, seed, n, num):
    docs = corpus.documents(seed)
    got = ngram_join.ngram_groups(corpus.frame(spark, docs), n, num, 100)
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.ngram_groups(docs, n, num, 100), key=repr)
    per_group = got.filter("n_shingles > 0 and first").groupBy("component_id").count()
    assert per_group.filter("count != 1").isEmpty()


def test_ngram_groups_of_chained_near_copies(spark):
    """A ~ B ~ C ~ ... where far ends do not link: nothing but the chain connects them."""
    rng = random.Random(5)
    text, docs = corpus.words(rng, 200, 10**6), []
    for i in range(30):
        docs.append((500 - i, " ".join(text)))
        text = list(text)
        text[rng.randrange(200)] = f"n{i}"
        text[rng.randrange(200)] = f"m{i}"
    got = ngram_join.ngram_groups(corpus.frame(spark, docs), 3, 90, 100)
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.ngram_groups(docs, 3, 90, 100), key=repr)


def test_ngram_groups_of_repeated_rows_and_null_ids(spark):
    docs = [(7, "a b c d"), (7, "a b c d"), (None, "a b c d"), (None, "x y z"), (None, ""), (3, None), (9, "A B C D")]
    got = ngram_join.ngram_groups(corpus.frame(spark, docs), 3, 90, 100)
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(
        [(7, 2, 7), (7, 2, 7), (None, 2, 7), (None, 1, None), (None, 0, None), (3, 0, 3), (9, 2, 7)], key=repr
    )
    kept = ngram_join.keep_one_of_each(corpus.frame(spark, docs), 3, 90, 100)
    assert rows(kept, "doc_id", "text") == sorted([(7, "a b c d"), (None, "x y z"), (None, ""), (3, None)], key=repr)


def test_every_link_is_delivered(spark, monkeypatch):
    """Near copies of one text: links between all different sets, their overlaps, and the links of each row; in blocks, too."""
    rng = random.Random(7)
    base, docs = corpus.words(rng, 150, 10**6), []
    for i in range(40):
        own = list(base)
        own[rng.randrange(150)] = f"n{i // 2}x{rng.random()}"
        docs += [(100 + i, " ".join(own))] * (1 + i % 2)
    docs = [(1000 + i, t) for i, (_, t) in enumerate(docs + corpus.documents(1))]
    sets = [brute.shingles(t, 3) for _, t in docs]
    near = [[j for j, b in enumerate(sets) if j != i and a & b and 100 * len(a & b) >= 90 * len(a | b)] for i, a in enumerate(sets)]
    counted = {r["doc_id"]: r for r in ngram_join.ngram_groups(corpus.frame(spark, docs), 3, 90, 100).collect()}
    assert [counted[d]["n_links"] for d, _ in docs] == [len(x) for x in near]
    for name, size in (("BLOCK", 7), ("NEAR", 5), ("PART", 6)):
        monkeypatch.setattr(ngram_join, name, size)
    members, links = ngram_join.join(corpus.frame(spark, docs), 3, 90, 100)
    members = {r["doc_id"]: r for r in members.collect()}
    assert [members[d]["n_links"] for d, _ in docs] == [len(x) for x in near]
    of = {}
    for (d, _), own in zip(docs, sets):
        assert of.setdefault(members[d]["class"], own) == own
    want = {tuple(sorted((members[docs[i][0]]["class"], members[docs[j][0]]["class"]))) for i, x in enumerate(near) for j in x if sets[i] != sets[j]}
    got = links.collect()
    assert {(r["a"], r["b"]) for r in got} == want and len(got) == len(want) > 700
    assert all(r["overlap"] == len(of[r["a"]] & of[r["b"]]) for r in got)


def test_groups_without_a_common_head(spark, monkeypatch):
    """Copies of one text with many edits each: most are too far from each other and from any head, some link by chance."""
    rng = random.Random(9)
    base, docs = corpus.words(rng, 60, 10**6), []
    for i in range(120):
        own = list(base)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(60)] = f"e{rng.randrange(40)}"
        docs.append((i, " ".join(own)))
    want = sorted(brute.ngram_groups(docs, 3, 80, 100), key=repr)
    sets = [brute.shingles(t, 3) for _, t in docs]
    near = [sum(j != i and 100 * len(a & b) >= 80 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    assert len({w[2] for w in want}) > 5
    got = ngram_join.ngram_groups(corpus.frame(spark, docs), 3, 80, 100)
    assert rows(got, "doc_id", "n_shingles", "component_id") == want
    assert [n for _, n in sorted((r["doc_id"], r["n_links"]) for r in got.collect())] == near
    monkeypatch.setattr(ngram_join, "ROUNDS", 1)
    kept = ngram_join.keep_one_of_each(corpus.frame(spark, docs), 3, 80, 100)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({w[2] for w in want})


def test_texts_of_documents_in_no_group_are_not_moved(spark, monkeypatch):
    """Of the texts only those of groups go through a shuffle, once; a filter of few bits, which lets many pass, changes nothing."""
    docs = [(i, " ".join(f"d{i}x{k}" for k in range(30))) for i in range(300)]
    docs += [(400 + i, t + " tail") for i, t in docs[:10]] + docs[:3] + [(None, docs[20][1]), (None, "lone row"), (None, "lone row"), (None, None), (None, None), (8, " ")]
    want = sorted([*docs[:300], (None, "lone row"), (None, None), (None, None), (8, " ")], key=repr)
    seen, sifted = [], tables.sifted
    monkeypatch.setattr(ngram_join, "sifted", lambda *a: seen.append(sifted(*a)) or seen[-1])
    kept = ngram_join.keep_one_of_each(corpus.frame(spark, docs), 3, 80, 100)
    assert rows(kept, "doc_id", "text") == want
    texts, moved = seen[-2:]
    assert 20 <= texts.filter("maybe").count() < 40 and 20 <= moved.filter("maybe").count() < 40
    monkeypatch.setattr(tables, "FILTER_BITS", 64)
    assert rows(ngram_join.keep_one_of_each(corpus.frame(spark, docs), 3, 80, 100), "doc_id", "text") == want


def test_a_text_is_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for keep in (exact.keep_one, ngram_join.keep_one_of_each):
            plan = keep(corpus.frame(spark, corpus.documents(1)))._jdf.queryExecution().executedPlan().toString()
            assert len(re.findall(r"Exchange hashpartitioning\([^\n]*document#", plan)) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_storing_leaves_no_shuffle_files(spark):
    from pathlib import Path

    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {p for d in dirs for p in Path(d).rglob("shuffle_*")}
    before, setting = files(), spark.conf.get(tables._CLEANUP)
    got = tables.stored(spark.range(1000).repartition(7).groupBy("id").count(), "counts")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and got.count() == 1000 and spark.conf.get(tables._CLEANUP) == setting


def test_overlaps_are_exact(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(0)
    for cells in (1 << 21, 300):
        monkeypatch.setattr(ngram_join, "_CELLS", cells)
        for _ in range(60):
            base = np.unique(rng.integers(0, 1 << 62, 200))
            sets = [np.unique(np.concatenate([base[rng.random(len(base)) < rng.uniform(0.5, 1)], rng.integers(0, 1 << 62, rng.integers(0, 40))])) for _ in range(9)]
            wanted = rng.random((9, 9)) < 0.7
            linked, counts = ngram_join.overlaps(sets, 80, 100, wanted)
            for i, a in enumerate(sets):
                for j, b in enumerate(sets[:i]):
                    both = len(np.intersect1d(a, b))
                    assert linked[i, j] == (wanted[i, j] and 100 * both >= 80 * (len(a) + len(b) - both))
                    assert not linked[i, j] or counts[i, j] == both


def test_runs_across_batches():
    import pyarrow as pa

    keys = [1, 1, 1, 2, 2, 3, 4, 4, 4, 4, 5]
    for size in (1, 2, 3, 100):
        batches = pa.table({"k": keys, "v": range(len(keys))}).to_batches(max_chunksize=size)
        got = []
        for batch, cuts in ngram_join.runs(iter(batches), ["k"]):
            got += [batch.slice(a, b - a).to_pydict() for a, b in zip(cuts[:-1], cuts[1:])]
        assert [(g["k"], g["v"]) for g in got] == [([k] * keys.count(k), [i for i, x in enumerate(keys) if x == k]) for k in sorted(set(keys))]
    assert list(ngram_join.runs(iter([]), ["k"])) == []


def test_parities_never_discard_too_much():
    import numpy as np

    rng = np.random.default_rng(0)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 62, rng.integers(1, 300)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.7], rng.integers(0, 1 << 62, rng.integers(1, 200)).astype(np.uint64)]))
        x, y = ngram_join.parity(a), ngram_join.parity(b)
        while len(x) != len(y):
            x, y = (z if len(z) == min(len(x), len(y)) else z[: len(z) // 2] ^ z[len(z) // 2 :] for z in (x, y))
        for p, q in ((x, y), (ngram_join.folded(x), ngram_join.folded(y))):
            assert int(np.bitwise_count((p ^ q).view(np.uint64)).sum()) <= len(a) + len(b) - 2 * len(np.intersect1d(a, b))


@pytest.mark.parametrize(("seed", "window"), [(1, 35), (2, 12), (3, 3), (4, 1), (5, 64)])
def test_without_repeats(spark, seed, window):
    docs = corpus.documents(seed)
    got = substring.without_repeats(corpus.frame(spark, docs), window, with_text=True)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.without_repeats(docs, window), key=repr)
    for r in got.filter("n_removed > 0").collect():
        assert sum(s["end"] - s["first"] for s in r["spans"]) == r["n_removed"]
        assert len(r["kept_text"].split()) == r["n_words"] - r["n_removed"]


def test_without_repeats_of_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = [(1, text), (1, text), (None, text + " tail"), (None, None), (2, " ".join(f"v{i}" for i in range(50)))]
    got = substring.without_repeats(corpus.frame(spark, docs))
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.without_repeats(docs, 35), key=repr)


def test_windows_at_the_edges_of_passages(spark):
    """Passages of 34 to 70 words, at the start, middle and end of texts, cut out of one another."""
    rng = random.Random(11)
    docs = []
    for n in (34, 35, 36, 50, 61, 62, 63, 64, 70):
        passage = [f"p{n}x{i}" for i in range(n)]
        own = lambda k: [f"u{rng.random():.9f}" for _ in range(k)]
        for before, after in ((0, 40), (3, 0), (30, 30), (0, 0)):
            docs.append((len(docs), " ".join(own(before) + passage + own(after))))
        docs.append((len(docs), " ".join(own(9) + passage[: n - 5] + own(50))))
    got = substring.without_repeats(corpus.frame(spark, docs))
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.without_repeats(docs, 35), key=repr)


def test_exact_groups(spark):
    docs = corpus.documents(2)
    got = exact.exact_groups(corpus.frame(spark, docs))
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert rows(got, *names) == sorted(brute.exact_groups(docs), key=repr)
    kept = exact.keep_one(corpus.frame(spark, docs))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d[0] for d in brute.exact_groups(docs) if d[3])


def test_equal_fingerprints_of_different_texts_are_told_apart(spark):
    """Modulo tiny primes most fingerprints of a length agree; the comparison of the chunks still finds every group."""
    docs = corpus.documents(3) + [(i, f"{i % 40:04d}") for i in range(100)]
    got = exact.exact_groups(corpus.frame(spark, docs), primes=(3, 2), chunk=16)
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert rows(got, *names) == sorted(brute.exact_groups(docs), key=repr)


def test_exact_groups_of_repeated_rows_and_null_ids(spark):
    docs = [(5, "ab"), (5, "ab"), (5, "a b "), (None, "a b "), (None, None), (None, None), (8, "")]
    got = exact.exact_groups(corpus.frame(spark, docs))
    assert got.filter("kept").count() == 2
    assert rows(got.filter("kept"), "doc_id", "group_size") == [(5, 4), (8, 3)]
    kept = exact.keep_one(corpus.frame(spark, docs))
    assert rows(kept, "doc_id", "text") == [(5, "a b "), (8, "")]


def test_fingerprints_compose():
    import numpy as np

    data = np.random.default_rng(1).integers(0, 256, 1000).astype(np.uint8)
    assert exact.Fingerprinter(chunk=7)(data) == exact.Fingerprinter(chunk=256)(data) == exact.Fingerprinter()(data)
    for radix, prime in zip(exact.RADIX, exact.PRIMES):
        plain = 0
        for b in data.tolist():
            plain = (plain * radix + b) % prime
        assert plain in exact.Fingerprinter()(data)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(3, 3)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    rng.shuffle(edges)
    got = components.components(spark.createDataFrame(edges, "a long, b long").withColumn("c", F.lit(1)))
    linked = [e for e in edges if e[0] != e[1]]
    nodes = {x for e in linked for x in e}
    assert {r["node"]: r["component"] for r in got.collect()} == brute.components(nodes, linked)
    assert components.components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_empty_tables(spark):
    none = corpus.frame(spark, [])
    for got in (exact.exact_groups(none), exact.keep_one(none), ngram_join.ngram_groups(none), ngram_join.keep_one_of_each(none),
                substring.without_repeats(none)):
        assert got.count() == 0
