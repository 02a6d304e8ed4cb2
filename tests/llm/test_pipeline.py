"""Operators 2 and 5, the pipeline, and the queries that have SQL."""

import random
import sys
from collections import Counter
from fractions import Fraction
from pathlib import Path

import brute
import corpus
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from compare import connect, difference  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from tracelode.llm import exact, language, mixing, ngram_join, url_filter  # noqa: E402
from tracelode.llm.queries import ORACLES, QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES and n != "op12_whitening"])
def test_one_row_per_document(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert got.select("doc_id").distinct().count() == docs.count()
    assert name == "op3_packing" or got.count() == docs.count()


# URL filter

PAGES = [
    (1, "http://www.Example.com/en/a?x=1#f", None),
    (2, "https://example.com/en/b", '<html><LINK href="https://other.org/home" rel="canonical"></html>'),
    (3, "https://other.org/home#top", "<p>"),
    (4, "http://other.org/away", "<meta http-equiv='refresh' content='0; url=/home'>"),
    (5, "http://sub.site.net/es/x", '<link rel=canonical href=//site.de/y>'),
    (6, "http://site.de/y", ""),
    (7, "http://site.de/z", '<link rel="canonical" href="http://site.com/">'),
    (8, "http://other.de/q", '<link rel="canonical" href="http://site.de/y">'),
    (9, "http://example.com", None),
    (10, "no scheme", '<link rel="canonical" href="http://site.net/fr/1">'),
    (11, None, None),
    (12, "http://notexample.com/en/", None),
    (13, "://x.NET/fr/", None),
    (14, "http://a.b/c://d.net/es/", None),
    (15, "", None),
    (15, "http://late.org/1", '<link rel="canonical" href="http://late.org/2">'),
    (None, "http://late.org/2", '<link rel="canonical" href="http://x.net/fr/9">'),
    (16, "http://late.org/1", None),
]


def test_url_verdicts(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("node", F.lit(1))
    got = sorted((tuple(r) for r in url_filter.judged(pages).drop("alias").collect()), key=repr)
    assert got == sorted(
        [
            (1, "www.example.com", "/en/a", "www.example.com/en/", "allow"),
            (2, "example.com", "/en/b", "example.com/en/", "block"),
            (3, "other.org", "/home", None, "block"),
            (4, "other.org", "/away", None, "block"),
            (5, "sub.site.net", "/es/x", "net/es/", "block"),
            (6, "site.de", "/y", None, "block"),
            (7, "site.de", "/z", None, "allow"),
            (8, "other.de", "/q", None, "block"),
            (9, "example.com", "", None, "allow"),
            (10, "", "", None, "allow"),
            (11, "", "", None, "allow"),
            (12, "notexample.com", "/en/", "com/", "allow"),
            (13, "x.net", "/fr/", "net/fr/", "block"),
            (14, "a.b", "/c://d.net/es/", None, "allow"),
            (15, "", "", None, "allow"),
            (15, "late.org", "/1", None, "block"),
            (None, "late.org", "/2", None, "block"),
            (16, "late.org", "/1", None, "block"),
        ],
        key=repr,
    )
    redirects = spark.createDataFrame([("http://late.org/2", "http://www.example.com/en/"), (None, "http://x.net/es/")], "url string, to string")
    freed = url_filter.judged(pages, redirects=redirects).filter("host = 'late.org'")
    assert {r["verdict"] for r in freed.collect()} == {"allow"}
    assert url_filter.judged(pages.limit(0)).count() == 0


RELATIVE = [
    ("http://h1.org/d/a", '<link rel="canonical" href="blocked.html">', "h1.org/d/blocked.html"),
    ("http://h2.org/d/a?x=1", '<link href="?p=2" rel="canonical">', "h2.org/d/a?p=2"),
    ("http://h3.org/d/a", "<link href=./x rel=canonical>", "h3.org/d/x"),
    ("http://h4.org/d/e/a", '<link href="../x" rel="nofollow canonical">', "h4.org/d/x"),
    ("http://h5.org", '<link href="x" rel="canonical">', "h5.org/x"),
    ("http://h6.org/a", "<meta content='0;url=to' http-equiv=refresh>", "h6.org/to"),
    ("http://h7.org/a", """<META name=x content="5; URL='/to'" HTTP-EQUIV="Refresh"/>""", "h7.org/to"),
    ("http://h8.org/a", '<link rel="canonical" href="/p?a=1&amp;b=2">', "h8.org/p?a=1&b=2"),
    ("http://h9.org/a", '<link title="a > b" rel="canonical" href="https&#58;//x9.org/?u=http://y.org">', "x9.org/?u=http://y.org"),
    ("http://h10.org/d/a", '<base href="/e/f"><link rel="canonical" href="../../x">', "h10.org/x"),
    ("http://h11.org/d/a", '<link rel="canonical" href="?u=http://y.org/">', "h11.org/d/a?u=http://y.org/"),
]


def test_relative_links_lead_to_aliases(spark):
    """Each page names another, which a rule blocks."""
    pages = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(RELATIVE)], "page_id long, url string, html string")
    want = {(url_filter_address(u), to) for u, _, to in RELATIVE}
    assert {tuple(r) for r in url_filter.links(pages).collect()} == want
    rules = [(to.split("/")[0], "/" + to.split("/", 1)[1].split("?")[0], False) for _, _, to in RELATIVE]
    rules = spark.createDataFrame(rules, "rule_host string, rule_path string, allows boolean")
    got = url_filter.judged(pages, rules)
    assert {r["verdict"] for r in got.collect()} == {"block"} and got.count() == len(RELATIVE)


def url_filter_address(url):
    rest = url.partition("://")[2]
    return rest if "/" in rest else rest + "/"


HIDDEN = [
    '<!-- <link rel="canonical" href="http://bad.net/es/"> --><p>',
    "<script>var x = '<link rel=\"canonical\" href=\"http://bad.net/es/\">';</script>",
    "<SCRIPT src=x>'<meta http-equiv=refresh content=\"0;url=http://bad.net/es/\">'</Script >",
    "<style><link rel=canonical href=http://bad.net/es/></style>",
    "<title><link rel=canonical href=http://bad.net/es/></title>",
    "<textarea>\n<link rel=canonical href=http://bad.net/es/>\n</textarea>",
    "<p>open <!-- <link rel=canonical href=http://bad.net/es/>",
    "<script><link rel=canonical href=http://bad.net/es/>",
]


def test_links_in_comments_and_raw_text_are_none():
    for html in HIDDEN:
        assert url_filter.named("http://a.org/", html) == [], html
    shown = '<!--> <link rel="canonical" href="/1"> <!-- a --> <scripty><meta http-equiv=refresh content="0;url=/2"><!-- <base href=/x> -->'
    assert url_filter.named("http://a.org/", shown) == ["http://a.org/1", "http://a.org/2"]


def test_spellings_of_one_address_are_one_node(spark):
    """Each page names another spelling of a page that a rule blocks."""
    same = ["http://d.org", "http://D.org/", "https://d.org:443", "http://d.org:80/#x", "http://d.org:/", "HTTP://d.org:80"]
    other = ["http://d.org:8080/", "https://d.org:80/", "http://d.org:443", "http://d.org/?", "ftp://d.org:80/"]
    urls = spark.createDataFrame([(u,) for u in same + other], "url string")
    found = [r[0] for r in urls.select(url_filter.address(F.col("url"))).collect()]
    assert set(found[: len(same)]) == {"d.org/"} and "d.org/" not in found[len(same) :]
    pages = [(i, f"http://p{i}.org", f'<link rel="canonical" href="{u}">') for i, u in enumerate(same)]
    pages = spark.createDataFrame([*pages, (99, "http://d.org/", "")], "page_id long, url string, html string")
    rules = spark.createDataFrame([("d.org", "/", False)], "rule_host string, rule_path string, allows boolean")
    assert {r["verdict"] for r in url_filter.judged(pages, rules).collect()} == {"block"}


@pytest.mark.parametrize(("to", "want"), [
    ("g:h", None), ("g", "http://a/b/c/g"), ("./g", "http://a/b/c/g"), ("g/", "http://a/b/c/g/"), ("/g", "http://a/g"), ("//g", "http://g"),
    ("?y", "http://a/b/c/d;p?y"), ("g?y", "http://a/b/c/g?y"), ("#s", "http://a/b/c/d;p?q"), (";x", "http://a/b/c/;x"), ("", "http://a/b/c/d;p?q"),
    (".", "http://a/b/c/"), ("./", "http://a/b/c/"), ("..", "http://a/b/"), ("../g", "http://a/b/g"), ("../..", "http://a/"), ("../../g", "http://a/g"),
    ("../../../g", "http://a/g"), ("/./g", "http://a/g"), ("/../g", "http://a/g"), ("g.", "http://a/b/c/g."), ("..g", "http://a/b/c/..g"),
    ("./../g", "http://a/b/g"), ("./g/.", "http://a/b/c/g/"), ("g/../h", "http://a/b/c/h"), ("g;x=1/../y", "http://a/b/c/y"),
])
def test_examples_of_rfc_3986(to, want):
    assert url_filter.resolved("http://a/b/c/d;p?q", to) == want


def test_null_urls_of_the_given_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    some = pages.withColumn("url", F.when(F.col("page_id") % 5 > 0, F.col("url")))
    assert url_filter.judged(some).count() == pages.count()


# Mixing


def test_deviation_stays_below_one_block():
    for weights in ({"a": 5, "b": 3, "c": 1}, {"a": 1, "b": 0, "c": 0.001}, {str(i): i for i in range(40)}):
        quota = mixing.quotas(weights, 1000)
        assert sum(quota.values()) == 1000 and min(quota.values()) >= 1
        done = Counter()
        for t, s in enumerate(mixing.schedule(quota), 1):
            done[s] += 1
            assert all(abs(done[x] - t * quota[x] / 1000) < 1 for x in quota)
        assert done == quota


@pytest.mark.parametrize(("block", "period", "weights"), [(4, 20, None), (3, 10, {"a": 5.0, "b": 1.0}), (64, 1000, None)])
def test_mixture(spark, block, period, weights):
    docs = corpus.documents(1)
    frame = corpus.frame(spark, docs)
    got = mixing.mixed(frame, weights, block, period).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(len(docs)))
    sources = {r["doc_id"]: r["source"] or "" for r in frame.collect()}
    counts = Counter(sources.values())
    wanted = {s: n**0.5 if weights is None else weights.get(s, 0) for s, n in counts.items()}
    quota = mixing.quotas(wanted, max(period, 4 * len(wanted)))
    assert [r["doc_id"] for r in got] == brute.mixture(sources.items(), quota, block)
    assert all(abs(r["weight"] - quota[r["source"]] / sum(quota.values())) < 1e-12 for r in got)


def test_mixing_of_repeated_rows_and_nothing(spark):
    docs = corpus.frame(spark, [(1, "a"), (1, "a"), (None, None), (None, "b")])
    assert sorted(r["position"] for r in mixing.mixed(docs).collect()) == [0, 1, 2, 3]
    assert mixing.in_order(docs).count() == 4
    assert mixing.mixed(corpus.frame(spark, [])).count() == mixing.in_order(corpus.frame(spark, [])).count() == 0


def check_windows(parts, blocks, frame, monkeypatch):
    """Every block in its window, over the borders of frames; of one frame the same as by plain earliest deadline first."""
    monkeypatch.setattr(mixing, "FRAME", frame)
    plan = mixing.Plan.of([Fraction(p) for p in parts], blocks)
    total, done, used, out = sum(plan.parts), [0] * len(parts), set(), []
    for _, own in plan.frames().groupby("frame"):
        who = own["who"].tolist()
        low, high = int(own["low"].iloc[0]), int(own["high"].iloc[0])
        local, number, slot = mixing.in_frame([plan.parts[i] for i in who], total, own["first"].tolist(), own["stop"].tolist(), low, high)
        for i, k, t in zip(local.tolist(), number.tolist(), slot.tolist()):
            i = who[i]
            assert low <= t < high and t not in used and k == done[i]
            assert k * total // plan.parts[i] <= t < -(-(k + 1) * total // plan.parts[i])
            used.add(t)
            done[i] += 1
            out.append((i, k, t))
    assert done == list(blocks)
    if len(plan.cuts) == 2:
        assert out == brute.earliest_deadline_first(plan.parts, blocks)
    return len(plan.cuts)


def test_blocks_stay_within_one_of_the_requested_weights(monkeypatch):
    rng = random.Random(3)
    cuts = 0
    for _ in range(400):
        n, kind = rng.randint(1, 12), rng.randrange(4)
        parts = [(rng.randint(1, 10), rng.randint(1, 1000), int(10 ** rng.uniform(0, 4)) + 1, rng.randint(1, 1 << 70))[kind] for _ in range(n)]
        cuts += check_windows(parts, [rng.randint(1, 50) for _ in range(n)], rng.choice([1, 2, 5, 20, 1000]), monkeypatch)
    assert cuts > 2000
    for weights in ([1, 0.001], [5, 1], [rng.random() ** 4 for _ in range(60)], [0.1, 1e-5, 0.3]):
        blocks = [int(30_000 * w / sum(weights)) + 1 for w in weights]
        assert check_windows([Fraction(w) for w in weights], blocks, 500, monkeypatch) >= 2


def test_a_plan_grows_with_frames_not_with_blocks():
    plan = mixing.Plan.of([Fraction(round(n**0.5 * 1e6)) for n in (10**11, 10**9, 10**8, 5)], [10**11 // 64, 10**9 // 64, 10**8 // 64, 1])
    assert 1000 < len(plan.frames()) <= 1.01 * mixing.NUMBERS and plan.before[-1].tolist() == [10**11 // 64, 10**9 // 64, 10**8 // 64, 1]


def test_registered_mixture_against_brute_force(spark, monkeypatch):
    """Square roots of the counts, exactly, as registered: block by block the plain schedule; in frames within the windows."""
    import hashlib

    rng = random.Random(2)
    sources = {i: rng.choice("aaaaaabbbc") if i % 50 else f"rare{i % 3}" for i in range(1500)}
    docs = spark.createDataFrame(list(sources.items()), "doc_id long, source string").withColumn("text", F.lit("x"))
    counts = Counter(sources.values())
    names = sorted(counts)
    parts = mixing._shares([Fraction(round(counts[s] ** 0.5 * 1_000_000)) for s in names])
    lists = {s: sorted((i for i in sources if sources[i] == s), key=lambda i: hashlib.md5(str(i).encode()).hexdigest()) for s in names}
    for frame in (mixing.FRAME, 60):
        monkeypatch.setattr(mixing, "FRAME", frame)
        got = mixing.mixed(docs, block=4).orderBy("position").collect()
        assert [r["position"] for r in got] == list(range(len(sources)))
        slots = {(r["source"], r["block"]): r["slot"] for r in got}
        if frame > 60:
            plain = brute.earliest_deadline_first(parts, [-(-counts[s] // 4) for s in names])
            assert slots == {(names[i], k): t for i, k, t in plain}
        for (s, k), t in slots.items():
            p = parts[names.index(s)]
            assert k * sum(parts) // p <= t < -(-(k + 1) * sum(parts) // p)
        order = [d for (s, k), _ in sorted(slots.items(), key=lambda x: x[1]) for d in lists[s][4 * k : 4 * k + 4]]
        assert [r["doc_id"] for r in got] == order
    assert len(slots) > 300


def test_mixture_of_requested_weights(spark, monkeypatch):
    """Sources a and b in 1 : 0.001, then c, which has no weight; also in groups."""
    n = {"a": 2100, "b": 3, "c": 5}
    rows = [(i, s) for i, s in enumerate(x for x, k in n.items() for _ in range(k))]
    docs = spark.createDataFrame(rows, "doc_id long, source string").withColumn("text", F.lit("x"))
    for sources in (mixing.SOURCES, 2):
        monkeypatch.setattr(mixing, "SOURCES", sources)
        got = mixing.mixed(docs, {"a": 1, "b": 0.001}, block=1).orderBy("position").collect()
        assert [r["position"] for r in got] == list(range(len(rows))) and {r["source"] for r in got[-5:]} == {"c"}
        assert Counter(r["source"] for r in got) == n
        assert len({r["slot"] for r in got}) == len(rows)
        assert {r["source"]: round(r["weight"], 9) for r in got} == {"a": 0.999000999, "b": 0.000999001, "c": 0.0}
        seen = 0
        for t, r in enumerate(got[:2000], 1):
            seen += r["source"] == "b"
            assert abs(seen - t / 1001) < 2


def test_many_sources_in_groups(spark, monkeypatch):
    """Within two blocks of the weights while all sources last; a source that has run out leaves its turns to its group."""
    names = [f"s{i}" for i in range(40) for _ in range(300 if i == 7 else 24 + i % 3)]
    docs = spark.createDataFrame(list(enumerate(names)), "doc_id long, source string").withColumn("text", F.lit("x"))
    monkeypatch.setattr(mixing, "SOURCES", 10)
    monkeypatch.setattr(mixing, "GROUPS", 6)
    got = mixing.mixed(docs, block=2).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(len(names)))
    counts = Counter(names)
    assert Counter(r["source"] for r in got) == counts
    root = {s: round(n**0.5, 6) for s, n in counts.items()}
    share = {s: w / sum(root.values()) for s, w in root.items()}
    last = min(-(-n // 2) / share[s] for s, n in counts.items())
    assert last > 400
    for r in got:
        w = share[r["source"]]
        assert abs(r["weight"] - w) < 1e-9 and (r["slot"] >= last - 2 / w or abs(r["block"] - r["slot"] * w) < 2)


# Pipeline


def test_stages_against_brute_force(spark, scratch):
    from tokenizers import Tokenizer
    from test_text import check_pieces

    from tracelode.llm import packing

    docs = corpus.documents(9) + [(1, "1234 ..."), (2, None)]
    frame = corpus.frame(spark, docs)
    texts = dict(docs)
    whole = {r["doc_id"]: r for r in frame.collect()}

    def stage(i, rows):
        out = corpus_pipeline.STAGES[i][1](spark, rows, SF_DIR)
        out.write.parquet(f"{scratch}/{i}")
        back = spark.read.parquet(f"{scratch}/{i}")
        if i < 4:
            assert back.columns == frame.columns
            assert all(r == whole[r["doc_id"]] for r in back.collect())
        return back

    one = stage(0, frame)
    letters = {d for d, t in docs if any(c.isalpha() for c in t or "")}
    kept = {r["doc_id"] for r in one.collect()}
    bits = {r["doc_id"]: r["bits_per_byte"] for r in language.predict(frame, language.learn(frame)).collect()}
    assert kept == {d for d in letters if bits[d] < 12} and len(kept) > 0.9 * len(letters)
    two = stage(1, one)
    want = {d for d, _, _, stays, _ in brute.exact_groups([(d, texts[d]) for d in sorted(kept)]) if stays}
    assert sorted(r["doc_id"] for r in two.collect()) == sorted(want)
    three = stage(2, two)
    want = {d for d, _, c in brute.ngram_groups([(d, texts[d]) for d in sorted(want)], 5, 80, 100) if d == c}
    assert sorted(r["doc_id"] for r in three.collect()) == sorted(want)
    four = stage(3, three)
    assert sorted(map(tuple, four.collect()), key=repr) == sorted(map(tuple, three.collect()), key=repr)
    five = stage(4, four)
    pieces = packing.packed(four, with_ids=True).collect()
    check_pieces([(d, texts[d]) for d in want], pieces, 4096, Tokenizer.from_file(packing.tokenizer_path()))
    names = five.columns
    assert sorted(map(tuple, five.collect())) == sorted(tuple(p[c] for c in names) for p in pieces)


def test_run(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = ngram_join.keep_one_of_each(exact.keep_one(language.keep_recognised(docs)))
    assert {r["doc_id"] for r in got.select("doc_id").distinct().collect()} == {r["doc_id"] for r in kept.collect()}
