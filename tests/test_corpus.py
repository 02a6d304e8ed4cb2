from pyspark.sql import functions as F

from tracelode.operators import corpus

BASE = r"https://docs\.example\.com/"


def test_index_manifest_and_taxonomy(spark, fixture_file):
    texts = spark.read.text(fixture_file("index.md"), wholetext=True).withColumnRenamed("value", "text")
    entries = corpus.parse_index(texts, "text", BASE)
    assert sorted((r.rel, r.title, r.summary) for r in entries.collect()) == [
        ("en/overview.md", "Overview", "What it is"),
        ("en/overview.md", "Overview", "What it is"),
        ("en/quickstart.md", "Quick start", "First steps"),
        ("en/tools/sandbox.md", "Sandbox", "Safe runs"),
    ]
    extras = spark.createDataFrame(
        [("Overview", "x", "s", "en/overview.md"), ("New", "y", "s", "en/new.md")],
        "title string, url string, summary string, rel string",
    )
    manifest = corpus.append_missing(entries, extras)
    assert manifest.filter("title = 'New'").count() == 1 and manifest.count() == 5

    pages = corpus.by_slug(
        manifest.select("*", corpus.slug("rel").alias("slug"), F.lit(10).cast("bigint").alias("bytes")), ["rel", "title"]
    )
    sections = spark.read.schema("section string, blurb string, slugs array<string>").json(fixture_file("taxonomy.json"))
    taxonomy = corpus.explode_taxonomy(sections)
    listed = corpus.taxonomy_sections(taxonomy, pages)
    assert sorted((r.section, r.position, r.slug) for r in listed.collect()) == [
        ("News", 0, "overview"), ("Start", 0, "overview"), ("Start", 1, "quickstart"),
    ]
    assert {r.slug for r in corpus.uncategorised(taxonomy, pages).collect()} == {"tools/sandbox", "new"}
    assert tuple(corpus.corpus_stats(pages, taxonomy).first()) == (4, 40, 2)


def test_front_matter(spark):
    entry = spark.createDataFrame([('A "b"', "https://docs.example.com/en/a.md", "s")], "title string, url string, summary string")
    saved = entry.select(F.concat(corpus.header("title", "url", "summary"), F.lit("# body\n")).alias("text"), F.lit("en/a.md").alias("rel"))
    row = corpus.front_matter(saved, "text", "rel", "https://fallback/").first()
    assert (row.title, row.summary, row.source) == ("A 'b'", "s", "https://docs.example.com/en/a.md")
    assert row.html == "https://docs.example.com/en/a"
    open_block = spark.createDataFrame([("---\ntitle: x\nbody", "en/b/c.md"), ("no block", "z.md")], "text string, rel string")
    got = {r.rel: (r.title, r.source) for r in corpus.front_matter(open_block, "text", "rel", "https://f/").collect()}
    assert got == {"en/b/c.md": ("b/c", "https://f/en/b/c.md"), "z.md": ("z", "https://f/z.md")}


def test_category_and_anchor(spark):
    df = spark.createDataFrame([("en/a.md",), ("en/sdk/a.md",), ("fr/a.md",), ("a.md",)], "rel string")
    assert [r[0] for r in df.select(corpus.category("rel")).collect()] == ["core", "sdk", "other", "other"]
    heading = spark.createDataFrame([("What's new & next!",)], "h string")
    assert heading.select(corpus.anchor("h")).first()[0] == "what-s-new-next"


def test_retry_merge(spark):
    first = spark.createDataFrame([("a", True), ("b", False), ("c", False)], "rel string, ok boolean")
    retried = spark.createDataFrame([("b", True), ("c", False)], "rel string, ok boolean")
    assert dict(map(tuple, corpus.fetch_status(first, retried).collect())) == {"a": True, "b": True, "c": False}
