"""Catalogue and taxonomy jobs over a documents corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.operators.dedupe import keep_first

PAGE_SUFFIX = ".md"
HOME_SECTION = "en"
INDEX_LINE = r"^- \[([^\]]+)\]\((https?://[^)]+)\):\s*(.*)$"


def parse_index(texts: DataFrame, text: str, base: str) -> DataFrame:
    """Entries of link lists, one ``- [title](url): summary`` per line; other lines are skipped.

    ``base`` is a pattern for the part of the URL before the relative path.
    """
    lines = texts.withColumn("line", F.explode(F.split(text, "\n"))).drop(text)
    found = lines.filter(F.col("line").rlike(INDEX_LINE))
    url = F.regexp_extract("line", INDEX_LINE, 2)
    with_suffix = F.when(url.endswith(PAGE_SUFFIX), url).otherwise(
        F.concat(F.regexp_replace(url, "/+$", ""), F.lit(PAGE_SUFFIX))
    )
    return found.select(
        *[c for c in texts.columns if c != text],
        F.regexp_extract("line", INDEX_LINE, 1).alias("title"),
        with_suffix.alias("url"),
        F.trim(F.regexp_extract("line", INDEX_LINE, 3)).alias("summary"),
        F.regexp_replace(with_suffix, f"^{base}", "").alias("rel"),
    ).filter(with_suffix.rlike(f"^{base}"))


def category(rel: str | Column) -> Column:
    """``core`` for a page right below the home section, else its folder; ``other`` elsewhere."""
    parts = F.split(F.col(rel) if isinstance(rel, str) else rel, "/")
    return (
        F.when((F.size(parts) < 2) | (F.get(parts, F.lit(0)) != HOME_SECTION), "other")
        .when(F.size(parts) == 2, "core")
        .otherwise(F.get(parts, F.lit(1)))
    )


def slug(rel: str | Column) -> Column:
    """Relative path without the home section and the suffix."""
    col = F.col(rel) if isinstance(rel, str) else rel
    return F.regexp_replace(F.regexp_replace(col, f"^{HOME_SECTION}/", ""), r"\.md$", "")


def anchor(heading: str | Column) -> Column:
    lowered = F.lower(F.col(heading) if isinstance(heading, str) else heading)
    return F.regexp_replace(F.regexp_replace(lowered, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def front_matter(pages: DataFrame, text: str, rel: str, base_url: str) -> DataFrame:
    """Title, summary and source from the block between ``---`` lines, with fallbacks: the slug,
    '' and the page URL. A block that never ends is no block."""
    body = F.col(text)
    block = F.when(body.startswith("---"), F.regexp_extract(body, r"(?s)^---(.*?)\n---", 1))

    def value(key: str, fallback: Column) -> Column:
        found = F.regexp_extract(block, rf"(?m)^{key}:[ \t]*(.*)$", 1)
        present = block.rlike(rf"(?m)^{key}:")
        return F.when(present, F.btrim(F.trim(found), F.lit('"'))).otherwise(fallback)

    out = pages.withColumns(
        {
            "title": value("title", slug(rel)),
            "summary": value("summary", F.lit("")),
            "source": value("source", F.concat(F.lit(base_url), F.col(rel))),
            "slug": slug(rel),
            "bytes": F.octet_length(body).cast("bigint"),
        }
    )
    return out.withColumn("html", F.replace("source", F.lit(PAGE_SUFFIX), F.lit(""))).drop(text)


def html_metadata(pages: DataFrame, html: str) -> DataFrame:
    """Title and language of web pages."""
    return pages.withColumns(
        {
            "title": F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1),
            "lang": F.regexp_extract(html, r'<html lang="([a-zA-Z-]+)"', 1),
            "bytes": F.octet_length(html).cast("bigint"),
        }
    ).drop(html)


def header(title: str, url: str, summary: str) -> Column:
    """The front-matter block of a saved page; double quotes inside become single ones."""

    def quoted(name: str) -> Column:
        return F.translate(F.col(name), '"', "'")

    return F.concat(
        F.lit('---\ntitle: "'), quoted(title),
        F.lit('"\nsource: "'), F.col(url),
        F.lit('"\nhtml: "'), F.replace(url, F.lit(PAGE_SUFFIX), F.lit("")),
        F.lit('"\nsummary: "'), quoted(summary),
        F.lit('"\nfetched: true\n---\n\n'),
    )


def append_missing(entries: DataFrame, extras: DataFrame, key: str = "rel") -> DataFrame:
    """Entries plus the extras whose key is not there yet."""
    return entries.unionByName(extras.join(entries.select(key).distinct(), key, "left_anti"))


def by_slug(pages: DataFrame, order_by: list[str]) -> DataFrame:
    """One page per slug: the last in order."""
    return keep_first(pages, ["slug"], [F.desc(c) for c in order_by])


def taxonomy_sections(taxonomy: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages by section. A slug may be in several sections; slugs without a page drop out.

    ``taxonomy`` has a row (section, position, slug) per listed page; ``pages`` one row per
    slug, so the join cannot grow.
    """
    return taxonomy.join(pages, "slug")


def explode_taxonomy(sections: DataFrame) -> DataFrame:
    """(section, blurb, [slug]) to one row per slug with its position."""
    return sections.select("section", "blurb", F.posexplode("slugs").alias("position", "slug"))


def uncategorised(taxonomy: DataFrame, pages: DataFrame) -> DataFrame:
    return pages.join(taxonomy.select("slug").distinct(), "slug", "left_anti")


def corpus_stats(pages: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Pages, bytes and pages outside the taxonomy.

    Counted per slug before the join, which then has one row per slug on both sides.
    """
    per_slug = pages.groupBy("slug").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    listed = taxonomy.select("slug").distinct().withColumn("_listed", F.lit(True))
    return per_slug.join(listed, "slug", "left").agg(
        F.sum("n").alias("pages"),
        F.sum("bytes").alias("total_bytes"),
        F.sum(F.when(F.col("_listed").isNull(), F.col("n")).otherwise(0)).alias("uncategorised"),
    )


def fetch_status(first: DataFrame, retried: DataFrame, key: str = "rel") -> DataFrame:
    """One row per page after a second try of the failures: ``ok`` if either try worked."""
    both = first.select(key, "ok").unionByName(retried.select(key, "ok"))
    return both.groupBy(key).agg(F.bool_or("ok").alias("ok"))
