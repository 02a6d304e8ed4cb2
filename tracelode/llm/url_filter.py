"""URL filters with redirect equivalence.

A rule names a host, with all its subdomains, and a path prefix; of the rules that fit a url the longest
decides. Pages that redirect to each other or name a canonical address are aliases: connected components over these links
carry decisions to aliases without a rule of their own. If a rule allows any member, they are allowed, also if
another member is blocked; if a rule blocks one and none allows, they are blocked; else the default holds.

Links are read from the attributes of tags in any order, with entities decoded, and resolved as RFC 3986 says against the
page's address or its base element.

A null url has an empty host and path, fits no rule and has no aliases. Null html has no links. Repeated rows are judged each.
Of two fitting rules of the same length the one that allows wins, then the one that sorts first.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.llm.components import components
from tracelode.llm.tables import stored

#: Host and path of each rule, and whether it allows.
RULES = (
    ("com", "/", True),
    ("example.com", "/en/", False),
    ("www.example.com", "/en/", True),
    ("net", "/es/", False),
    ("net", "/fr/", False),
)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """What aliases are told apart by: no scheme, no fragment, host in lower case, no default port, an empty path as ``/``. Null without a host."""
    scheme = ascii_lower(F.regexp_extract(url, r"(?s)\A(.*?)://", 1))
    port = F.when(scheme == "http", r":(?:80)?\z").when(scheme == "https", r":(?:443)?\z").otherwise(r":\z")
    host = F.regexp_replace(host_of(url), port, F.lit(""))
    rest = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^#]*)", 1)
    slash = F.when(rest.startswith("/"), "").otherwise("/")
    return F.when(host != "", F.concat(host, slash, rest))


#: A tag up to the first ``>`` outside quotes, and one attribute of it. Comments and elements that hold text alone are passed over whole; one
#: that is not closed goes up to the end.
_TAG = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))"""
    r"""|<(script|style|textarea|title|xmp|iframe|noembed|noframes)(?=[\s/>])(?:"[^"]*"|'[^']*'|[^>])*+>.*?(?:</\1(?=[\s/>])|\Z)"""
    r"""|<(link|meta|base)(?=[\s/>])((?:"[^"]*"|'[^']*'|[^>])*+)>""",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_REFRESH = re.compile(r"\s*(?:[\d.]+\s*(?:[;,]\s*)?url\s*=|[\d.]+\s*[;,]|[;,]?\s*url\s*=)\s*(.*)", re.I | re.S)
#: Scheme, authority, path, query of a reference; the fragment is not told apart.
_PARTS = re.compile(r"(?:([a-z][a-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?", re.I | re.S)


def _attributes(tag: str) -> dict[str, str]:
    """Names in lower case, values with entities decoded; of equal names the first counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(tag):
        out.setdefault(name.lower(), unescape("".join(values)))
    return out


def _reference(value: str) -> str:
    """As browsers read it: no space around, no tab or line break inside."""
    return re.sub(r"[\t\r\n]", "", value.strip(" \t\r\n\f")).replace(" ", "%20")


def _without_dots(path: str) -> str:
    """RFC 3986, 5.2.4, for a path that starts with a slash or is empty."""
    out: list[str] = []
    parts = path.split("/")
    for i, part in enumerate(parts):
        if part in (".", ".."):
            if part == ".." and len(out) > 1:
                out.pop()
            if i == len(parts) - 1:
                out.append("")
        else:
            out.append(part)
    return "/".join(out)


def resolved(base: str, to: str) -> str | None:
    """The address ``to`` names on a page (RFC 3986, 5.2), None without a host. The page's host is after its first ``://``."""
    scheme, mark, rest = base.partition("://")
    if not mark:
        scheme, rest = "", ""
    host, path, query = re.match(r"([^/?#]*)([^?#]*)(\?[^#]*)?", rest).groups()
    own, authority, p, q = _PARTS.match(to).groups()
    if own is not None or authority is not None:
        return f"{own or scheme}://{authority}{_without_dots(p)}{q or ''}" if authority else None
    if not host:
        return None
    if not p:
        return f"{scheme}://{host}{path}{(query if q is None else q) or ''}"
    if not p.startswith("/"):
        p = path[: path.rfind("/") + 1] + p if path else "/" + p
    return f"{scheme}://{host}{_without_dots(p)}{q or ''}"


def named(url: str, html: str) -> list[str]:
    """Absolute addresses of the first canonical link and the first refresh of a page."""
    base, canonical, refresh = None, None, None
    for _, tag, inside in _TAG.findall(html):
        kind, at = tag.lower(), _attributes(inside)
        if kind == "base" and base is None and "href" in at:
            base = _reference(at["href"])
        elif kind == "link" and canonical is None and "canonical" in at.get("rel", "").lower().split():
            canonical = _reference(at.get("href", "")) or None
        elif kind == "meta" and refresh is None and at.get("http-equiv", "").strip().lower() == "refresh":
            found = _REFRESH.match(at.get("content", ""))
            to = found[1] if found else ""
            refresh = _reference(to[1:].split(to[0])[0] if to[:1] in ("'", '"') else to) or None
    page = (resolved(url, base) if base else None) or url
    return [x for x in (resolved(page, to) for to in (canonical, refresh) if to) if x]


def links(pages: DataFrame) -> DataFrame:
    """a, b: addresses of pages and of what they name as canonical or refresh to."""
    low = F.lower(F.col("html"))
    some = pages.select("url", "html").filter((low.contains("canonical") | low.contains("refresh")) & F.col("url").contains("://"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(u, to) for u, h in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()) for to in named(u, h)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.string()) for k in (0, 1)], names=["url", "to"])

    found = some.mapInArrow(run, "url string, to string")
    edges = found.select(address(F.col("url")).alias("a"), address(F.col("to")).alias("b"))
    return edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull())


def ruled(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``rows`` (host, path, ...) with rule and allows, both null where none fits.

    Rules meet distinct hosts, and each url only looks through those of its own host.
    """
    suffix = F.explode(
        F.transform(
            F.sequence(F.lit(1), F.size(F.split("host", r"\."))),
            lambda i: F.array_join(F.slice(F.split("host", r"\."), i, F.size(F.split("host", r"\."))), "."),
        )
    )
    hosts = rows.select("host").distinct().filter("host != ''").withColumn("suffix", suffix)
    length = F.length("rule_host") + F.length("rule_path")
    own = rules.select(
        F.col("rule_host").alias("suffix"),
        F.struct((-length).alias("order"), (~F.col("allows")).alias("blocks"), F.concat("rule_host", "rule_path").alias("rule"), "rule_path", "allows").alias("x"),
    )
    of_host = hosts.join(own, "suffix").groupBy("host").agg(F.sort_array(F.collect_set("x")).alias("fitting"))
    best = F.get(F.filter("fitting", lambda x: F.col("path").startswith(x["rule_path"])), F.lit(0))
    joined = rows.join(of_host, "host", "left").withColumn("best", best)
    return joined.select(*rows.columns, F.col("best.rule").alias("rule"), F.col("best.allows").alias("allows"))


def judged(pages: DataFrame, rules: DataFrame | None = None, redirects: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict, alias (verdict of its aliases, null without) of every page.

    ``rules``: rule_host, rule_path, allows. ``redirects``: url, to; besides the links that the pages themselves hold.
    """
    spark = pages.sparkSession
    if rules is None:
        rules = spark.createDataFrame(RULES, "rule_host string, rule_path string, allows boolean")
    edges = links(pages)
    if redirects is not None:
        more = redirects.select(address(F.col("url")).alias("a"), address(F.col("to")).alias("b"))
        edges = edges.union(more.filter(F.col("a").isNotNull() & F.col("b").isNotNull()))
    member = components(edges)
    member = member.withColumn("host", F.regexp_extract("node", r"(?s)\A([^/?#]*)", 1)).withColumn(
        "path", F.regexp_extract("node", r"(?s)\A[^/?#]*([^?]*)", 1)
    )
    known = ruled(member, rules)
    group = known.groupBy("component").agg(F.max("allows").alias("allowed"), F.min("allows").alias("not_blocked"))
    group = group.select("component", F.when(F.col("allowed"), "allow").when(~F.col("not_blocked"), "block").alias("alias"))
    alias = stored(known.join(group, "component").select("node", "alias").filter("alias is not null"), "aliases")

    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), address(F.col("url")).alias("node"))
    rows = ruled(rows, rules).join(alias, "node", "left")
    own = F.when(F.col("allows"), "allow").when(~F.col("allows"), "block")
    return rows.select("page_id", "host", "path", "rule", F.coalesce(own, "alias", F.lit(default)).alias("verdict"), "alias")
