"""The subpackage's registered queries, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelode.llm import (
    exact,
    fingerprints,
    importance,
    language,
    licenses,
    mixing,
    ngram_join,
    packing,
    secret_scan,
    substring,
    toxicity,
    url_filter,
    whitening,
)
from tracelode.llm.tables import held_out, table


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ngram_join.ngram_groups(table(spark, sf_dir, "documents"), n=3, num=90, den=100)
    return groups.select("doc_id", "n_shingles", "component_id")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring.without_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "source", "weight", "block", "slot", "position")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbours(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = toxicity.score(docs.select("doc_id", "text"), toxicity.learn(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return rows.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses.scan(table(spark, sf_dir, "documents"))
    base, near = F.col("places.label"), F.col("notices.label")
    return rows.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"),
        F.array_max("places.word").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, near)), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("notices.likeness"), F.lit(0.0))).alias("score"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact.exact_groups(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = language.predict(docs.select("doc_id", "text"), language.learn(docs))
    return judged.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = secret_scan.listed(secret_scan.known_forms())
    return rows.select(
        "doc_id",
        *[secret_scan.count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    model = whitening.fit(rows)
    if model is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    explained = F.array(*[F.lit(float(x)) for x in model.explained])
    out = whitening.whitened(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_url_filter": op2_url_filter,
    "op3_packing": op3_packing,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_mixing": op5_mixing,
    "op6_fingerprints": op6_fingerprints,
    "op7_toxicity": op7_toxicity,
    "op8_license_scan": op8_license_scan,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_language": op10_language,
    "op11_secret_scan": op11_secret_scan,
    "op12_whitening": op12_whitening,
    "op13_importance": op13_importance,
}

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_HOST = "regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)"

ORACLES = {
    # All pairs that share a shingle, then reachability.
    "op1_ngram_join": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        s AS (
            SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))
                END AS sh FROM w),
        e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
        p AS (
            SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
        r(x, y) AS (SELECT x, y FROM p UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x)
        SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, coalesce(min(r.y), s.doc_id) AS component_id
        FROM s LEFT JOIN r ON s.doc_id = r.x GROUP BY s.doc_id, len(sh)
    """,
    # The given pages hold no redirect and no canonical link; aliases are tested against a written-out result.
    "op2_url_filter": f"""
        WITH rules(h, p, allows) AS (VALUES ('com', '/', true), ('example.com', '/en/', false),
            ('www.example.com', '/en/', true), ('net', '/es/', false), ('net', '/fr/', false)),
        u AS (
            SELECT row_number() OVER () AS i, page_id, {_LOWER.format(_HOST)} AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
        f AS (
            SELECT i, arg_max(h || p, length(h || p)) AS rule, arg_max(allows, length(h || p)) AS allows
            FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY i)
        SELECT page_id, host, path, rule, CASE WHEN allows = false THEN 'block' ELSE 'allow' END AS verdict
        FROM u LEFT JOIN f USING (i)
    """,
    # Windows as joined words, counted; positions from 1.
    "op4_substring_dedup": """
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        win AS (
            SELECT doc_id, p, array_to_string(ws[p:p + 34], ' ') AS k
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS p FROM w)),
        twice AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
        gone AS (SELECT DISTINCT doc_id, p + j AS i FROM (SELECT doc_id, p FROM win JOIN twice USING (k)), range(0, 35) t(j)),
        words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
            FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)
    """,
    # Texts without [\\x20\\x09-\\x0D]; ranked by code points, then by id.
    "op9_exact_dedup": """
        WITH n AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS bare
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY bare) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, sha256(bare) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY bare ORDER BY length(t) DESC, doc_id)
    """,
    # CRC-32 by its table, a byte of the word's hexadecimal form after another.
    "op13_importance": f"""
        WITH RECURSIVE bytes(b, step, c) AS (
            SELECT b, 0, b FROM range(256) r(b)
            UNION ALL SELECT b, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bytes WHERE step < 8),
        crc AS (SELECT list(c ORDER BY b) AS t FROM bytes WHERE step = 8),
        d AS (SELECT row_number() OVER () AS i, doc_id, regexp_extract_all({_LOWER.format("text")}, '{_WORD}') AS ws FROM documents),
        dw AS (SELECT i, unnest(ws) AS word FROM d),
        bw AS (SELECT unnest(regexp_extract_all({_LOWER.format("text")}, '{_WORD}')) AS word FROM benchmark),
        h AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
        k AS (
            SELECT word, xor(4294967295, list_reduce(
                list_transform(range(1, len(x), 2), lambda i: CAST('0x' || x[i:i + 1] AS BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) % 10000 AS bucket
            FROM h, crc),
        s AS (SELECT bucket, count(*) AS n FROM dw JOIN k USING (word) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS n FROM bw JOIN k USING (word) GROUP BY bucket),
        g AS (
            SELECT bucket, CAST(floor(1000 * ln(((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM dw) + 10000)::DOUBLE)
                / ((s.n + 1.0::DOUBLE) * ((SELECT count(*) FROM bw) + 10000)::DOUBLE))) AS BIGINT) AS gain
            FROM s LEFT JOIN t USING (bucket)),
        m AS (SELECT i, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM dw JOIN k USING (word) JOIN g USING (bucket) GROUP BY i),
        e AS (
            SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                   CAST('0x' || sha256('2024:' || doc_id)[1:8] AS BIGINT) AS h FROM d LEFT JOIN m USING (i)),
        r AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM e),
        o AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 10 * count(*) OVER () // 100 AS drawn
            FROM r WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM r LEFT JOIN o USING (doc_id)
    """,
}
