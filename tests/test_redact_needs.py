"""The literals a rule asks for before its pattern is tried: never in the way of a match, and looked for once a text."""

import re

from pyspark.sql import functions as F
from test_redact import CASES

from tracelode.functions.redact import SECRET_RULES, has_match, matched_rules

#: One match a rule and kind of token, in odd cases.
TOKENS = [
    *(f"see {p}_{'a1B2' * 9}." for p in ("ghp", "GHO", "ghu", "Ghs", "ghr")), "github_pat_" + "A1_b" * 6, "GLPAT-" + "a-b_" * 6, "XOXE-0123456789",
    "SK-" + "a1B2" * 6, "rk_live_" + "a1" * 9, "sk_TEST_" + "a1" * 9, "AIzA" + "a" * 35, "npm_" + "a" * 30, "HF_" + "b" * 30,
]


def test_a_match_holds_what_its_rule_asks_for():
    texts = [case[0] for case in CASES] + TOKENS
    for rule in SECRET_RULES:
        found = [m.group(0).lower() for text in texts if text for m in re.finditer(rule.regex.replace(r"\z", r"\Z"), text)]
        assert found, rule.name
        for match in found:
            for literals in (rule.hints, rule.needs):
                assert not literals or any(x in match for x in literals), (rule.name, match)


def test_rules_are_found_as_by_their_patterns_alone(spark):
    texts = [case[0] for case in CASES] + TOKENS + ["", "through the night: a = b", "a_b", "key", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.array_compact(F.array(*[F.when(F.col("t").rlike(r.regex), F.lit(r.name)) for r in SECRET_RULES]))
    rows = df.select("t", plain.alias("plain"), matched_rules("t", SECRET_RULES).alias("found"), has_match("t").alias("any")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["found"] == r["plain"] and r["any"] == bool(r["plain"]), r["t"]


def test_prose_costs_few_literals_and_no_pattern():
    """Of a text without an assignment: each literal once, and fewer than half as many as the rules name."""
    outer = [x for needs in {r.needs for r in SECRET_RULES if r.needs} for x in needs]
    free = [x for r in SECRET_RULES if not r.needs for x in r.hints]
    assert 2 * (len(outer) + len(free)) < sum(len(r.hints) for r in SECRET_RULES)
    prose = "through the night the ghost might laugh at the passing monkey, said nobody"
    for rule in SECRET_RULES:
        asked = [literals for literals in (rule.needs, rule.hints) if literals]
        assert not all(any(x in prose for x in literals) for literals in asked), rule.name
