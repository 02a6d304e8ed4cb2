"""Secrets without a keyword: long tokens that look random, by entropy and format, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a token is made of, and its least length.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: Of the entropy that as many different characters would have, a random token has so much.
LEAST_ENTROPY = 0.8
# Digests in hexadecimal and UUIDs name things and are no secrets; nor is what falls into words, short abbreviations and few numbers.
DIGEST = r"^(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})$"
UUID = r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"
WORDS = r"^(?:[A-Z]?[a-z]{2,}+|[A-Z]++|[0-9]++|[_/+=-]++)*+$"
CAPITALS = "[A-Z]{6}"


def relative_entropy(token: Column) -> Column:
    """Shannon entropy of the characters over the logarithm of their number: 1 if all differ, 0 if all are one."""
    chars = F.filter(F.split(token, ""), lambda c: c != "")
    counts = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)).cast("double"))
    n = F.size(chars).cast("double")
    repeated = F.aggregate(counts, F.lit(0.0), lambda total, k: total + k * F.log2(k))
    return F.when(n > 1, 1 - repeated / (n * F.log2(n))).otherwise(0.0)


def looks_random(token: Column) -> Column:
    """A letter and a digit, no digest, no UUID, not made of words and numbers, and high entropy for its length."""
    mixed = token.rlike("[A-Za-z]") & token.rlike("[0-9]")
    length = F.length(token)
    few = F.regexp_count(token, F.lit("[0-9]+")) <= F.greatest(F.lit(2), F.floor(length / 10))
    name = token.rlike(WORDS) & ~token.rlike(CAPITALS) & few
    # A long token repeats characters of its alphabet even if it is random; small alphabets have 32 or so.
    limit = F.least(F.lit(1.0), F.lit(5.0) / F.log2(length.cast("double")))
    return mixed & ~token.rlike(DIGEST) & ~token.rlike(UUID) & ~name & (relative_entropy(token) >= LEAST_ENTROPY * limit)


def unkeyed_secrets(text: str | Column) -> Column:
    """The tokens of a text that look random, in order. NULL for a NULL text."""
    col = F.col(text) if isinstance(text, str) else text
    return F.filter(F.regexp_extract_all(col, F.lit(f"({TOKEN})"), 1), looks_random)
