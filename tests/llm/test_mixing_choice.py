"""How sources are scheduled is the caller's choice, never the number of them."""

import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from tracelode.llm import mixing  # noqa: E402


def test_the_number_of_sources_changes_nothing(spark, monkeypatch):
    names = [f"s{i}" for i in range(40) for _ in range(300 if i == 7 else 24 + i % 3)]
    docs = spark.createDataFrame(list(enumerate(names)), "doc_id long, source string").withColumn("text", F.lit("x"))
    monkeypatch.setattr(mixing, "GROUPS", 6)
    want = mixing.mixed(docs, block=2).orderBy("position").collect()
    monkeypatch.setattr(mixing, "SOURCES", 10)
    with pytest.warns(UserWarning, match="40 sources"):
        got = mixing.mixed(docs, block=2).orderBy("position").collect()
    assert got == want
    root = {s: round(n**0.5, 6) for s, n in Counter(names).items()}
    share = {s: w / sum(root.values()) for s, w in root.items()}
    assert all(abs(r["block"] - r["slot"] * share[r["source"]]) <= 1 for r in got)

    grouped = mixing.mixed(docs, block=2, grouped=True).orderBy("position").collect()
    assert [r["position"] for r in grouped] == list(range(len(names))) and Counter(r["source"] for r in grouped) == Counter(names)
    last = min(-(-n // 2) / share[s] for s, n in Counter(names).items())
    for r in grouped:
        w = share[r["source"]]
        assert r["slot"] >= last - 2 / w or abs(r["block"] - r["slot"] * w) < 2
