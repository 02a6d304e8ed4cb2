"""Trace trees against a plain walk."""

import random

import pytest
from pyspark.sql import functions as F

from tracelode.operators import spans

SCHEMA = "span_id string, parent_id string, start_ms long, duration_ms long, is_retry boolean"


def plain(rows):
    """span_id -> (root, depth, state, self_ms, critical)."""
    first = {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[2] or 0, (r[2] or 0) + max(r[3] or 0, 0), r[1] or "", bool(r[4]))):
        first.setdefault(r[0], (r[1], r[2] or 0, (r[2] or 0) + max(r[3] or 0, 0)))
    children = {}
    for s, (up, _, _) in first.items():
        if up in first:
            children.setdefault(up, []).append(s)
    last = {max(own, key=lambda s: (first[s][2], first[s][1], [-ord(c) for c in s])) for own in children.values()}
    out = {}
    for s, (up, low, high) in first.items():
        busy = set()
        for c in children.get(s, []):
            busy.update(range(max(low, first[c][1]), min(high, first[c][2])))
        seen, at, critical = [s], s, True
        while first[at][0] in first and len(seen) <= len(first):
            critical &= at in last
            at = first[at][0]
            seen.append(at)
        looped = len(seen) > len(first)
        state = "cycle" if looped else "orphan" if up is not None and up not in first else "rooted"
        out[s] = (None, None, "cycle", high - low - len(busy), False) if looped else (at, len(seen) - 1, state, high - low - len(busy), critical)
    return out


def tree(spark, rows):
    got = spans.span_tree(spark.createDataFrame(rows, SCHEMA).withColumn("up", F.lit("x"))).collect()
    assert len(got) == len({r.span_id for r in got})
    return {r.span_id: (r.root_id, r.depth, r.state, r.self_ms, r.critical) for r in got}


def test_random_trees(spark):
    rng = random.Random(3)
    rows = []
    for i in range(260):
        parent = rng.choice([None, f"s{rng.randrange(300)}", f"s{rng.randrange(max(1, i))}"])
        rows.append((f"s{i}", parent, rng.choice([None, rng.randrange(400)]), rng.choice([None, -5, rng.randrange(300)]), rng.random() < 0.1))
    rows += [rows[3], ("s4", "s9", 7, 7, True), (None, "s1", 1, 1, False), ("self", "self", 0, 3, False)]
    assert tree(spark, rows) == plain(rows)


def test_a_chain_of_a_thousand_spans_and_cycles(spark):
    rows = [(f"c{i}", f"c{i - 1}" if i else None, i, 5000 - 2 * i, False) for i in range(1000)]
    rows += [("a", "b", 0, 9, False), ("b", "c", 0, 9, False), ("c", "a", 0, 9, False), ("below", "c", 0, 1, True), ("lost", "nobody", 2, 3, False)]
    got = tree(spark, rows)
    assert got["c999"] == ("c0", 999, "rooted", 5000 - 2 * 999, True)
    assert all(got[f"c{i}"] == ("c0", i, "rooted", 2, True) for i in range(999))
    assert {got[x][:3] for x in ("a", "b", "c", "below")} == {(None, None, "cycle")}
    assert got["lost"] == ("lost", 0, "orphan", 3, True)


def test_summary_and_nothing(spark):
    rows = [("r", None, 0, 100, False), ("x", "r", 10, 30, False), ("y", "r", 20, 60, True), ("z", "y", 30, 10, False), ("o", "gone", 0, 5, True)]
    got = {r.root_id: r for r in spans.trace_summary(spans.span_tree(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert {k: (r.state, r.spans, r.levels, r.self_ms, r.critical_ms, r.retries, r.retry_ms) for k, r in got.items()} == {
        "r": ("rooted", 4, 2, 30 + 30 + 50 + 10, 30 + 50 + 10, 1, 60),
        "o": ("orphan", 1, 0, 5, 5, 1, 5),
    }
    assert spans.span_tree(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("spread", [1, 5])
def test_one_parent_with_many_children(spark, spread):
    rng = random.Random(spread)
    rows = [("root", None, 0, 3_000_000, False)]
    rows += [(f"k{i:04}", "root", rng.randrange(0, 3_000_000, spread), rng.randrange(4000), False) for i in range(1500)]
    got = {r.span_id: r.self_ms for r in spans.span_tree(spark.createDataFrame(rows, SCHEMA)).collect()}
    busy, upto = 0, 0
    for _, _, low, took, _ in sorted(rows[1:], key=lambda r: r[2]):
        high = min(low + took, 3_000_000)
        busy += max(0, high - max(low, upto))
        upto = max(upto, high)
    assert got["root"] == 3_000_000 - busy
