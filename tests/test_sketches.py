"""Sketches of days against exact sets, quantiles against exact ranks, and drift of fields."""

import random

from pyspark.sql import functions as F

from tracelode.operators import drift, sketches


def test_sketches_of_days_merge_to_any_range(spark):
    rng = random.Random(1)
    rows = [(d, rng.choice(["a", "b", None]), f"u{rng.randrange(3000) + 900 * (d // 7)}") for d in range(28) for _ in range(700)] + [(3, "a", None)]
    days = sketches.user_days(spark.createDataFrame(rows, "event_date int, department string, user_email string")).withColumn("week", F.floor(F.col("day") / 7))
    weeks = {w: {u for d, _, u in rows if d // 7 == w and u} for w in range(4)}
    merged = sketches.merged_users(days, "week")
    got = {r["week"]: r for r in sketches.active_users(merged).collect()}
    for w, users in weeks.items():
        assert got[w]["theta_users"] == len(users)  # fewer than the sketch has room for: exact
        assert abs(got[w]["hll_users"] - len(users)) <= 0.05 * len(users)
        assert got[w]["events"] == sum(d // 7 == w and u is not None for d, _, u in rows)
    change = {r["week"]: r for r in sketches.changed_users(merged, "week", F.col("week") - 1).collect()}
    assert (change[0]["lost"], change[0]["returning"]) == (0, 0)
    for w in (1, 2, 3):
        assert (change[w]["active"], change[w]["lost"], change[w]["returning"]) == (
            len(weeks[w]), len(weeks[w - 1] - weeks[w]), len(weeks[w - 1] & weeks[w]),
        )
    of_a = sketches.active_users(sketches.merged_users(days.filter("department = 'a'"))).first()
    assert of_a["theta_users"] == len({u for _, dep, u in rows if dep == "a" and u})


def test_large_sketches_stay_within_their_deviation(spark):
    users = spark.range(400_000).selectExpr("CAST(id % 200000 AS STRING) AS user_email", "CAST(id % 5 AS INT) AS event_date", "'x' AS department")
    got = sketches.active_users(sketches.merged_users(sketches.user_days(users))).first()
    assert abs(got["theta_users"] - 200_000) < 0.03 * 200_000 and abs(got["hll_users"] - 200_000) < 0.05 * 200_000


def test_quantiles_of_hours_merge_to_days(spark):
    rng = random.Random(2)
    values = [int(rng.paretovariate(1.2) * 50) for _ in range(30_000)]
    rows = [(f"2026-03-0{1 + i % 3} {i // 3 % 24:02}:10:00", "m", v) for i, v in enumerate(values)] + [("2026-03-01 00:00:00", "m", None), (None, "m", 5)]
    events = spark.createDataFrame(rows, "t string, model string, latency_ms long").withColumn("event_timestamp", F.to_timestamp_ntz("t"))
    hours = sketches.duration_hours(events)
    assert hours.count() == 72
    for r in sketches.quantiles(sketches.merged_durations(hours, F.to_date("hour").alias("day"), "model"), {"p50": 0.5, "p95": 0.95}).collect():
        own = sorted(v for t, _, v in rows if t and v is not None and t.startswith(str(r["day"])))
        assert r["requests"] == len(own)
        for name, rank in (("p50", 0.5), ("p95", 0.95)):
            below, upto = sum(v < r[name] for v in own) / len(own), sum(v <= r[name] for v in own) / len(own)
            assert below <= rank + 0.02 and upto >= rank - 0.02


def test_fields_that_are_new_widen_or_conflict(spark):
    lines = [
        (1, '{"a": 1, "o": {"x": 1, "deep": {"y": {"z": {"w": 1}}}}, "n": null, "l": [1]}'),
        (2, '{"a": 2.5, "o": {"x": "t"}, "b": true, "n": null}'),
        (3, '{"a": 1, "o": {"x": 3}, "b": true, "n": 7, "m": 1}'),
        (3, '{"m": "x"}'),
        (4, '{"a": 1e300, "o": 5, "b": false}'),
        (5, None), (5, "[1, 2]"), (5, "{}"),
    ]
    rows = spark.createDataFrame(lines, "batch int, line string").select("batch", F.parse_json("line").alias("payload"))
    got = {(r["batch"], r["field"]): (r["type"], r["known"], r["change"], r["records"]) for r in drift.history(drift.field_types(rows, "batch")).collect()}
    assert got == {
        (1, "a"): ("BIGINT", "BIGINT", "new", 1), (2, "a"): ("DECIMAL", "DECIMAL", "widened", 1), (3, "a"): ("BIGINT", "DECIMAL", "same", 1),
        (4, "a"): ("DOUBLE", "DOUBLE", "widened", 1), (1, "o.x"): ("BIGINT", "BIGINT", "new", 1), (2, "o.x"): ("STRING", "VARIANT", "conflict", 1),
        (3, "o.x"): ("BIGINT", "VARIANT", "same", 1), (1, "o.deep.y.z"): ("OBJECT", "OBJECT", "new", 1), (1, "l"): ("ARRAY", "ARRAY", "new", 1),
        (2, "b"): ("BOOLEAN", "BOOLEAN", "new", 1), (3, "b"): ("BOOLEAN", "BOOLEAN", "same", 1), (4, "b"): ("BOOLEAN", "BOOLEAN", "same", 1),
        (3, "n"): ("BIGINT", "BIGINT", "new", 1), (3, "m"): ("VARIANT", "VARIANT", "conflict", 2), (4, "o"): ("BIGINT", "BIGINT", "new", 1),
    }
    assert drift.history(drift.field_types(rows.limit(0), "batch")).count() == 0
