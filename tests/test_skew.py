"""The skew-proof forms against their plain definitions, on data with one hot key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tracelode.operators.dedupe import insert_new, keep_first
from tracelode.operators.skew import salted_left_join
from tracelode.operators.sliced import Running, paired, running, time_slices, unpaired


@pytest.fixture(scope="module")
def hot(spark):
    rng = random.Random(5)
    rows = [(("hot" if rng.random() < 0.6 else f"k{rng.randrange(20)}"), rng.randrange(200), i, rng.random() < 0.3)
            for i in range(800)]
    return spark.createDataFrame(rows, "key string, t int, id int, flag boolean")


def as_set(df):
    return sorted(map(repr, df.collect()))


def slices(width):
    """Slices of ``t``, then single values of ``t`` with ranges of ``id``."""
    return [(F.floor(F.col("t") / width).cast("bigint"),), (F.col("t").cast("bigint"), F.floor(F.col("id") / 50).cast("bigint"))]


@pytest.mark.parametrize("rows_per_slice", [3, 40, 10**6])
@pytest.mark.parametrize("width", [1, 7, 1000])
def test_running_values(hot, width, rows_per_slice):
    values = {
        "n": Running("sum", F.lit(1)),
        "flags": Running("sum", F.col("flag").cast("int")),
        "last_flag": Running("max", F.when(F.col("flag"), F.struct("t", "id"))),
    }
    got = running(hot, ["key"], slices(width), ["t", "id"], values, rows_per_slice=rows_per_slice)
    w = Window.partitionBy("key").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = hot.select(
        "*",
        F.row_number().over(Window.partitionBy("key").orderBy("t", "id")).cast("bigint").alias("n"),
        F.sum(F.col("flag").cast("int")).over(w).alias("flags"),
        F.max(F.when(F.col("flag"), F.struct("t", "id"))).over(w).alias("last_flag"),
    )
    assert as_set(got.select(want.columns)) == as_set(want)


@pytest.mark.parametrize("rows_per_slice", [3, 10**6])
@pytest.mark.parametrize("width", [1, 13, 1000])
def test_next_row_by_descending_minimum(hot, width, rows_per_slice):
    got = running(
        hot, ["key"], slices(width), ["t", "id"],
        {"nxt": Running("min", F.when(F.col("flag"), F.struct("t", "id")))},
        descending=True, rows_per_slice=rows_per_slice,
    ).select("id", "nxt")
    rows = hot.collect()
    want = {}
    for r in rows:
        later = [(o.t, o.id) for o in rows if o.key == r.key and o.flag and (o.t, o.id) >= (r.t, r.id)]
        want[r.id] = min(later) if later else None
    assert {r.id: tuple(r.nxt) if r.nxt else None for r in got.collect()} == want


def test_rows_without_key_or_order_are_kept(spark):
    rows = [("a", 1), ("a", 2), (None, 3), (None, 4), ("a", None), ("b", 5)]
    df = spark.createDataFrame(rows, "key string, t int")
    got = running(df, ["key"], [(F.floor(F.col("t") / 2).cast("bigint"),)], ["t"], {"n": Running("sum", F.lit(1))})
    assert as_set(got) == sorted(map(repr, got.sparkSession.createDataFrame(
        [("a", 1, 1), ("a", 2, 2), (None, 3, None), (None, 4, None), ("a", None, None), ("b", 5, 1)], "key string, t int, n long"
    ).collect()))


def test_a_busy_key_has_few_totals(spark, monkeypatch):
    """100,000 rows of one key at distinct times: no more than a hundred totals per full slice."""
    from tracelode.operators import sliced

    stored, kept = [], sliced._kept
    monkeypatch.setattr(sliced, "_kept", lambda df, name: stored.append(kept(df, name)) or stored[-1])
    start = F.lit("2026-03-02 10:00:00").cast("timestamp_ntz")
    df = spark.range(100_000).select(F.lit("s").alias("key"), (start + F.expr("make_dt_interval(0, 0, 0, id / 30)")).alias("t"), "id")
    threshold = 1000
    got = running(df, ["key"], time_slices("t", "id"), ["t", "id"], {"n": Running("sum", F.lit(1))}, rows_per_slice=threshold)
    assert got.filter("n <> id + 1").isEmpty()
    assert 1 < len(stored) <= 3 and sum(t.count() for t in stored) <= 100_000 / threshold * 100


def test_pairs_keep_the_order_of_their_parts(spark):
    rng = random.Random(3)
    rows = [(rng.choice([0, 1, -5, 10**17, -(10**16)]), rng.choice([0, 7, 2**63 - 1, -(2**63)])) for _ in range(60)]
    df = spark.createDataFrame(rows, "a long, b long").withColumn("p", paired(F.col("a"), F.col("b")))
    major, minor = unpaired("p")
    got = df.select("a", "b", "p", major.alias("x"), minor.alias("y")).collect()
    assert all((r.a, r.b) == (r.x, r.y) for r in got)
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.p)] == sorted(rows)


def test_transcript_without_sessions(spark):
    from tracelode.operators.usage import transcript_lines

    prompts = spark.createDataFrame(
        [("o", None, None, "u", i, None, f"p{i}") for i in range(3)] + [("o", "s", None, "u", 1, None, "q")],
        "org_id string, session_id string, prompt_id string, user_account_uuid string, event_sequence long, "
        "event_timestamp timestamp_ntz, prompt_text string",
    )
    responses = spark.createDataFrame(
        [(None, None, i, None, f"r{i}", "m") for i in range(4)] + [("s", None, 2, None, "a", "m")],
        "session_id string, prompt_id string, event_sequence long, event_timestamp timestamp_ntz, response_text string, model_name string",
    )
    got = transcript_lines(prompts, responses, rows_per_task=1).select("prompt_text", "response_text")
    assert as_set(got) == sorted(map(repr, spark.createDataFrame(
        [("p0", None), ("p1", None), ("p2", None), ("q", "a")], "prompt_text string, response_text string").collect()))


@pytest.mark.parametrize("rows_per_task", [1, 3, 50, 10**6])
def test_salted_join(spark, hot, rows_per_task):
    left = hot.filter("id % 5 = 0").select("key", F.col("t").alias("lt"), F.col("id").alias("lid"))
    left = left.unionByName(spark.createDataFrame([("none", 1, -1), (None, 2, -2)], left.schema))
    right = hot.filter("id % 3 = 0").select("key", F.col("id").alias("rid"))
    right = right.unionByName(spark.createDataFrame([(None, -3)], right.schema))
    got = salted_left_join(left, right, ["key"], ["lid"], ["rid"], rows_per_task)
    r = right.withColumnRenamed("key", "rkey")
    want = left.join(r, left.key.eqNullSafe(r.rkey), "left").select("key", "lt", "lid", "rid")
    assert as_set(got.select("key", "lt", "lid", "rid")) == as_set(want)


def test_time_slices_of_a_clock_that_stood_still(spark):
    """Two thirds of the rows at one instant, others in the same second and hour."""
    at = ["2026-03-02 10:00:00.5"] * 400 + [f"2026-03-02 10:00:00.{i:03d}" for i in range(100)]
    at += [f"2026-03-02 10:{i % 60:02d}:01" for i in range(100)]
    df = spark.createDataFrame([("s", t, i * 3000) for i, t in enumerate(at)], "key string, t string, id long")
    df = df.withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = running(
        df, ["key"], time_slices("t", "id"), ["t", "id"], {"n": Running("sum", F.lit(1))}, rows_per_slice=50
    )
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("t", "id")).cast("bigint"))
    assert as_set(got.select(want.columns)) == as_set(want)


def test_salted_join_with_a_hot_left_side(spark, hot):
    left = hot.select("key", F.col("id").alias("lid"))
    right = hot.filter("key <> 'hot' AND id % 7 = 0").select("key", F.col("id").alias("rid"))
    right = right.unionByName(spark.createDataFrame([("hot", -1)], right.schema))
    got = salted_left_join(left, right, ["key"], ["lid"], ["rid"], 25)
    want = left.join(right, "key", "left").select("key", "lid", "rid")
    assert as_set(got) == as_set(want)


def test_keep_first_is_deterministic(hot):
    got = {r.key: r.id for r in keep_first(hot, ["key"], ["t", "id"]).collect()}
    rows = hot.collect()
    assert got == {k: min((r.t, r.id) for r in rows if r.key == k)[1] for k in {r.key for r in rows}}


def test_insert_new_reads_only_the_range_of_the_batch(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), ("z", 9)], "k string, day int")
    batch = spark.createDataFrame([("b", 2), ("c", 3), ("c", 3)], "k string, day int")
    for within in (None, "day"):
        assert [tuple(r) for r in insert_new(target, batch, "k", ["day"], within).collect()] == [("c", 3)]
