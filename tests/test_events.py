"""Shapes, bad records, sessions, usage and reliability on small hand-made logs."""

from datetime import date

from pyspark.sql import functions as F

from tracelode.functions.keys import merge_key, surrogate_key
from tracelode.functions.pricing import Price, with_price_table
from tracelode.operators import adoption, audit, dedupe, reliability, silver, usage
from tracelode.operators import normalize as norm
from tracelode.sources import landing


def read(spark, *paths):
    lines = spark.read.text(list(paths)).withColumnRenamed("value", "line")
    return norm.normalize(landing.with_payload(lines).drop("event_name", "line").filter("payload is not null"))


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_four_shapes_are_one_event(spark, fixture_file):
    events = read(spark, fixture_file("shapes.jsonl"))
    assert events.count() == 4
    only = events.distinct().collect()
    assert len(only) == 1
    assert only[0].event_name == "user_prompt" and only[0].prompt_text == "add a test" and only[0].event_sequence == 4
    assert str(only[0].event_timestamp) == "2026-03-02 10:00:00" and only[0].model == "model-m"


def test_shapes_do_not_depend_on_the_session_time_zone(spark, fixture_file):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        times = read(spark, fixture_file("shapes.jsonl")).select(F.col("event_timestamp").cast("string")).distinct()
        assert [r[0] for r in times.collect()] == ["2026-03-02 10:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_durations_ignore_clock_changes_of_the_session_zone(spark):
    rows_ = [("s", "2026-03-08 06:30:00"), ("s", "2026-03-08 07:30:00"), ("t", "2026-03-08 02:30:00"), ("t", "2026-03-08 03:30:00")]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        events = spark.createDataFrame(rows_, "session_id string, at string").select(
            "session_id", F.col("at").cast("timestamp_ntz").alias("event_timestamp"), F.lit("user_prompt").alias("event_name"),
            F.lit(None).cast("string").alias("user_email"), F.lit(None).cast("string").alias("department"),
        )
        got = dict(rows(silver.sessions(events), "session_id", "session_duration_sec"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == {"s": 3600, "t": 3600}


def test_bad_lines_and_contract(spark, fixture_file):
    lines = spark.read.text(fixture_file("bad.jsonl")).withColumnRenamed("value", "line")
    parsed = landing.with_payload(lines)
    assert parsed.filter("payload is null").count() == 4
    events = norm.normalize(parsed.filter("payload is not null").drop("event_name"))
    by_name = {r.event_name: r for r in events.filter("event_name = 'assistant_response'").collect()}
    assert by_name["assistant_response"].input_tokens is None and by_name["assistant_response"].output_tokens == 7
    checked = audit.with_violations(events.withColumn("event_timestamp", F.col("event_timestamp").cast("string")))
    found = sorted(r.violations for r in checked.collect())
    assert found == [
        "", "enum:event_name", "missing:event_timestamp", "missing:event_timestamp,missing:session_id",
        "missing:session_id",
    ]
    valid, invalid = audit.split_valid(events.withColumn("event_timestamp", F.col("event_timestamp").cast("string")))
    assert (valid.count(), invalid.count()) == (1, 4)


def test_rescued_attributes(spark, fixture_file):
    lines = spark.read.text(fixture_file("extras.jsonl")).withColumnRenamed("value", "line")
    known = ["event_name", "event_timestamp", "session_id", "org_id"]
    assert landing.rescued(lines, known).first()._rescued == {"mood": "good", "start_type": "fresh"}


def test_redelivery_changes_nothing(spark, fixture_file):
    once = read(spark, fixture_file("dups_a.jsonl"))
    twice = read(spark, fixture_file("dups_a.jsonl"), fixture_file("dups_b.jsonl"))
    for name, table in silver.facts(twice).items():
        want = silver.facts(once)[name]
        assert rows(table, *want.columns) == rows(want, *want.columns), name


def test_key_by_sequence_keeps_events_of_one_tick(spark, fixture_file):
    events = read(spark, fixture_file("same_tick.jsonl"))
    assert silver.prompts(events).count() == 2
    assert dedupe.keep_first(events, ["session_id", "event_timestamp"], ["event_sequence"]).count() == 1


def test_events_without_a_sequence_are_all_kept(spark, fixture_file):
    events = read(spark, fixture_file("same_tick.jsonl"), fixture_file("day.jsonl")).withColumn(
        "event_sequence", F.lit(None).cast("bigint")
    )
    late = events.withColumn("event_timestamp", F.col("event_timestamp") + F.expr("INTERVAL 1 HOUR"))
    both = events.unionByName(late)
    assert silver.prompts(both.unionByName(both)).count() == 2 * events.filter("event_name = 'user_prompt'").count()


def test_keys(spark):
    df = spark.createDataFrame([("s", None, 3)], "a string, b string, c int")
    row = df.select(surrogate_key("a", "b", "c", F.lit("prompt")), merge_key("a", "b", "c", F.lit("prompt"))).first()
    import hashlib

    assert row[0] == hashlib.sha256(b"s||3|prompt").hexdigest()[:32]
    assert row[1] == hashlib.md5(b"s||3|prompt").hexdigest()


def test_daily_usage_has_one_row_where_the_joins_have_four(spark, fixture_file):
    events = read(spark, fixture_file("day.jsonl"))
    cols = ("usage_date", "org_id", "user_account_uuid", "sessions", "input_tokens", "output_tokens", "cost_units",
            "prompts", "responses", "tool_events")
    day = date(2026, 3, 2)
    assert rows(usage.daily_user_usage(events), *cols) == [(day, "org-a", "u-1", 1, 500, 300, 2_100_000, 1, 1, 1)]
    literal = usage.daily_user_usage_literal(events, silver.sessions_by_user(events))
    assert sorted(rows(literal, *cols), key=repr) == sorted(
        [
            (day, "org-a", "u-1", 1, 500, 300, 2_100_000, 1, 1, 1),
            (day, "org-a", None, 1, 0, 0, 0, 0, 0, 0),
            (day, "org-a", None, 0, 0, 0, 0, 0, 1, 0),
            (day, "org-a", None, 0, 0, 0, 0, 0, 0, 1),
        ],
        key=repr,
    )


def test_transcript_with_hot_prompt(spark):
    prompts = spark.createDataFrame(
        [("o", "s", p, "u", i, f"ask {p}", "m") for i, p in enumerate(["p1", "p2", None])],
        "org_id string, session_id string, prompt_id string, user_account_uuid string, event_sequence long,"
        " prompt_text string, model_name string",
    ).withColumn("event_timestamp", F.lit("2026-03-02").cast("timestamp_ntz"))
    answers = [("s", "p1", 100 + i, f"r{i}", "m") for i in range(9)] + [("s", None, 300, "loose", "m")]
    responses = spark.createDataFrame(
        answers, "session_id string, prompt_id string, event_sequence long, response_text string, model_name string"
    ).withColumn("event_timestamp", F.lit("2026-03-02").cast("timestamp_ntz"))
    for rows_per_task in (2, 100):
        lines = usage.transcript_lines(prompts, responses, rows_per_task)
        got = sorted(rows(lines, "prompt_sequence", "response_sequence"), key=repr)
        assert got == sorted([(0, 100 + i) for i in range(9)] + [(1, None), (2, 300)], key=repr)


def test_rejects(spark, fixture_file):
    outcome = reliability.tool_decision_outcome(read(spark, fixture_file("rejects.jsonl")))
    assert dict(rows(outcome, "tool_use_id", "outcome")) == {
        "t1": "executed", "t2": "rejected", "t3": "failed", "t4": "no_result",
    }


def test_recovery(spark, fixture_file):
    events = read(spark, fixture_file("retries.jsonl")).withColumn("event_id", F.col("event_sequence"))
    assert dict(rows(reliability.session_recovery(events), "session_id", "outcome")) == {
        "s-ok": "recovered", "s-stuck": "stalled",
    }


def test_declared_lengths(spark, fixture_file):
    events = norm.normalize(
        landing.with_payload(
            spark.read.text(fixture_file("day.jsonl")).withColumnRenamed("value", "line")
        ).drop("event_name"),
        fields=("event_name", "prompt_text", "prompt_length", "response_text", "response_length"),
    )
    wrong = audit.length_mismatches(events, "prompt_text", "prompt_length")
    assert rows(wrong, "prompt_length", "actual_length") == [(21, 17)]
    assert audit.length_mismatches(events, "response_text", "response_length").count() == 0


def test_truncation_marks_what_it_cuts(spark):
    df = spark.createDataFrame([("é" * 5,), ("abc",), (None,)], "text string")
    got = [tuple(r) for r in norm.truncate_text(df, "text", 4).select("text", "text_length", "text_truncated").collect()]
    assert got == [("éééé", 5, True), ("abc", 3, False), (None, None, None)]


def test_stamp_and_gate(spark):
    df = spark.createDataFrame([("s", "hi", None)], "session_id string, prompt_text string, response_text string")
    row = norm.stamp(norm.gate_content(df, {"prompt_text": False, "response_text": False}), "node-1").first()
    assert (row.prompt_text, row.response_text, row.collector_instance) == ("<REDACTED>", None, "node-1")


def test_prices(spark):
    facts = spark.createDataFrame(
        [("a", 10, 1, None, 0), ("b", 10, 1, None, 0)],
        "model string, input_tokens long, output_tokens long, cache_creation_tokens long, cache_read_tokens long",
    )
    table = spark.createDataFrame([("b", 100, 500, 0, 0)], "model string, input int, output int, cache_creation int, cache_read int")
    want = {"a": 4500, "b": 1500}
    assert dict(rows(with_price_table(facts, table, "model"), "model", "cost_units")) == want
    events = facts.withColumns({"event_name": F.lit("assistant_response"), "session_id": F.lit("s")})
    costs = silver.token_costs(events, {"b": Price(100, 500, 0, 0)}, dedupe=False)
    assert dict(rows(costs, "model_name", "cost_units")) == want


def test_active_users_with_gaps(spark):
    days = [("a", 1), ("a", 2), ("b", 1), ("a", 20), ("c", 9)]
    events = spark.createDataFrame(days, "user_email string, d int").select(
        "user_email", F.date_add(F.lit("2026-03-01").cast("date"), F.col("d")).cast("timestamp_ntz").alias("event_timestamp")
    )
    got = {r.usage_date.day - 1: (r.dau, r.wau, r.mau) for r in adoption.active_users(events, {"dau": 1, "wau": 7, "mau": 30}).collect()}
    assert sorted(got) == list(range(1, 21))
    for d in got:
        want = tuple(len({u for u, x in days if d - n < x <= d}) for n in (1, 7, 30))
        assert got[d] == want
