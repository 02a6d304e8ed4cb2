"""Bronze, silver and gold as jobs: batch equals stream, late and repeated input."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tracelode.operators import silver
from tracelode.operators.normalize import normalize
from tracelode.plans import jobs, views
from tracelode.session import configure
from tracelode.sources import landing, manifest, serving, sinks
from tracelode.streaming import bronze as bronze_stream


def land(fixture_file, root, name, target=None):
    folder = Path(root) / "landing" / "year=2026" / "month=03"
    folder.mkdir(parents=True, exist_ok=True)
    shutil.copy(fixture_file(name), folder / (target or name))


def step(spark, root):
    jobs.run_bronze(spark, f"{root}/landing", root, glob="*.jsonl")
    jobs.run_silver(spark, root)


def same(a, b):
    cols = sorted(a.columns)
    assert sorted(map(repr, a.select(cols).collect())) == sorted(map(repr, b.select(cols).collect()))


def test_stream_equals_batch_and_ignores_redelivery(spark, fixture_file, scratch):
    for name in ("dups_a.jsonl", "rejects.jsonl", "bad.jsonl"):
        land(fixture_file, scratch, name)
    step(spark, scratch)
    tables = jobs.read_silver(spark, scratch)
    before = {n: sorted(map(repr, t.drop("batch_id").collect())) for n, t in tables.items()}
    same(tables["sessions"], jobs.sessions_from_scratch(spark, scratch))
    events = normalize(bronze_stream.read_bronze(spark, f"{scratch}/bronze"))
    for name, want in silver.facts(events).items():
        same(tables[name].drop("batch_id", "event_date", "processed_at"), want)
    assert bronze_stream.read_quarantine(spark, f"{scratch}/bronze").count() == 4

    land(fixture_file, scratch, "dups_b.jsonl")
    step(spark, scratch)
    again = jobs.read_silver(spark, scratch)
    assert {n: sorted(map(repr, t.drop("batch_id").collect())) for n, t in again.items()} == before


def test_nothing_new_adds_nothing(spark, fixture_file, scratch):
    land(fixture_file, scratch, "day.jsonl")
    step(spark, scratch)
    step(spark, scratch)
    assert bronze_stream.read_bronze(spark, f"{scratch}/bronze").count() == 3


def test_late_event_reopens_its_session_and_its_day(spark, fixture_file, scratch):
    land(fixture_file, scratch, "late_1.jsonl")
    step(spark, scratch)
    jobs.run_gold(spark, scratch)
    days = spark.read.parquet(f"{scratch}/gold/daily_user_metrics")
    assert {(str(r.usage_date), r.user_email) for r in days.collect()} == {
        ("2026-03-03", "bob@example.com"), ("2026-03-03", "cy@example.com"),
    }

    land(fixture_file, scratch, "late_2.jsonl")
    step(spark, scratch)
    same(jobs.read_silver(spark, scratch)["sessions"], jobs.sessions_from_scratch(spark, scratch))
    newest = spark.read.parquet(f"{scratch}/silver/prompts").agg(F.max("batch_id")).first()[0]
    jobs.run_gold(spark, scratch, since_batch=newest)
    days = spark.read.parquet(f"{scratch}/gold/daily_user_metrics")
    got = {(str(r.usage_date), r.user_email, r.total_prompts, r.total_duration_sec) for r in days.collect()}
    assert ("2026-03-02", "bob@example.com", 2, 1800) in got
    used = spark.read.parquet(f"{scratch}/gold/daily_user_usage")
    assert {(str(r.usage_date), r.sessions, r.prompts, r.tool_events) for r in used.collect()} == {
        ("2026-03-02", 1, 1, 0), ("2026-03-03", 1, 2, 1),
    }


@pytest.mark.parametrize("keep_others", [True, False])
def test_touched_days_equal_a_full_recompute(spark, fixture_file, scratch, keep_others):
    """Two batches, gold after each; then the same gold from scratch in another place."""
    land(fixture_file, scratch, "late_1.jsonl")
    land(fixture_file, scratch, "lone_1.jsonl")
    if keep_others:
        land(fixture_file, scratch, "dups_a.jsonl")
    for name in ("rejects.jsonl",):
        land(fixture_file, scratch, name)
    step(spark, scratch)
    jobs.run_gold(spark, scratch)
    for name in ("late_2.jsonl", "lone_2.jsonl", "same_tick.jsonl", "shapes.jsonl"):
        land(fixture_file, scratch, name)
    step(spark, scratch)
    tables = jobs.read_silver(spark, scratch)
    newest = tables["prompts"].agg(F.max("batch_id")).first()[0]
    jobs.run_gold(spark, scratch, since_batch=newest)
    for name, (df, _) in jobs.gold_tables(tables).items():
        same(spark.read.schema(df.schema).parquet(f"{scratch}/gold/{name}"), df)


def test_serving_and_roles(spark, fixture_file, scratch):
    for name in ("day.jsonl", "rejects.jsonl"):
        land(fixture_file, scratch, name)
    step(spark, scratch)
    jobs.run_gold(spark, scratch)
    names = jobs.run_sync(spark, scratch, lambda n: {"path": f"{scratch}/served/{n}"})
    assert len(names) == 8
    assert spark.read.parquet(f"{scratch}/served/token_costs").count() == 1

    tables = jobs.read_silver(spark, scratch)
    available = views.serving_views(tables)
    assert "v_security_leak_audit" not in views.register(available, "executive")
    assert views.register(available, "security_audit") == ["v_security_leak_audit"]
    assert len(views.register(available)) == 4
    total = spark.sql("SELECT sum(total_spend_usd) AS usd, max(metric_date) AS day FROM v_executive_daily_kpis").first()
    assert total.usd == 0.02 and str(total.day) == "2026-03-02"
    for name in views.register(available, "executive"):
        assert not {"prompt_text", "response_text", "flagged_content_snippet"} & set(spark.table(name).columns)


def test_sql_key_function(spark):
    views.register_functions(spark)
    from tracelode.functions.keys import surrogate_key

    df = spark.createDataFrame([("s", "p", "1")], "a string, b string, c string")
    row = df.select(surrogate_key("a", "b", "c", F.lit("prompt")).alias("x"), F.expr("event_key(a, b, c, 'prompt')").alias("y")).first()
    assert row.x == row.y


def test_partition_overwrite_keeps_other_days(spark, scratch):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "day int, v string")
    sinks.write_table(first, scratch, ["day"], files_per_partition=3)
    sinks.write_table(spark.createDataFrame([(2, "c")], "day int, v string"), scratch, ["day"], only_touched=True)
    assert sorted(tuple(r) for r in spark.read.parquet(scratch).select("day", "v").collect()) == [(1, "a"), (2, "c")]


def test_copy_into_skips_bad_lines(spark, fixture_file):
    assert landing.copy_into(spark, fixture_file("bad.jsonl")).count() == 5


def test_repeated_keys_marks_and_bad_bytes(spark, scratch):
    Path(scratch).mkdir(parents=True)
    Path(scratch, "a.jsonl").write_bytes(
        b'{"event_name":"x","session_id":"a","session_id":"b"}\n\xef\xbb\xbf {"event_name":"y"}\n{"event_name":"z\xff"}\n'
    )
    configure(spark)
    names = sorted(r.event_name for r in landing.with_payload(landing.read_lines(spark, scratch)).collect())
    assert names == ["x", "y", "z\ufffd"]
    assert {r.session_id for r in normalize(landing.copy_into(spark, scratch)).collect()} == {"b", None}


def test_raw_bodies(spark, scratch):
    Path(scratch).mkdir(parents=True)
    Path(scratch, "u1.request.json").write_text('{\n "model": "model-m"\n}')
    row = landing.read_bodies(spark, scratch).select("kind", "body_length", F.expr("try_variant_get(payload, '$.model', 'string')")).first()
    assert tuple(row) == ("request", len(b'{\n "model": "model-m"\n}'), "model-m")


def test_catalogue_table(spark, scratch):
    df = spark.createDataFrame([("a", 1)], "v string, day int")
    sinks.write_table(df, scratch, ["day"])
    sinks.register_table(spark, "lake", "t_" + Path(scratch).name.replace("-", "_"), scratch, df.schema, ["day"])
    assert spark.table("lake.t_" + Path(scratch).name.replace("-", "_")).count() == 1


def test_cluster_without_shared_folder_is_refused():
    from tracelode.session import scratch_dir

    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        scratch_dir(Session(), "x")


def test_many_small_batches_equal_one(spark, fixture_file, scratch):
    for name in ("late_1.jsonl", "late_2.jsonl", "rejects.jsonl", "retries.jsonl", "day.jsonl"):
        land(fixture_file, scratch, name)
    jobs.run_bronze(spark, f"{scratch}/landing", scratch, glob="*.jsonl", max_files=1)
    jobs.run_silver(spark, scratch, max_files=2, files_per_day=2)
    tables = jobs.read_silver(spark, scratch)
    assert tables["prompts"].select("batch_id").distinct().count() > 1
    same(tables["sessions"], jobs.sessions_from_scratch(spark, scratch))
    events = normalize(bronze_stream.read_bronze(spark, f"{scratch}/bronze"))
    for name, want in silver.facts(events).items():
        same(tables[name].drop("batch_id", "event_date", "processed_at"), want)


@pytest.mark.parametrize("max_files", [1, 3, 1000])
def test_tool_counts_do_not_depend_on_the_batches(spark, scratch, max_files):
    from tracelode.plans import catalog
    from tracelode.sources import testdata as td
    from tracelode.streaming import silver as silver_stream

    events = td.canonical(spark, "/root/testdata/sf0.001")
    root = catalog._land(spark, events, "counts")
    bronze_stream.ingest(spark, f"{root}/logs", f"{root}/bronze", f"{root}/c1", 10, "*.gz")
    streamed = silver_stream.bronze_events(spark, f"{root}/bronze", max_files)
    silver_stream.count_tools(streamed, f"{root}/counts", f"{root}/c2")
    batch = silver_stream.tool_counts(normalize(bronze_stream.read_bronze(spark, f"{root}/bronze")))
    same(silver_stream.read_tool_counts(spark, f"{root}/counts"), batch)


def log_lines(folder, name, records):
    import json

    target = Path(folder) / "landing" / "year=2026"
    target.mkdir(parents=True, exist_ok=True)
    (target / name).write_text("".join(json.dumps(r) + "\n" for r in records))


def test_alerts_and_transcripts_cover_all_texts(spark, scratch):
    """A secret in each of the four texts, and a personal address in a transcript."""
    at = {"event_timestamp": "2026-03-02T10:00:00Z", "session_id": "s", "org_id": "o", "prompt_id": "p",
          "user_account_uuid": "u1", "user_email": "ann@example.com"}
    log_lines(scratch, "a.jsonl", [
        at | {"event_name": "user_prompt", "event_sequence": 1, "prompt_text": "password=hunter21 mail bob@example.org"},
        at | {"event_name": "assistant_response", "event_sequence": 2, "response_text": 'token = "24bead" by eve@example.org'},
        at | {"event_name": "tool_result", "event_sequence": 3, "tool_name": "Bash",
              "tool_input": '{"password": "hunter22"}', "tool_output": "AKIA" + "Z" * 16},
    ])
    step(spark, scratch)
    jobs.run_gold(spark, scratch)
    newest = jobs.read_silver(spark, scratch)["prompts"].agg(F.max("batch_id")).first()[0]
    for since in (None, newest):
        if since is not None:
            jobs.run_gold(spark, scratch, since_batch=since)
        alerts = spark.read.parquet(f"{scratch}/gold/security_leak_alerts").collect()
        assert sorted(r.source for r in alerts) == ["prompt", "response", "tool_input", "tool_output"]
        assert all("[REDACTED_" in r.flagged_text and "hunter2" not in r.flagged_text for r in alerts)
        lines = spark.read.parquet(f"{scratch}/gold/compliance_transcript_lines").collect()
        assert len(lines) == 1
        assert "example.org" not in lines[0].prompt_text + lines[0].response_text and lines[0].user_account_uuid != "u1"


def test_redelivery_of_records_without_a_time(spark, scratch):
    """Delivered again in a later batch, they count once: events, sessions and spend."""
    records = [
        {"event_name": "assistant_response", "session_id": "s", "org_id": "o", "event_sequence": i, "message_uuid": f"m{i}",
         "input_tokens": 10, "output_tokens": 1, "cost_usd": 0.25 if i % 2 else None}
        for i in range(4)
    ] + [{"event_name": "assistant_response", "session_id": "s", "org_id": "o", "message_uuid": "x", "cost_usd": 1.0}]
    log_lines(scratch, "a.jsonl", records)
    step(spark, scratch)
    first = jobs.read_silver(spark, scratch)
    spend = first["token_costs"].agg(F.sum("cost_units"), F.count("*")).first()
    log_lines(scratch, "b.jsonl", records)
    step(spark, scratch)
    again = jobs.read_silver(spark, scratch)
    assert tuple(again["token_costs"].agg(F.sum("cost_units"), F.count("*")).first()) == tuple(spend) and spend[1] == 5
    assert again["sessions"].first().total_responses == 5


# Merging of batch folders, retention


def stored_rows(spark, root):
    return {n: sorted(map(repr, t.collect())) for n, t in jobs.read_silver(spark, root).items()}


def test_merged_files_hold_the_same_rows(spark, fixture_file, scratch):
    """Five batches merged in two steps, a late batch after each, gold of changed days, and a stream that goes on."""
    names = ("late_1.jsonl", "rejects.jsonl", "retries.jsonl", "day.jsonl", "same_tick.jsonl")
    for name in names:
        land(fixture_file, scratch, name)
        step(spark, scratch)
    before = stored_rows(spark, scratch)
    first = jobs.run_compaction(spark, scratch)
    assert stored_rows(spark, scratch) == before
    newest = spark.read.parquet(f"{scratch}/silver/prompts").agg(F.max("batch_id")).first()[0]
    now = manifest.snapshot(spark, f"{scratch}/silver/session_parts")
    assert (now.version, now.upto) == (0, newest - 1)
    assert first["session_parts"].files_before > first["session_parts"].files_after == 1
    again = jobs.run_compaction(spark, scratch)
    assert all(c.version is None and c.files_after == c.files_before for c in again.values())
    jobs.run_gold(spark, scratch)

    land(fixture_file, scratch, "late_2.jsonl")
    step(spark, scratch)
    late = stored_rows(spark, scratch)
    assert len(late["prompts"]) > len(before["prompts"])
    jobs.run_compaction(spark, scratch, upto=newest + 1)
    assert stored_rows(spark, scratch) == late
    assert manifest.snapshot(spark, f"{scratch}/silver/session_parts").version == 1
    jobs.run_gold(spark, scratch, since_batch=newest + 1)
    for name, (df, _) in jobs.gold_tables(jobs.read_silver(spark, scratch)).items():
        same(spark.read.schema(df.schema).parquet(f"{scratch}/gold/{name}"), df)


def test_a_stop_before_the_manifest_changes_nothing(spark, fixture_file, scratch, monkeypatch):
    for name in ("late_1.jsonl", "rejects.jsonl", "day.jsonl"):
        land(fixture_file, scratch, name)
        step(spark, scratch)
    before = stored_rows(spark, scratch)

    def stop(*_):
        raise KeyboardInterrupt

    real = manifest.publish
    monkeypatch.setattr(manifest, "publish", stop)
    with pytest.raises(KeyboardInterrupt):
        jobs.run_compaction(spark, scratch)
    assert list(Path(f"{scratch}/silver").glob("*/_compacted/*"))
    assert stored_rows(spark, scratch) == before
    monkeypatch.setattr(manifest, "publish", real)
    jobs.run_compaction(spark, scratch)
    assert stored_rows(spark, scratch) == before


def test_a_wrong_rewrite_is_not_published(spark, fixture_file, scratch, monkeypatch):
    for name in ("late_1.jsonl", "rejects.jsonl", "day.jsonl"):
        land(fixture_file, scratch, name)
        step(spark, scratch)
    sums = iter([(1, 2), (1, 3)])
    monkeypatch.setattr(manifest, "checksum", lambda rows: next(sums))
    with pytest.raises(RuntimeError):
        jobs.run_compaction(spark, scratch)
    assert manifest.snapshot(spark, f"{scratch}/silver/prompts") is None


def test_bins_of_files(spark):
    files = [(f"f{i:02}", size, 1, day) for i, (size, day) in enumerate([(10, "a"), (20, "a"), (90, "a"), (30, "a"), (45, "a"), (5, "b"), (60, "c"), (49, "a")])]
    got = manifest.plan(spark.createDataFrame(files, "path string, bytes long, rows long, day string"), ["day"], 100).collect()
    bins = {r.path: r.bin for r in got}
    assert bins == {"f00": 0, "f01": 0, "f02": None, "f03": 0, "f04": 0, "f05": None, "f06": None, "f07": 1} | {"f07": None}


def test_retention_never_takes_what_a_version_names(spark, fixture_file, scratch):
    from datetime import datetime, timedelta

    for name in ("late_1.jsonl", "rejects.jsonl", "bad.jsonl", "day.jsonl"):
        land(fixture_file, scratch, name)
        step(spark, scratch)
    now = datetime.now()
    before = stored_rows(spark, scratch)
    assert not any(jobs.run_retention(spark, scratch, now, dry_run=True).values())
    jobs.run_compaction(spark, scratch)
    assert not any(jobs.run_retention(spark, scratch, now, dry_run=True).values())
    later = now + timedelta(days=31)
    due = jobs.run_retention(spark, scratch, later, dry_run=True)
    batches = sorted(r.batch_id for r in spark.read.parquet(f"{scratch}/silver/session_parts").select("batch_id").distinct().collect())
    newest = batches[-1]
    assert due["silver/session_parts"] == [f"batch_id={i}" for i in batches[:-1]]
    assert due["bronze"] and all("malformed=1" in x for x in due["bronze"])
    assert stored_rows(spark, scratch) == before  # a dry run
    assert jobs.run_retention(spark, scratch, later, dry_run=False) == due
    spark.catalog.clearCache()
    assert not any(jobs.run_retention(spark, scratch, later, dry_run=True).values())
    assert stored_rows(spark, scratch) == before
    assert bronze_stream.read_quarantine(spark, f"{scratch}/bronze").count() == 0

    land(fixture_file, scratch, "late_2.jsonl")
    step(spark, scratch)
    more = stored_rows(spark, scratch)
    jobs.run_compaction(spark, scratch, upto=newest + 1)
    replaced = manifest.expired(spark, f"{scratch}/silver/session_parts", datetime.now() + timedelta(days=1))
    assert {r.reason for r in replaced.collect()} == {"merged", "replaced"}
    jobs.run_retention(spark, scratch, later + timedelta(days=2), dry_run=False)
    assert stored_rows(spark, scratch) == more


# Serving of changed days


def test_a_late_event_moves_the_days_it_changes(spark, fixture_file, scratch, monkeypatch):
    land(fixture_file, scratch, "late_1.jsonl")
    land(fixture_file, scratch, "day.jsonl")
    step(spark, scratch)
    jobs.run_gold(spark, scratch)
    target = f"{scratch}/served"
    first = jobs.run_sync_changed(spark, scratch, target)
    assert first["daily_user_metrics"].moved == first["daily_user_metrics"].days >= 2
    assert all(s.moved == 0 and s.removed == 0 for s in jobs.run_sync_changed(spark, scratch, target).values())

    land(fixture_file, scratch, "late_2.jsonl")
    step(spark, scratch)
    newest = jobs.read_silver(spark, scratch)["prompts"].agg(F.max("batch_id")).first()[0]
    jobs.run_gold(spark, scratch, since_batch=newest)

    def stop(*_):
        raise KeyboardInterrupt

    df = spark.read.parquet(f"{scratch}/gold/daily_user_metrics").drop("processed_at")
    before = sorted(map(repr, serving.read(spark, f"{target}/daily_user_metrics", df.schema, "usage_date").collect()))
    real = serving.publish
    monkeypatch.setattr(serving, "publish", stop)
    with pytest.raises(KeyboardInterrupt):
        jobs.run_sync_changed(spark, scratch, target)
    assert sorted(map(repr, serving.read(spark, f"{target}/daily_user_metrics", df.schema, "usage_date").collect())) == before
    monkeypatch.setattr(serving, "publish", real)
    second = jobs.run_sync_changed(spark, scratch, target)
    assert second["daily_user_metrics"].moved < first["daily_user_metrics"].days + 2 and second["daily_user_metrics"].moved >= 1
    for name, (table, date) in jobs.gold_tables(jobs.read_silver(spark, scratch)).items():
        same(serving.read(spark, f"{target}/{name}", table.schema, date), table)


def test_days_without_a_date_and_days_that_go(spark, scratch):
    import datetime

    day = datetime.date(2026, 3, 2)
    rows = spark.createDataFrame([(day, 1), (None, 2), (datetime.date(2026, 3, 3), 3)], "day date, v int")
    assert serving.sync_changed(rows, "day", scratch) == (3, 3, 0)
    same(serving.read(spark, scratch, rows.schema, "day"), rows)
    fewer = rows.filter("v != 3").union(spark.createDataFrame([(None, 9)], "day date, v int"))
    assert serving.sync_changed(fewer, "day", scratch) == (2, 1, 1)
    same(serving.read(spark, scratch, rows.schema, "day"), fewer)
    assert serving.sync_changed(rows.limit(0), "day", scratch) == (0, 0, 2)
    assert serving.read(spark, scratch, rows.schema, "day").count() == 0
