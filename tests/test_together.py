"""What runs at the same time, and what a micro-batch keeps while its tables are written."""

import threading

import pytest

from tracelode.operators import silver
from tracelode.plans import catalog, jobs
from tracelode.session import together
from tracelode.sources import manifest, sinks
from tracelode.streaming import silver as silver_stream

SF = "/root/testdata/sf0.001"


class Meeting:
    """Every caller waits until ``n`` of them are here: one after the other they would never go on."""

    def __init__(self, n):
        self.barrier = threading.Barrier(n, timeout=60)

    def before(self, do):
        def wrapped(*args, **kwargs):
            self.barrier.wait()
            return do(*args, **kwargs)

        return wrapped


def test_results_come_in_order_and_failures_after_all_have_ended(spark):
    done = []

    def fail():
        raise ValueError("no")

    def late():
        done.append(spark.range(3).count())
        return "late"

    assert together(spark, [late, lambda: "b"]) == ["late", "b"]
    assert together(spark, []) == []
    with pytest.raises(ValueError, match="no"):
        together(spark, [fail, late])
    assert done == [3, 3]


def test_local_properties_reach_the_jobs(spark):
    spark.sparkContext.setLocalProperty("who", "caller")
    try:
        assert together(spark, [lambda: spark.sparkContext.getLocalProperty("who")] * 2) == ["caller"] * 2
    finally:
        spark.sparkContext.setLocalProperty("who", None)


def test_tables_are_synced_at_the_same_time(spark, scratch, monkeypatch):
    meeting, tables = Meeting(3), {f"t{i}": spark.range(i + 1) for i in range(3)}
    writer = type(tables["t0"].write)
    monkeypatch.setattr(writer, "save", meeting.before(writer.save))
    assert sinks.sync_tables(tables, lambda name: {"path": f"{scratch}/{name}"}) == list(tables)
    assert [spark.read.parquet(f"{scratch}/{t}").count() for t in tables] == [1, 2, 3]
    assert sinks.sync_tables({}, lambda name: {}) == []


def test_tables_are_compacted_at_the_same_time(spark, scratch, monkeypatch):
    monkeypatch.setattr(manifest, "compact", Meeting(len(jobs.BATCH_TABLES)).before(lambda *args: args[1]))
    assert jobs.run_compaction(spark, scratch) == {name: f"{scratch}/silver/{name}" for name in jobs.BATCH_TABLES}


def test_fan_out_fills_the_batch_by_one_write_and_then_writes_together(spark, scratch, monkeypatch):
    """And keeps no column that the silver tables have not."""
    root, order, kept = catalog._bronze(spark, SF, "together"), [], []
    meeting, write, parts = Meeting(5), silver_stream.write_table, silver.session_parts

    def watched(df, path, *args, **kwargs):
        name = path.split("/")[-2]
        if name != "session_parts":
            meeting.barrier.wait()
        order.append(name)
        return write(df, path, *args, **kwargs)

    monkeypatch.setattr(silver_stream, "write_table", watched)
    monkeypatch.setattr(silver, "session_parts", lambda events: kept.append(events.columns) or parts(events))
    events = silver_stream.bronze_events(spark, root)
    assert "source_file" in events.columns
    silver_stream.fan_out(events, lambda name: f"{scratch}/{name}", f"{scratch}/checkpoint")
    assert order[0] == "session_parts" and sorted(order[1:]) == sorted(["session_days", "prompts", "responses", "tool_executions", "token_costs"])
    assert not {"source_file", "batch_id", "malformed", "ingest_day"} & set(kept[0])
    assert spark.conf.get("spark.sql.inMemoryColumnarStorage.compressed") == "true"
    good = events_of(spark, root)
    stored = silver_stream.read_sessions(spark, f"{scratch}/session_parts")
    assert sorted(map(str, stored.collect())) == sorted(map(str, silver.sessions(good).collect()))
    for name, facts in silver.facts(good, dedupe=False).items():
        written = spark.read.parquet(f"{scratch}/{name}").select(facts.columns)
        assert written.exceptAll(facts).count() == facts.exceptAll(written).count() == 0


def events_of(spark, root):
    return catalog.norm.normalize(catalog.bronze_stream.read_bronze(spark, root))
