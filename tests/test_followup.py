"""Follow-up of failed sessions: the stream's last reports equal the batch result, however files fall into batches."""

import json
import random
from pathlib import Path

import pytest

from tracelode.operators.normalize import normalize
from tracelode.session import configure
from tracelode.streaming import bronze, followup, silver


def land(root, seed=3, files=6):
    """Sessions that fail, recover, fail again, or stay silent; records of a session lie in any file."""
    rng = random.Random(seed)
    records = []
    for s in range(40):
        for _ in range(rng.randint(1, 5)):
            minute = rng.randrange(24 * 60)
            at = {"session_id": f"s{s}", "event_timestamp": f"2026-03-02T{minute // 60:02}:{minute % 60:02}:{rng.randrange(60):02}Z", "org_id": "o"}
            if rng.random() < 0.5:
                records.append(at | {"event_name": "api_error", "attempt": rng.choice([2, 11, 12])})
            else:
                records.append(at | {"event_name": rng.choice(["assistant_response", "api_request", "user_prompt"])})
    records.append({"session_id": None, "event_timestamp": "2026-03-02T05:00:00Z", "event_name": "api_error", "attempt": 11})
    rng.shuffle(records)
    folder = Path(root) / "logs"
    folder.mkdir(parents=True)
    for i in range(files):
        (folder / f"{i}.jsonl").write_text("".join(json.dumps(r) + "\n" for r in records[i::files]))


def rows(df):
    return sorted(tuple(r) for r in df.select("session_id", "status", "last_exhausted_at").collect())


@pytest.mark.parametrize("max_files", [1, 3, 1000])
def test_last_reports_equal_the_batch(spark, scratch, max_files):
    configure(spark)
    land(scratch)
    bronze.ingest(spark, f"{scratch}/logs", f"{scratch}/bronze", f"{scratch}/c1", 1, "*.jsonl")
    events = silver.bronze_events(spark, f"{scratch}/bronze", max_files)
    followup.follow_up(events, f"{scratch}/reports", f"{scratch}/c2")
    want = rows(followup.follow_up_batch(normalize(bronze.read_bronze(spark, f"{scratch}/bronze"))))
    assert {s for _, s, _ in want} >= {"recovered", "stalled"}
    assert rows(followup.read_reports(spark, f"{scratch}/reports")) == want


def test_a_late_answer_takes_the_report_back(spark, scratch):
    """A report of a stalled session, then an answer that arrives in a later run; another session stays as it was."""
    configure(spark)

    def step(name, records):
        folder = Path(scratch) / "logs"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("".join(json.dumps({"org_id": "o"} | r) + "\n" for r in records))
        bronze.ingest(spark, f"{scratch}/logs", f"{scratch}/bronze", f"{scratch}/c1", 1, "*.jsonl")
        followup.follow_up(silver.bronze_events(spark, f"{scratch}/bronze"), f"{scratch}/reports", f"{scratch}/c2")
        return {r.session_id: r.status for r in followup.read_reports(spark, f"{scratch}/reports").collect()}

    def at(minute):
        return f"2026-03-02T{10 + minute // 60:02}:{minute % 60:02}:00Z"

    failed = {"event_name": "api_error", "attempt": 11}
    assert step("a.jsonl", [failed | {"session_id": s, "event_timestamp": at(0)} for s in ("x", "y")]) == {"x": "open", "y": "open"}
    assert step("b.jsonl", [{"event_name": "assistant_response", "session_id": "z", "event_timestamp": at(70)}]) == {"x": "stalled", "y": "stalled"}
    assert step("c.jsonl", [{"event_name": "assistant_response", "session_id": "x", "event_timestamp": at(50)}]) == {"x": "recovered", "y": "stalled"}
    assert step("d.jsonl", [failed | {"session_id": "x", "event_timestamp": at(80)}]) == {"x": "open", "y": "stalled"}
