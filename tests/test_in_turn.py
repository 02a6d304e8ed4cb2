"""Checks of tables that are compacted together: one at a time, and none after a failure."""

import threading

import pytest

from tracelode.plans import jobs
from tracelode.session import InTurn, together
from tracelode.sources import manifest


def test_one_at_a_time_and_none_after_a_failure(spark):
    turn, inside, seen = InTurn(), [], []

    def block(n):
        with turn:
            inside.append(n)
            threading.Event().wait(0.05)
            seen.append(list(inside))
            inside.remove(n)

    together(spark, [lambda n=n: block(n) for n in range(4)])
    assert sorted(seen) == [[0], [1], [2], [3]]
    with pytest.raises(ValueError), turn:
        raise ValueError
    with pytest.raises(RuntimeError, match="another failed"):
        block(5)
    assert inside == [] and len(seen) == 4


def test_compactions_share_their_turns(spark, scratch, monkeypatch):
    monkeypatch.setattr(manifest, "compact", lambda *args: args[-1])
    turns = jobs.run_compaction(spark, scratch)
    assert len({id(t) for t in turns.values()}) == 1 and all(isinstance(t, InTurn) for t in turns.values())
    assert jobs.run_compaction(spark, scratch)["prompts"] is not turns["prompts"]
