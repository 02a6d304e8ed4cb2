"""The follow-up of sessions takes rows and asks for and writes a session's state no more than it must."""

from pyspark.sql import Row

from tracelode.streaming.followup import FollowUp


class Kept:
    def __init__(self):
        self.value, self.reads, self.writes = None, 0, 0

    def get(self):
        self.reads += 1
        return self.value

    def update(self, value):
        self.value, self.writes = value, self.writes + 1


class Handle:
    def __init__(self):
        self.state, self.timers = Kept(), []

    def getValueState(self, name, schema):
        return self.state

    def registerTimer(self, at):
        self.timers.append(at)


def test_rows_and_state_calls():
    handle, follow = Handle(), FollowUp(3600)
    follow.init(handle)

    def step(*rows):
        return [r.asDict() for r in follow.handleInputRows(("s",), iter([Row(session_id="s", at=at, failed=failed) for at, failed in rows]), None)]

    assert step((5_000_000, False)) == []
    assert step((4_000_000, False)) == [] and (handle.state.reads, handle.state.writes) == (2, 1)
    assert step((6_000_000, True), (2_000_000, True)) == [{"session_id": "s", "change": 1, "status": "open", "failed_at": 6_000_000}]
    assert handle.timers == [3_606_000]
    assert step((5_500_000, False)) == [] and step((5_600_000, True)) == []
    assert (handle.state.reads, handle.state.writes) == (5, 3)
    assert [r["status"] for r in step((7_000_000, False))] == ["recovered"]
