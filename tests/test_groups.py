"""Keyed state in groups: what a batch of many runs costs a group."""

import json

import pandas as pd

from runlake.config import DEFAULT_POLICY
from runlake.streaming import state, tail

RUNS = 500


class Stored:
    """State in memory that counts its calls."""

    def __init__(self, now=None):
        self.now, self.calls = now, []

    def __getattr__(self, name):
        def call(*args):
            self.calls.append(name)
            if name in ("update", "put"):
                (self.now,) = args
            elif name == "appendValue":
                self.now = (self.now or []) + list(args)
            return iter(self.now or []) if name == "get" and isinstance(self.now, (list, type(None))) and self.of_list else self.now
        return call


class Handle:
    def __init__(self):
        self.value, self.list, self.timers = Stored(), Stored(), set()
        self.value.of_list, self.list.of_list = False, True

    def getValueState(self, *_):
        return self.value

    def getListState(self, *_):
        return self.list

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.remove(ms)


def give(keeper, rows):
    """The group's output rows, its input cut into two frames."""
    frames = [pd.DataFrame({"row": [json.dumps(r) for r in part]}) for part in (rows[:7], rows[7:])]
    return [json.loads(text) for frame in keeper.handleInputRows((1,), iter(frames), None) for text in frame["row"]]


def test_a_batch_of_many_runs_reads_and_writes_a_groups_cursors_once():
    keeper, handle = tail.GroupKeeper(), Handle()
    keeper.init(handle)
    run = lambda i, attempt, status="RUNNING": dict(run_id=i, attempt=attempt, status=status, error=None, seq=None, ts=None, level=None, line=None, is_run=True)
    line = lambda i, attempt, seq: dict(run_id=i, attempt=attempt, seq=seq, ts=2**53 + 1, level=None, line=f"{i} é", status=None, error=None, is_run=False)
    first = give(keeper, [r for i in range(RUNS) for r in (run(i, 1), line(i, 1, 2**53 + 1), line(i, 2, 1))])
    assert sorted((e["run_id"], e["kind"]) for e in first) == [(i, k) for i in range(RUNS) for k in (tail.MARKER, tail.LINE)]
    assert {(e["seq"], e["ts"]) for e in first if e["kind"] == tail.LINE} == {(2**53 + 1, 2**53 + 1)}, "no number becomes a float"
    assert (handle.value.calls, handle.list.calls) == (["get", "update"], ["appendValue"])
    # Lines that wait are not read until a run reaches some.
    assert give(keeper, [line(3, 2, 1), line(3, 1, 2**53 + 1)]) == [] and "get" not in handle.list.calls
    second = give(keeper, [run(i, 2, "SUCCEEDED") for i in range(0, RUNS, 2)])
    assert [e["kind"] for e in second[:3]] == [tail.MARKER, tail.LINE, tail.END] and len(second) == 3 * RUNS // 2
    assert handle.list.calls == ["appendValue", "get", "put"] and handle.value.calls == ["get", "update"] * 3
    third = give(keeper, [run(i, 2) for i in range(RUNS)])
    assert sorted((e["run_id"], e["kind"]) for e in third) == [(i, k) for i in range(1, RUNS, 2) for k in (tail.MARKER, tail.LINE)]


def test_a_batch_of_many_runs_reads_and_writes_a_groups_runs_once_and_arms_one_timer():
    keeper, handle = state.GroupKeeper(DEFAULT_POLICY, True), Handle()
    keeper.init(handle)
    blank = dict.fromkeys(state.FIELDS) | dict(status="QUEUED", attempt=1, max_retries=1, accepted=0, rejected=0)
    keeper.handleInitialState((1,), pd.DataFrame({"runs": [json.dumps([blank | {"run_id": str(i)} for i in range(RUNS)])]}), None)
    assert handle.value.calls == ["update"] and not handle.timers
    claim = lambda i: dict(run_id=str(i), at_us=1_000_000 * (1 + i), tiebreak=None, kind="claim", worker_id="w", attempt=1, message=None)
    got = give(keeper, [*map(claim, range(RUNS)), claim(RUNS)])
    assert {r["id"] for r in got} == {str(i) for i in range(RUNS)} and {r["status"] for r in got} == {"RUNNING"}
    assert handle.value.calls == ["update", "get", "update"] and len(handle.timers) == 1
    (ms,) = handle.timers

    class Clock:
        def getCurrentWatermarkInMs(self):
            return ms + 1000 * 9
    handle.timers.clear()
    lost = [json.loads(text) for frame in keeper.handleExpiredTimer((1,), Clock(), None) for text in frame["row"]]
    assert [r["id"] for r in lost] == [str(i) for i in range(10)] and {r["attempt"] for r in lost} == {2}
    assert len(handle.timers) == 1 and min(handle.timers) > ms + 1000 * 9 and len(handle.value.calls) == 5
