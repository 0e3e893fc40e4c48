"""The fold against a plain Python replay, in chunks of any size, whole and in halves."""

import datetime as dt
import random

import pytest
from helpers import ago, jobs, running, runs

from runlake.operators.fold import state_fold, unknown_events
from runlake.schema import RUNS

KINDS = ["claim", "heartbeat", "finish", "fail", "release", "fail_queued"]
EVENT = "run_id string, at timestamp, tiebreak int, kind string, worker_id string, attempt int, message string"


def make_events(seed, per_run):
    rng = random.Random(seed)
    out = []
    for run, n in per_run.items():
        for i in range(n):
            out.append((run, ago(0) + dt.timedelta(seconds=rng.randint(0, n * 2)), rng.randint(0, 3),
                        rng.choices(KINDS, [6, 8, 0.4, 4, 4, 0.1])[0], rng.choice(["w0", "w0", "w1", "w1", None]), rng.randint(1, 6), f"m{i}"))
    return out


def replay(run, max_retries, events):
    s = dict(run, accepted=0, rejected=0)
    for _, at, _, kind, worker, attempt, message in sorted(events, key=in_order):
        own = s["status"] == "RUNNING" and worker is not None and s["worker_id"] == worker and s["attempt"] == attempt
        queued = dict(status="QUEUED", attempt=s["attempt"] + 1, worker_id=None, queued_at=at, started_at=None, last_heartbeat_at=None)
        if kind == "claim" and s["status"] == "QUEUED" and (s["next_attempt_at"] is None or s["next_attempt_at"] <= at):
            new = dict(status="RUNNING", worker_id=worker, started_at=at, last_heartbeat_at=at, finished_at=None, next_attempt_at=None)
        elif kind == "heartbeat" and own:
            new = dict(last_heartbeat_at=at)
        elif kind == "finish" and own:
            new = dict(status="SUCCEEDED", output=message, error=None, finished_at=at)
        elif kind == "release" and own:
            new = dict(queued, error=message)
        elif kind == "fail" and own and max_retries is None:
            s["rejected"] += 1
            continue
        elif kind == "fail" and own and s["attempt"] > max_retries:
            new = dict(status="FAILED", finished_at=at, error=message, next_attempt_at=None)
        elif kind == "fail" and own:
            wait = min(5 * 2 ** (s["attempt"] - 1), 300)
            new = dict(queued, error=message, finished_at=None, next_attempt_at=at + dt.timedelta(seconds=wait))
        elif kind == "fail_queued" and s["status"] == "QUEUED":
            new = dict(status="FAILED", finished_at=at, error=message)
        else:
            s["rejected"] += 1
            continue
        s.update(new, accepted=s["accepted"] + 1)
    return s


def in_order(event):
    return [(x is not None, x) for x in event[1:]]


def retries(run):
    return 3 if run.job_id == "j1" else None


@pytest.fixture(scope="module")
def case(spark):
    per_run = {"r0": 0, "r1": 5, "r2": 40, "r3": 400, "r4": 400, "r5": 60}
    rows = [dict(id=r, scheduled_time=ago(i), **(running() if r == "r4" else {}), **(dict(job_id="gone") if r == "r5" else {}))
            for i, r in enumerate(per_run)]
    table = runs(spark, *rows)
    events = make_events(7, per_run)
    want = {}
    for r in table.collect():
        want[r.id] = replay(r.asDict(), retries(r), [e for e in events if e[0] == r.id])
    return table, jobs(spark, dict(max_retries=3)), events, want


def check(df, want):
    got = {r.id: r.asDict() for r in df.collect()}
    assert got.keys() == want.keys()
    for run, row in got.items():
        assert row == want[run], run


@pytest.mark.parametrize("chunk", [50_000, 57, 30])
def test_fold_equals_replay(spark, case, chunk):
    table, job, events, want = case
    check(state_fold(table, job, spark.createDataFrame(events, EVENT).repartition(5), chunk=chunk), want)


def test_one_event_at_a_time(spark, case):
    table, job, _, _ = case
    events = make_events(1, {f"r{i}": 7 for i in range(6)})
    want = {r.id: replay(r.asDict(), retries(r), [e for e in events if e[0] == r.id]) for r in table.collect()}
    for chunk in (1, 3, 7):
        check(state_fold(table, job, spark.createDataFrame(events, EVENT), chunk=chunk), want)


def test_a_worker_without_a_name_owns_nothing(spark, case):
    table, job, _, _ = case
    events = [("r0", ago(9), 0, "claim", None, 1, None), ("r0", ago(8), 0, "finish", None, 1, "out"), ("nobody", ago(7), 0, "claim", "w", 1, None)]
    for chunk in (1, 50_000):
        got = {r.id: r for r in state_fold(table, job, spark.createDataFrame(events, EVENT), chunk=chunk).collect()}
        assert len(got) == 6 and (got["r0"].status, got["r0"].accepted, got["r0"].rejected) == ("RUNNING", 1, 1)
    assert [tuple(r) for r in unknown_events(table, spark.createDataFrame(events, EVENT)).collect()] == [("nobody", 1)]


def test_two_halves_equal_one_pass(spark, case):
    table, job, events, want = case
    ordered = sorted(events, key=in_order)
    cut = [ordered[:len(ordered) // 2], ordered[len(ordered) // 2:]]
    first = state_fold(table, job, spark.createDataFrame(cut[0], EVENT)).collect()
    middle = spark.createDataFrame([tuple(r[c] for c in RUNS) for r in first], table.schema)
    second = {r.id: r.asDict() for r in state_fold(middle, job, spark.createDataFrame(cut[1], EVENT)).collect()}
    for r in first:
        second[r.id]["accepted"] += r.accepted
        second[r.id]["rejected"] += r.rejected
    assert second == want


def test_attempts_never_fall_and_final_runs_never_change(case):
    table, _, events, want = case
    for r in table.collect():
        mine = sorted((e for e in events if e[0] == r.id), key=in_order)
        last = r.asDict()
        for n in range(0, len(mine), 20):
            now = replay(r.asDict(), retries(r), mine[:n])
            assert now["attempt"] >= last["attempt"]
            if last["status"] in ("SUCCEEDED", "FAILED"):
                assert now["status"] == last["status"]
            last = now


def test_a_pass_opens_the_files_of_its_chunk_only(spark, case, monkeypatch):
    from pyspark.sql import functions as F

    from runlake.operators import fold
    opened, real = [], fold._fold

    def spy(runs, events, *rest):
        opened.append({r[0].split("_chunk=")[1].split("/")[0] for r in events.select(F.input_file_name()).distinct().collect()})
        assert "PartitionFilters: [isnotnull(_chunk" in events._jdf.queryExecution().executedPlan().toString()
        return real(runs, events, *rest)
    monkeypatch.setattr(fold, "_fold", spy)
    table, job, events, want = case
    check(state_fold(table, job, spark.createDataFrame(events, EVENT), chunk=40), want)
    assert len(opened) > 2 and opened == [{str(k)} for k in range(len(opened))]
