import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import NOW, ago, as_of, jobs, row, running, runs
from runlake.config import Policy
from runlake.functions import retry
from runlake.operators import transitions as t
from runlake.plans.maintenance import maintenance_pass


def reports(spark, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], "run_id string, worker_id string, attempt int, note string")


def test_claim_takes_the_first_request_and_keeps_the_old_error(spark):
    table = runs(spark, dict(error="boom", attempt=2, next_attempt_at=ago(0)), dict(id="r2", next_attempt_at=ago(-1)),
                 dict(id="r3", **running()))
    asked = spark.createDataFrame(
        [("r1", f"w{i}", ago(i), i) for i in range(8)] + [("r2", "w1", ago(1), 9), ("r3", "w9", ago(1), 10)],
        "run_id string, worker_id string, arrived_at timestamp, offset_no int")
    got = row(t.claim(table, asked, as_of()).changed)
    assert (got.id, got.status, got.worker_id, got.attempt, got.error) == ("r1", "RUNNING", "w7", 2, "boom")
    assert got.started_at == got.last_heartbeat_at == NOW and got.next_attempt_at is None


def test_only_the_owner_may_report(spark):
    table = runs(spark, running(), dict(id="r2", **running(attempt=2)))
    said = reports(spark, ("r1", "w1", 1, "x"), ("r2", "w1", 1, "old attempt"), ("r2", "w2", 2, "other worker"))
    assert [r.id for r in t.heartbeat(table, said.drop("note"), as_of()).changed.collect()] == ["r1"]
    assert sorted(r.note for r in t.lost_reports(table, said).collect()) == ["old attempt", "other worker"]
    done = row(t.finish(table, said.withColumnRenamed("note", "output"), as_of()).changed)
    assert (done.status, done.output, done.error, done.finished_at) == ("SUCCEEDED", "x", None, NOW)
    snap = t.finish(table, said.withColumnRenamed("note", "output"), as_of()).snapshot
    assert {r.id: r.status for r in snap.collect()} == {"r1": "SUCCEEDED", "r2": "RUNNING"}


def test_release_ignores_the_retry_limit(spark):
    table = runs(spark, running(attempt=5))
    got = row(t.release(table, reports(spark, ("r1", "w1", 5, "bye")).withColumnRenamed("note", "reason"), as_of()).changed)
    assert (got.status, got.attempt, got.worker_id, got.error, got.queued_at) == ("QUEUED", 6, None, "bye", NOW)


@pytest.mark.parametrize("attempt,retries,status", [(1, 1, "QUEUED"), (2, 1, "FAILED"), (1, 0, "FAILED"), (1, 3, "QUEUED")])
def test_fail_or_retry(spark, attempt, retries, status):
    said = reports(spark, ("r1", "w1", attempt, "bad")).withColumnRenamed("note", "error")
    got = row(t.fail_or_retry(runs(spark, running(attempt=attempt)), jobs(spark, dict(max_retries=retries)), said, as_of()).changed)
    assert (got.status, got.error) == (status, "bad")
    if status == "FAILED":
        assert (got.attempt, got.worker_id, got.finished_at, got.next_attempt_at) == (attempt, "w1", NOW, None)
    else:
        assert (got.attempt, got.worker_id, got.finished_at) == (attempt + 1, None, None)
        assert got.next_attempt_at == NOW + dt.timedelta(seconds=5 * 2 ** (attempt - 1))


def test_fail_queued_leaves_claimed_runs_alone(spark):
    said = spark.createDataFrame([("r1", "lost"), ("r2", "lost")], "run_id string, reason string")
    got = row(t.fail_queued(runs(spark, {}, dict(id="r2", **running())), said, as_of()).changed)
    assert (got.id, got.status, got.error, got.finished_at) == ("r1", "FAILED", "lost", NOW)


def test_reap_boundary_null_heartbeat_and_exhaustion(spark):
    table = runs(spark, dict(id="stale", **running(last_heartbeat_at=ago(16))), dict(id="edge", **running(last_heartbeat_at=ago(15))),
                 dict(id="silent", **running(last_heartbeat_at=None)), dict(id="spent", **running(attempt=2, last_heartbeat_at=ago(99))))
    step = t.reap_stale(table, jobs(spark, {}), as_of(), 15)
    got = {r.id: r for r in step.changed.collect()}
    assert set(got) == {"stale", "spent"}
    assert (got["stale"].status, got["stale"].attempt, got["stale"].error) == ("QUEUED", 2, "attempt 1 lost worker w1")
    assert (got["spent"].status, got["spent"].attempt, got["spent"].worker_id) == ("FAILED", 2, "w1")
    assert {r.run_id: r.attempt for r in step.dispatches.collect()} == {"stale": 2, "spent": 2}


def test_reap_takes_the_stalest_first(spark):
    table = runs(spark, *[dict(id=f"r{h}", scheduled_time=ago(h), **running(last_heartbeat_at=ago(h * 3600))) for h in (1, 3, 2)])
    order = []
    for _ in range(3):
        step = t.reap_stale(table, jobs(spark, {}), as_of(), 60, limit=1)
        order.append(row(step.changed).id)
        table = spark.createDataFrame(step.snapshot.collect(), table.schema)
    assert order == ["r3", "r2", "r1"]


def test_sweep_is_strict_and_waits_for_backoff(spark):
    table = runs(spark, dict(id="old", queued_at=ago(61)), dict(id="edge", queued_at=ago(60)),
                 dict(id="backoff", queued_at=ago(99), next_attempt_at=ago(-1)), dict(id="over", queued_at=ago(99), next_attempt_at=ago(0)))
    got = t.sweep_queued(table, jobs(spark, {}), as_of(), 60).changed.collect()
    assert {r.id for r in got} == {"old", "over"} and all(r.queued_at == NOW for r in got)


def test_due_retries_clear_the_backoff(spark):
    table = runs(spark, dict(id="due", next_attempt_at=ago(0)), dict(id="later", next_attempt_at=ago(-1)), dict(id="new"))
    got = row(t.due_retries(table, jobs(spark, {}), as_of()).changed)
    assert (got.id, got.next_attempt_at, got.queued_at) == ("due", None, NOW)


def test_maintenance_dispatches_each_run_once_and_no_failed_one(spark):
    table = runs(spark, dict(id="reaped", **running(last_heartbeat_at=ago(99))), dict(id="failed", **running(attempt=2, last_heartbeat_at=ago(99))),
                 dict(id="retry", queued_at=ago(99), next_attempt_at=ago(1)), dict(id="swept", queued_at=ago(99)), dict(id="fresh", queued_at=ago(1)))
    done = maintenance_pass(table, jobs(spark, {}), as_of())
    assert {r.run_id: (r.source, r.attempt) for r in done.dispatches.collect()} == {
        "reaped": ("reaped", 2), "retry": ("retry", 1), "swept": ("swept", 1)}
    assert {r.id: r.status for r in done.snapshot.collect()}["failed"] == "FAILED"


def test_retry_delay(spark):
    policy = Policy(retry_base=1, retry_cap=5)
    df = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 30)], "a int").select(retry.delay_seconds(F.col("a"), policy).alias("d"))
    assert [r.d for r in df.collect()] == [1, 2, 4, 5, 5]


def test_success_outranks_every_cause(spark):
    df = spark.createDataFrame([(None, "lost"), ("e", "lost"), ("e", "shutdown"), ("e", "timeout"), ("e", "")], "err string, cause string")
    got = df.select(F.inline(F.array(retry.outcome(F.col("err"), F.col("cause"), F.lit(60))))).collect()
    assert [tuple(r) for r in got] == [("success", None), ("lost", None), ("released", None),
                                       ("timeout", "timed out after 60s"), ("error", "e")]


@pytest.mark.parametrize("seed", range(4))
def test_a_limited_pass_equals_its_steps_one_by_one(spark, seed):
    """Stalest first, each step on the result of the one before; also for runs that keep an old backoff while they run."""
    import random
    rng = random.Random(seed)
    table = runs(spark, *[dict(
        id=f"r{i:02}", job_id=rng.choice(["j1", "j1", "gone"]), scheduled_time=ago(i), status=rng.choice(["QUEUED", "RUNNING", "RUNNING", "FAILED"]),
        worker_id="w", attempt=rng.randint(1, 3), queued_at=ago(rng.choice([30, 70, 80, 90])), last_heartbeat_at=rng.choice([None, ago(5), ago(20), ago(40)]),
        next_attempt_at=rng.choice([None, ago(9), ago(3), ago(-9)])) for i in range(60)]).persist()
    for limit in (1, 3, 100):
        got = maintenance_pass(table, jobs(spark, {}), as_of(), limit=limit)
        now, sent = table, {}
        for name, step in (("reaped", t.reap_stale), ("retry", t.due_retries), ("swept", t.sweep_queued)):
            done = step(now, jobs(spark, {}), as_of(), limit=limit)
            sent |= {r.id: (r.status, r.attempt, name) for r in done.changed.collect()}
            now = spark.createDataFrame(done.snapshot.collect(), table.schema)
        assert sorted(map(tuple, got.snapshot.collect())) == sorted(map(tuple, now.collect()))
        assert {r.run_id: (r.status, r.attempt, r.source) for r in got.dispatches.collect()} == {k: x for k, x in sent.items() if x[0] != "FAILED"}
