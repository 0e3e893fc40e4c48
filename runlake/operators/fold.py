"""Replay an ordered event log into current runs.

Events are (run_id, at, tiebreak, kind, worker_id, attempt, message) of kinds
claim, heartbeat, finish, fail, release and fail_queued. An event whose guard
does not hold when its turn comes is counted as rejected and changes nothing.
A NULL worker owns nothing, and a run without a job can't fail.

A run's events are cut in order into chunks of at most ``chunk`` events. Pass k folds
chunk k of every run that has one inside one row, from the state that the pass before
left, so a run of any length is never gathered whole and passes follow its events.
Most runs have one chunk.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from runlake.config import DEFAULT_POLICY, Policy
from runlake.functions.cron import struct
from runlake.operators.lookup import with_job
from runlake.schema import RUNS
from runlake.session import materialize

CHUNK = 50_000
ORDER = ("at", "tiebreak", "kind", "worker_id", "attempt", "message")
# Folded columns; the others of a run never change.
STATE = {c: t for c, t in RUNS.items() if c not in ("id", "job_id", "scheduled_time", "trigger")}


# What an event does to a run, in the order the guards are tried.
CLAIM, HEARTBEAT, FINISH, RELEASE, FINAL, AGAIN, FAIL_QUEUED = range(1, 8)
_OWNED = "s.status = 'RUNNING' AND s.worker_id = e.worker_id AND s.attempt = e.attempt"
_ACTION = f"""CASE e.kind
  WHEN 'claim' THEN IF(s.status = 'QUEUED' AND (s.next_attempt_at IS NULL OR s.next_attempt_at <= e.at), {CLAIM}, 0)
  WHEN 'heartbeat' THEN IF({_OWNED}, {HEARTBEAT}, 0)
  WHEN 'finish' THEN IF({_OWNED}, {FINISH}, 0)
  WHEN 'release' THEN IF({_OWNED}, {RELEASE}, 0)
  WHEN 'fail' THEN IF({_OWNED} AND s.max_retries IS NOT NULL, IF(s.attempt > s.max_retries, {FINAL}, {AGAIN}), 0)
  WHEN 'fail_queued' THEN IF(s.status = 'QUEUED', {FAIL_QUEUED}, 0) ELSE 0 END"""


def _effects(policy: Policy) -> dict[str, str]:
    """Per column, its new value by action ``x``; columns not named keep theirs."""
    delay = (f"least(CAST({policy.retry_base} AS BIGINT) * CAST(pow(2.0D, least(s.attempt - 1, 30)) AS BIGINT), "
             f"CAST({policy.retry_cap} AS BIGINT))")
    backoff = f"e.at + make_dt_interval(0, 0, 0, CAST({delay} AS DECIMAL(18, 6)))"
    requeued = f"x = {RELEASE} OR x = {AGAIN}"
    return {
        "status": f"CASE x WHEN {CLAIM} THEN 'RUNNING' WHEN {FINISH} THEN 'SUCCEEDED' WHEN {RELEASE} THEN 'QUEUED' "
                  f"WHEN {AGAIN} THEN 'QUEUED' WHEN {FINAL} THEN 'FAILED' WHEN {FAIL_QUEUED} THEN 'FAILED' ELSE s.status END",
        "attempt": f"IF({requeued}, s.attempt + 1, s.attempt)",
        "worker_id": f"CASE WHEN x = {CLAIM} THEN e.worker_id WHEN {requeued} THEN NULL ELSE s.worker_id END",
        "queued_at": f"IF({requeued}, e.at, s.queued_at)",
        "started_at": f"CASE WHEN x = {CLAIM} THEN e.at WHEN {requeued} THEN NULL ELSE s.started_at END",
        "finished_at": f"CASE WHEN x = {FINISH} OR x = {FINAL} OR x = {FAIL_QUEUED} THEN e.at "
                       f"WHEN x = {CLAIM} OR x = {AGAIN} THEN NULL ELSE s.finished_at END",
        "last_heartbeat_at": f"CASE WHEN x = {CLAIM} OR x = {HEARTBEAT} THEN e.at WHEN {requeued} THEN NULL "
                             f"ELSE s.last_heartbeat_at END",
        "next_attempt_at": f"CASE WHEN x = {AGAIN} THEN {backoff} WHEN x = {CLAIM} OR x = {FINAL} THEN NULL "
                           f"ELSE s.next_attempt_at END",
        "error": f"CASE WHEN x = {FINISH} THEN NULL WHEN x >= {RELEASE} THEN e.message ELSE s.error END",
        "output": f"IF(x = {FINISH}, e.message, s.output)",
        "max_retries": "s.max_retries",
        "accepted": "s.accepted + 1L",
    }


def advance(policy: Policy) -> str:
    """SQL text of the run ``s`` after the event ``e``; a rejected event leaves the very same struct."""
    return f"transform(array({_ACTION}), x -> IF(x = 0, s, {struct(**_effects(policy))}))[0]"


_ACC = "struct<" + ", ".join(f"{c}:{t}" for c, t in STATE.items()) \
    + ", max_retries:int, accepted:bigint>"


def _initial() -> Column:
    return F.struct(*[F.col(c) for c in STATE], "max_retries", "accepted").cast(_ACC)


def _prepare(events: DataFrame) -> DataFrame:
    for name in ("tiebreak", "message"):
        if name not in events.columns:
            events = events.withColumn(name, F.lit(None).cast("string"))
    return events.select("run_id", *ORDER)


def _in_chunks(events: DataFrame, chunk: int) -> DataFrame:
    """Add ``_chunk``, 0.. along each run. Events are range-partitioned and ranked inside partitions."""
    placed = materialize(events.repartitionByRange("run_id", *ORDER).withColumn("_part", F.spark_partition_id()), "fold-events")
    here = ["run_id", "_part"]
    earlier = Window.partitionBy("run_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy(*here).agg(F.count(F.lit(1)).alias("_n")).select(
        *here, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(*here).orderBy(*ORDER))
    ranked = placed.withColumn("_rank", rank).join(before, here)
    return ranked.withColumn("_chunk", F.floor((F.col("_before") + F.col("_rank") - 1) / chunk)).select("run_id", *ORDER, "_chunk")


def _fold(runs: DataFrame, events: DataFrame, policy: Policy, how: str = "left") -> DataFrame:
    """One pass. ``runs`` carry max_retries, accepted and rejected; with ``how`` inner, only runs with events come back."""
    per_run = (events.groupBy(F.col("run_id").alias("id"))
               .agg(F.array_sort(F.collect_list(F.struct(*ORDER))).alias("_events")))
    df = runs.join(per_run, "id", how).withColumn("_start", _initial())
    # No events, no fold: the run stays as it is.
    df = df.withColumn("_end", F.expr(
        f"IF(_events IS NULL, _start, aggregate(_events, _start, (s, e) -> {advance(policy)}))"))
    gone = F.expr("IF(_events IS NULL, 0, size(_events)) - (_end.accepted - accepted)")
    return df.select(*[F.col(f"_end.{c}").alias(c) if c in STATE else F.col(c) for c in RUNS], "max_retries",
                     "_end.accepted", (F.col("rejected") + gone).alias("rejected"))


def state_fold(runs: DataFrame, jobs: DataFrame, events: DataFrame, policy: Policy = DEFAULT_POLICY,
               chunk: int = CHUNK) -> DataFrame:
    """All runs after their events, with counts of accepted and rejected events.

    Runs without a job stay among them. Events of unknown runs have no row to change; see ``unknown_events``.
    """
    events = _prepare(events)
    zero = F.lit(0).cast("bigint")
    state = with_job(runs, jobs, "left").drop("job_type").withColumn("accepted", zero).withColumn("rejected", zero)
    most = events.groupBy("run_id").count().agg(F.max("count")).first()[0] or 0
    if most <= chunk:
        return _fold(state, events, policy).drop("max_retries")
    # One folder per chunk number: a pass opens its own files only.
    events = materialize(_in_chunks(events, chunk).hint("rebalance", "_chunk"), "fold-chunks", "_chunk")
    long = events.filter("_chunk = 1").select(F.col("run_id").alias("id")).distinct()
    first = materialize(_fold(state, events.filter("_chunk = 0"), policy), "fold-state")
    done, state = [first.join(long, "id", "left_anti")], first.join(long, "id", "left_semi")
    for k in range(1, -(-most // chunk)):
        step = materialize(_fold(state, events.filter(F.col("_chunk") == k), policy, "inner"), "fold-state")
        done.append(state.join(step.select("id"), "id", "left_anti"))
        state = step
    for rest in done:
        state = state.unionByName(rest)
    return state.drop("max_retries")


def unknown_events(runs: DataFrame, events: DataFrame) -> DataFrame:
    """(run_id, n_events) of events whose run isn't known; a NULL run is none."""
    counts = events.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_events"))
    return counts.join(runs.select(F.col("id").alias("run_id")), "run_id", "left_anti")
