"""Run state transitions over whole tables.

Each operator marks the rows it changes and computes their new values in place,
in one pass over the runs. A ``Transition`` then offers three views of that one
plan: the next snapshot, only the changed rows, and what must be dispatched.
For the last two Spark pushes the guard down to the scan, so terminal runs are
not read at all where the table is laid out by status.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from runlake.config import DEFAULT_POLICY, Policy
from runlake.functions import retry
from runlake.operators.keys import first_per_key, overwrite
from runlake.operators.lookup import with_job
from runlake.schema import FAILED, QUEUED, RUNNING, RUNS, SUCCEEDED


def null() -> Column:
    return F.lit(None)


@dataclass(frozen=True)
class Transition:
    """``marked`` holds every run after the step, and ``_hit`` on the runs it changed."""

    marked: DataFrame

    @property
    def snapshot(self) -> DataFrame:
        return self.marked.select(*RUNS)

    @property
    def changed(self) -> DataFrame:
        return self.marked.filter("_hit").select(*RUNS)

    @property
    def dispatches(self) -> DataFrame:
        """(run_id, job_id, job_type, status, attempt) of changed runs; needs a step that joins jobs."""
        return self.marked.filter("_hit").select(
            F.col("id").alias("run_id"), "job_id", "job_type", "status", "attempt")


def seconds(n: int) -> Column:
    return F.make_dt_interval(secs=F.lit(n))


def _mark(df: DataFrame, hit: Column, values: dict[str, Column]) -> Transition:
    # The guard must see the old row, so it becomes a column before any change.
    return Transition(overwrite(df.withColumn("_hit", hit), F.col("_hit"), values))


def _pick(df: DataFrame, guard: Column, order: str, limit: int | None) -> tuple[DataFrame, Column]:
    """The guard itself or, with a limit, membership in the first ``limit`` rows by ``order``, id."""
    if limit is None:
        return df, guard
    picked = (df.filter(guard).orderBy(order, "id").limit(limit)
              .select("id", F.lit(True).alias("_picked")))
    return df.join(picked, "id", "left"), F.col("_picked")


def requeue_values(as_of: Column) -> dict[str, Column]:
    """What every return to the queue sets, whatever its cause."""
    return {"status": F.lit(QUEUED), "attempt": F.col("attempt") + 1, "worker_id": null(),
            "queued_at": as_of, "started_at": null(), "last_heartbeat_at": null()}


def _by_exhaustion(exhausted: Column, as_of: Column) -> dict[str, Column]:
    """Final failure where the retries are used up, otherwise back to the queue."""
    retried = requeue_values(as_of) | {"finished_at": null()}
    final = {"status": F.lit(FAILED), "finished_at": as_of}
    return {c: F.when(exhausted, final.get(c, F.col(c))).otherwise(v) for c, v in retried.items()}


def _exhausted() -> Column:
    return F.col("attempt") > F.col("max_retries")


def _backoff_over(as_of: Column) -> Column:
    return F.col("next_attempt_at").isNull() | (F.col("next_attempt_at") <= as_of)


# Requests --------------------------------------------------------------------

def _with_reports(runs: DataFrame, reports: DataFrame, order) -> DataFrame:
    """Runs joined to the first report of their current owner, as ``_report``.

    A report counts only if its worker and attempt still own the run.
    """
    owner = ["run_id", "worker_id", "attempt"]
    extra = [c for c in reports.columns if c not in owner]
    first = first_per_key(reports, owner, order).select(
        F.col("run_id").alias("id"), "worker_id", "attempt", F.struct(F.lit(True).alias("seen"), *extra).alias("_report"))
    return runs.join(first, ["id", "worker_id", "attempt"], "left").select(*runs.columns, "_report")


def _owned() -> Column:
    return (F.col("status") == RUNNING) & F.col("_report").isNotNull()


def lost_reports(runs: DataFrame, reports: DataFrame) -> DataFrame:
    """Reports whose sender does not own the run's current attempt; the sender must stop."""
    owners = runs.filter(F.col("status") == RUNNING).select(F.col("id").alias("run_id"), "worker_id", "attempt")
    return reports.join(owners, ["run_id", "worker_id", "attempt"], "left_anti")


def claim(runs: DataFrame, requests: DataFrame, as_of: Column, order=("arrived_at", "offset_no")) -> Transition:
    """Give each claimable run to its first request (run_id, worker_id, plus ``order``)."""
    winner = (requests.groupBy(F.col("run_id").alias("id"))
              .agg(F.min(F.struct(*order, "worker_id")).alias("_winner")))
    df = runs.join(winner, "id", "left").select(*runs.columns, F.col("_winner.worker_id").alias("_claimant"))
    guard = (F.col("status") == QUEUED) & _backoff_over(as_of) & F.col("_claimant").isNotNull()
    return _mark(df, guard, {
        "status": F.lit(RUNNING), "worker_id": F.col("_claimant"), "started_at": as_of,
        "last_heartbeat_at": as_of, "finished_at": null(), "next_attempt_at": null()})


def heartbeat(runs: DataFrame, reports: DataFrame, as_of: Column, order=()) -> Transition:
    return _mark(_with_reports(runs, reports, order), _owned(), {"last_heartbeat_at": as_of})


def finish(runs: DataFrame, reports: DataFrame, as_of: Column, order=("output",)) -> Transition:
    """Record success; ``reports`` carry the ``output``."""
    return _mark(_with_reports(runs, reports, order), _owned(), {
        "status": F.lit(SUCCEEDED), "output": F.col("_report.output"), "error": null(), "finished_at": as_of})


def release(runs: DataFrame, reports: DataFrame, as_of: Column, order=("reason",)) -> Transition:
    """Hand an attempt back to the queue, whatever the retry limit says."""
    return _mark(_with_reports(runs, reports, order), _owned(),
                 requeue_values(as_of) | {"error": F.col("_report.reason")})


def fail_or_retry(runs: DataFrame, jobs: DataFrame, reports: DataFrame, as_of: Column,
                  policy: Policy = DEFAULT_POLICY, order=("error",)) -> Transition:
    """Record a failed attempt: retry after a backoff, or fail for good."""
    df = with_job(_with_reports(runs, reports, order), jobs, "left")
    after = retry.plus_seconds(as_of, retry.delay_seconds(F.col("attempt"), policy))
    return _mark(df, _owned() & F.col("max_retries").isNotNull(), _by_exhaustion(_exhausted(), as_of) | {
        "next_attempt_at": F.when(_exhausted(), null()).otherwise(after), "error": F.col("_report.error")})


def fail_queued(runs: DataFrame, reports: DataFrame, as_of: Column, order=("reason",)) -> Transition:
    """Fail runs that never reached a worker; claimed ones are left alone."""
    first = first_per_key(reports.select("run_id", "reason"), ("run_id",), order)
    df = runs.join(first.select(F.col("run_id").alias("id"), F.struct("reason").alias("_report")), "id", "left") \
        .select(*runs.columns, "_report")
    return _mark(df, (F.col("status") == QUEUED) & F.col("_report").isNotNull(),
                 {"status": F.lit(FAILED), "error": F.col("_report.reason"), "finished_at": as_of})


# Maintenance -----------------------------------------------------------------
# These take runs already joined to their jobs (``with_job(..., "left")``), so a
# pass over all three reads and joins once. A run without a job never matches.

def _has_job() -> Column:
    return F.col("job_type").isNotNull()


def is_stale(as_of: Column, stale_after: int) -> Column:
    return (F.col("status") == RUNNING) & (F.col("last_heartbeat_at") < as_of - seconds(stale_after)) & _has_job()


def is_due(as_of: Column) -> Column:
    return (F.col("status") == QUEUED) & (F.col("next_attempt_at") <= as_of) & _has_job()


def is_overdue(as_of: Column, older_than: int) -> Column:
    return (F.col("status") == QUEUED) & (F.col("queued_at") < as_of - seconds(older_than)) & _backoff_over(as_of) & _has_job()


def reap_step(df: DataFrame, as_of: Column, stale_after: int, limit: int | None = None, hit: Column | None = None) -> Transition:
    """``hit`` marks rows that were picked already; otherwise the guard and ``limit`` decide, here and below."""
    if hit is None:
        df, hit = _pick(df, is_stale(as_of, stale_after), "last_heartbeat_at", limit)
    lost = F.concat(F.lit("attempt "), F.col("attempt").cast("string"), F.lit(" lost worker "),
                    F.coalesce("worker_id", F.lit("")))
    return _mark(df, hit, _by_exhaustion(_exhausted(), as_of) | {"error": lost})


def retry_step(df: DataFrame, as_of: Column, limit: int | None = None, hit: Column | None = None) -> Transition:
    if hit is None:
        df, hit = _pick(df, is_due(as_of), "next_attempt_at", limit)
    return _mark(df, hit, {"next_attempt_at": null(), "queued_at": as_of})


def sweep_step(df: DataFrame, as_of: Column, older_than: int, limit: int | None = None, hit: Column | None = None) -> Transition:
    if hit is None:
        df, hit = _pick(df, is_overdue(as_of, older_than), "queued_at", limit)
    return _mark(df, hit, {"queued_at": as_of})


def reap_stale(runs: DataFrame, jobs: DataFrame, as_of: Column,
               stale_after: int = DEFAULT_POLICY.stale_after, limit: int | None = None) -> Transition:
    """Requeue, or fail, runs whose worker stopped sending heartbeats; stalest first under a limit."""
    return reap_step(with_job(runs, jobs, "left"), as_of, stale_after, limit)


def sweep_queued(runs: DataFrame, jobs: DataFrame, as_of: Column,
                 older_than: int = DEFAULT_POLICY.sweep_after, limit: int | None = None) -> Transition:
    """Dispatch again the runs left queued too long."""
    return sweep_step(with_job(runs, jobs, "left"), as_of, older_than, limit)


def due_retries(runs: DataFrame, jobs: DataFrame, as_of: Column, limit: int | None = None) -> Transition:
    """Dispatch the retries whose backoff is over."""
    return retry_step(with_job(runs, jobs, "left"), as_of, limit)
