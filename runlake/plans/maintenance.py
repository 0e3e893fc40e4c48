"""One maintenance pass: reap, dispatch due retries, sweep."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from runlake.config import DEFAULT_POLICY, Policy
from runlake.operators.lookup import with_job
from runlake.operators.transitions import is_due, is_overdue, is_stale, reap_step, retry_step, sweep_step
from runlake.schema import FAILED, QUEUED, RUNNING, RUNS


class Pass(NamedTuple):
    snapshot: DataFrame
    dispatches: DataFrame


REAP, RETRY, SWEEP = 1, 2, 3


def picks(runs: DataFrame, as_of: Column, policy: Policy, limit: int) -> DataFrame:
    """(id, _reap, _retry, _sweep): what each step of a pass under ``limit`` takes, from one scan.

    Every candidate of a step is a row (step, order, id). The first ones of each step are kept, limited per task before the
    shuffle: twice ``limit`` at most, as the step before takes at most ``limit`` of them away. The picks then
    follow within one row of that bounded size, in the order of the steps.
    """
    requeued = F.col("attempt") <= F.col("max_retries")
    steps = [(REAP, is_stale(as_of, policy.stale_after), "last_heartbeat_at"), (RETRY, is_due(as_of), "next_attempt_at"),
             (SWEEP, is_overdue(as_of, policy.sweep_after), "queued_at")]
    # What a reaped run would be due by, should it return to the queue with a backoff that is over.
    then = F.when(requeued & (F.col("next_attempt_at") <= as_of), F.col("next_attempt_at"))
    found = runs.select("id", then.alias("_then"), F.inline(F.array(*[
        F.struct(F.lit(n).alias("_step"), F.when(guard, F.col(order)).alias("_at")) for n, guard, order in steps]))).filter("_at IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy("_step").orderBy("_at", "id"))
    first = found.withColumn("_rank", rank).filter(F.col("_rank") <= 2 * limit)
    rows = first.groupBy().agg(F.array_sort(F.collect_list(F.struct("_at", "id", "_step", "_then"))).alias("_all"))

    def of(step: int) -> Column:
        return F.filter("_all", lambda x: x["_step"] == step)

    def named(rows: Column, step: int) -> Column:
        return F.transform(rows, lambda x: F.struct(x["id"].alias("id"), F.lit(step).alias("_step")))
    rows = rows.withColumn("_reap", F.slice(of(REAP), 1, limit))
    again = F.transform(F.filter("_reap", lambda x: x["_then"].isNotNull()), lambda x: F.struct(
        x["_then"].alias("_at"), x["id"].alias("id"), F.lit(RETRY).alias("_step"), x["_then"].alias("_then")))
    rows = rows.withColumn("_retry", F.slice(F.array_sort(F.concat(of(RETRY), again)), 1, limit))
    left = F.filter(of(SWEEP), lambda x: ~F.array_contains(F.transform("_retry", lambda y: y["id"]), x["id"]))
    rows = rows.select(F.inline(F.concat(named(F.col("_reap"), REAP), named(F.col("_retry"), RETRY), named(F.slice(left, 1, limit), SWEEP))))
    return rows.groupBy("id").agg(*[F.max(F.col("_step") == n).alias(name) for n, name in ((REAP, "_reap"), (RETRY, "_retry"), (SWEEP, "_sweep"))])


def maintenance_pass(runs: DataFrame, jobs: DataFrame, as_of: Column,
                     policy: Policy = DEFAULT_POLICY, limit: int | None = None) -> Pass:
    """Each step works on the result of the one before; failed runs are not dispatched.

    A step that requeues a run also refreshes ``queued_at``, so the steps after it
    pass the run over: a run has at most one source, and the three steps need one
    join with ``jobs`` and one pass over the runs.

    With ``limit`` each step takes its first ``limit`` runs, the stalest first.
    """
    def steps(df: DataFrame) -> DataFrame:
        df = with_job(df, jobs, "left")
        hits = dict.fromkeys(("_reap", "_retry", "_sweep"))
        if limit is not None:
            df = df.join(picks(df, as_of, policy, limit), "id", "left")
            hits = {name: F.coalesce(name, F.lit(False)) for name in hits}
        df = df.withColumn("source", F.lit(None).cast("string"))
        for name, step in (("reaped", lambda d: reap_step(d, as_of, policy.stale_after, hit=hits["_reap"])),
                           ("retry", lambda d: retry_step(d, as_of, hit=hits["_retry"])),
                           ("swept", lambda d: sweep_step(d, as_of, policy.sweep_after, hit=hits["_sweep"]))):
            df = step(df).marked
            df = df.withColumn("source", F.when(F.col("_hit"), F.lit(name)).otherwise(F.col("source"))).drop("_hit")
        return df

    # Only open runs can change; finished ones are neither joined nor shuffled.
    is_open = F.coalesce(F.col("status").isin(QUEUED, RUNNING), F.lit(False))
    after = steps(runs.filter(F.col("status").isin(QUEUED, RUNNING)))
    sent = (after.filter(F.col("source").isNotNull() & (F.col("status") != FAILED)))
    return Pass(after.select(*RUNS).unionByName(runs.filter(~is_open).select(*RUNS)), sent.select(
        F.col("id").alias("run_id"), "job_id", "job_type", "status", "attempt", "source"))
