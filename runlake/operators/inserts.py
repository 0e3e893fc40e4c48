"""Inserts guarded by keys, and deletes that follow foreign keys."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from runlake import config
from runlake.functions.ids import occurrence_id
from runlake.operators.keys import absent_from, first_per_key
from runlake.schema import JOBS, OCCURRENCE_KEY, QUEUED, RUNS


class ManualRuns(NamedTuple):
    queued: DataFrame
    rejected: DataFrame


class Cascade(NamedTuple):
    jobs: DataFrame
    runs: DataFrame
    logs: DataFrame


def new_run_rows(occurrences: DataFrame, trigger: str | Column, as_of: Column, id_kind: str) -> DataFrame:
    """Freshly queued rows for (job_id, scheduled_time) pairs."""
    kind = F.lit(trigger) if isinstance(trigger, str) else trigger
    values = {
        "id": occurrence_id(F.col("job_id"), F.col("scheduled_time"), id_kind),
        "job_id": F.col("job_id"), "scheduled_time": F.col("scheduled_time"),
        "trigger": kind, "status": F.lit(QUEUED), "attempt": F.lit(1), "queued_at": as_of,
    }
    return occurrences.select(*[
        values.get(name, F.lit(None)).cast(dict(occurrences.dtypes)["job_id"] if name == "job_id"
                                           else id_kind if name == "id" else sql_type).alias(name)
        for name, sql_type in RUNS.items()])


def insert_occurrences(runs: DataFrame, occurrences: DataFrame, as_of: Column,
                       trigger: str = "schedule") -> DataFrame:
    """The runs to add: one per distinct (job_id, scheduled_time) not stored yet."""
    distinct = occurrences.select(*OCCURRENCE_KEY).distinct()
    fresh = absent_from(distinct, runs, OCCURRENCE_KEY)
    return new_run_rows(fresh, trigger, as_of, dict(runs.dtypes)["id"])


def insert_manual(runs: DataFrame, jobs: DataFrame, calls: DataFrame) -> ManualRuns:
    """Queue a run per call (job_id, called_at) of an existing job; other calls are rejected.

    A second call of one job at the same instant meets the unique key and adds nothing.
    """
    ids = jobs.select(F.col("id").alias("job_id"))
    known = calls.join(ids, "job_id", "left_semi")
    wanted = known.select("job_id", F.col("called_at").alias("scheduled_time")).distinct()
    queued = new_run_rows(absent_from(wanted, runs, OCCURRENCE_KEY), "manual",
                          F.col("scheduled_time"), dict(runs.dtypes)["id"])
    return ManualRuns(queued, calls.join(ids, "job_id", "left_anti"))


def create_jobs(valid: DataFrame, as_of: Column) -> DataFrame:
    """Job rows from accepted requests, absent settings filled with their defaults."""
    return valid.select(*[
        {"timezone": F.coalesce("timezone", F.lit("UTC")),
         "enabled": F.lit(True),
         "max_retries": F.coalesce("max_retries", F.lit(config.DEFAULT_MAX_RETRIES)),
         "timeout_sec": F.coalesce("timeout_sec", F.lit(config.DEFAULT_TIMEOUT_SEC)),
         "created_at": as_of, "updated_at": as_of}.get(name, F.col(name)).alias(name)
        for name in JOBS])


def cascade_delete(jobs: DataFrame, runs: DataFrame, logs: DataFrame, doomed: DataFrame) -> Cascade:
    """Remove the jobs whose ``id`` is in ``doomed``, their runs and those runs' logs.

    Only keys of what goes away are carried along, not what stays.
    """
    doomed = doomed.select("id").distinct()
    gone_runs = runs.join(doomed.withColumnRenamed("id", "job_id"), "job_id", "left_semi").select("id")
    return Cascade(
        jobs.join(doomed, "id", "left_anti").select(*jobs.columns),
        runs.join(doomed.withColumnRenamed("id", "job_id"), "job_id", "left_anti").select(*runs.columns),
        logs.join(gone_runs.withColumnRenamed("id", "run_id"), "run_id", "left_anti").select(*logs.columns))


def first_occurrences(runs: DataFrame) -> DataFrame:
    """Runs with surplus copies of an occurrence removed (lowest id kept)."""
    return first_per_key(runs, OCCURRENCE_KEY, ("id",))
