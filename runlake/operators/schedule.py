"""Schedules: next fire, fires in a window, due jobs, firing, pausing.

The next fire of many jobs depends only on their distinct (expression, zone)
pairs, so it is computed once per pair and joined back. One pair may be shared
by most jobs, and the pair table is an aggregate of unknown size, so unless it
is known to be small that join is salted: each job takes a random copy of its pair.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from runlake.functions import cron, zones
from runlake.operators.inserts import insert_occurrences
from runlake.operators.keys import overwrite, pinned
from runlake.schema import JOBS

PAIR = ("cron_expr", "timezone")
SALTS = 32


class Fired(NamedTuple):
    runs: DataFrame
    jobs: DataFrame
    dispatches: DataFrame
    errors: DataFrame


def distinct_pairs(jobs: DataFrame) -> DataFrame:
    return jobs.filter(F.col("cron_expr").isNotNull()).select(*PAIR).distinct()


def join_pairs(jobs: DataFrame, pairs: DataFrame, how: str = "left", salts: int = SALTS) -> DataFrame:
    """Join ``pairs`` to ``jobs`` by (cron_expr, timezone), the jobs of one pair spread over ``salts`` keys."""
    copies = pairs.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = jobs.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    return salted.join(copies, [*PAIR, "_salt"], how).drop("_salt")


def parse_pairs(jobs: DataFrame) -> DataFrame:
    """(cron_expr, timezone, cron) of every distinct schedule."""
    return distinct_pairs(jobs).withColumn("cron", F.expr(cron.parse("cron_expr")))


def with_next_run(jobs: DataFrame, after: Column) -> DataFrame:
    """Add ``next_at`` and ``next_error``; both NULL for jobs without a schedule."""
    pairs = (cron.with_next(distinct_pairs(jobs), after)
             .withColumnRenamed("next_run_at", "next_at"))
    return join_pairs(jobs, pairs).select(*jobs.columns, "next_at", "next_error")


def next_run(schedules: DataFrame, after: Column) -> DataFrame:
    """``next_run_at`` and ``next_error`` of each distinct (cron_expr, timezone)."""
    return cron.with_next(distinct_pairs(schedules), after)


def pair_occurrences(schedules: DataFrame, start: Column, end: Column) -> DataFrame:
    """(cron_expr, timezone, fires): arrays of the fires in [start, end), one row per local day.

    ``@every`` counts its steps from ``start``. Bad schedules have no fires.
    """
    df = pinned(parse_pairs(schedules), ["cron"]).filter(F.expr(f"cron.error IS NULL AND {zones.is_known('timezone')}"))
    df = df.select(*PAIR, "cron", F.coalesce("cron.zone", "timezone").alias("_tz"),
                   start.alias("_start"), end.alias("_end"))
    inside = "c -> c * 1000000 >= unix_micros(_start) AND c * 1000000 < unix_micros(_end)"
    days = F.expr("sequence(to_date(from_utc_timestamp(_start, _tz)), to_date(from_utc_timestamp(_end, _tz)))")
    by_clock = (df.filter("cron.every_sec IS NULL").withColumn("_day", F.explode(days))
                .withColumn("fires", F.expr(f"filter(IF({cron.day_matches('_day', 'cron')}, "
                            f"{cron.fires_on('_day', cron.minutes_of_day('cron'), '_tz')}, array()), {inside})")))
    # Steps are listed a day at a time, so a short step over a long window is no giant array.
    slices = F.expr(f"sequence(0L, greatest(0L, unix_seconds(_end) - unix_seconds(_start)), {cron.DAY}L)")
    by_step = (df.filter("cron.every_sec IS NOT NULL").withColumn("_from", F.explode(slices))
               .withColumn("fires", F.expr(f"""filter(transform(
                   sequence(_from div cron.every_sec, (_from + {cron.DAY} - 1) div cron.every_sec),
                   k -> IF(k > 0 AND k * cron.every_sec >= _from, unix_seconds(_start) + k * cron.every_sec, NULL)), {inside})""")))
    keep = [*PAIR, "fires"]
    return by_clock.select(*keep).unionByName(by_step.select(*keep))


def occurrences(jobs: DataFrame, start: Column, end: Column) -> DataFrame:
    """(job_id, scheduled_time) of every fire in [start, end)."""
    scheduled = jobs.filter(F.col("cron_expr").isNotNull()).select("id", *PAIR)
    return (join_pairs(scheduled, pair_occurrences(jobs, start, end), "inner")
            .select(F.col("id").alias("job_id"), F.explode("fires").alias("_at"))
            .select("job_id", F.timestamp_seconds("_at").alias("scheduled_time")))


def is_due(as_of: Column) -> Column:
    return F.col("enabled") & F.col("cron_expr").isNotNull() & (F.col("next_run_at") <= as_of)


def due_jobs(jobs: DataFrame, as_of: Column, limit: int | None = None) -> DataFrame:
    """(id, type, cron_expr, timezone, next_run_at) of due jobs; the longest due under a limit."""
    due = jobs.filter(is_due(as_of)).select("id", "type", "cron_expr", "timezone", "next_run_at")
    return due if limit is None else due.orderBy("next_run_at", "id").limit(limit)


def fire_due_jobs(jobs: DataFrame, runs: DataFrame, as_of: Column) -> Fired:
    """Queue a run for each due job and move its schedule past ``as_of``.

    The run stands for the stored occurrence. An occurrence already queued adds
    nothing, but the schedule still moves on; missed ones are not replayed. A
    schedule without a next fire is cleared and reported.
    """
    due = jobs.filter(is_due(as_of))
    queued = insert_occurrences(
        runs, due.select(F.col("id").alias("job_id"), F.col("next_run_at").alias("scheduled_time")), as_of)
    types = due.select(F.col("id").alias("job_id"), F.col("type").alias("job_type"))
    dispatches = (queued.join(types, "job_id")
                  .select(F.col("id").alias("run_id"), "job_id", "job_type", "status", "attempt"))
    moved = with_next_run(due, as_of)
    advanced = moved.select(
        *[{"next_run_at": F.col("next_at"), "updated_at": as_of}.get(c, F.col(c)).alias(c) for c in JOBS])
    idle = jobs.filter(~F.coalesce(is_due(as_of), F.lit(False))).select(*JOBS)
    errors = moved.filter(F.col("next_error").isNotNull()).select(
        F.col("id").alias("job_id"), F.col("next_error").alias("error"))
    return Fired(runs.unionByName(queued), idle.unionByName(advanced), dispatches, errors)


def pause_resume(jobs: DataFrame, requests: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """Apply (job_id, enabled) requests, one per job. Returns (jobs, errors).

    Pausing clears the next run. Resuming schedules the first fire after
    ``as_of``; if there is none the job stays as it was and is reported.
    """
    asked = requests.select(F.col("job_id").alias("id"), F.col("enabled").alias("_enabled"))
    touched = with_next_run(jobs.join(asked, "id"), as_of)
    failed = F.col("_enabled") & F.col("next_error").isNotNull()
    changed = overwrite(touched, ~failed, {
        "enabled": F.col("_enabled"), "next_run_at": F.when(F.col("_enabled"), F.col("next_at")),
        "updated_at": as_of}).select(*JOBS)
    errors = touched.filter(failed).select(
        F.col("id").alias("job_id"), F.concat(F.lit("compute next run: "), "next_error").alias("error"))
    return jobs.join(asked, "id", "left_anti").select(*JOBS).unionByName(changed), errors
