"""Checks of table constraints."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from runlake.operators.keys import count_per_key
from runlake.schema import LEVELS, LOG_KEY, OCCURRENCE_KEY, STATUSES, TRIGGERS


def _violations(df: DataFrame, rules: dict[str, Column], key: Column) -> DataFrame:
    """(rule, key) rows from one scan: a row broken in two ways appears twice."""
    broken = F.filter(F.array(*[F.when(~ok, F.lit(rule)) for rule, ok in rules.items()]), lambda r: r.isNotNull())
    return df.select(F.explode(broken).alias("rule"), key.alias("key"))


def check_audit(jobs: DataFrame, runs: DataFrame, logs: DataFrame) -> DataFrame:
    """Rows whose values break a column rule. NULL breaks none."""
    by_id = F.col("id").cast("string")
    return reduce(DataFrame.unionByName, [
        _violations(jobs, {"jobs.max_retries": F.col("max_retries") >= 0,
                           "jobs.timeout_sec": F.col("timeout_sec") > 0}, by_id),
        _violations(runs, {"job_runs.trigger": F.col("trigger").isin(*TRIGGERS),
                           "job_runs.status": F.col("status").isin(*STATUSES),
                           "job_runs.attempt": F.col("attempt") >= 1}, by_id),
        _violations(logs, {"job_logs.level": F.col("level").isin(*LEVELS)},
                    F.concat_ws("/", *[F.col(k).cast("string") for k in LOG_KEY]))])


def unique_audit(runs: DataFrame, logs: DataFrame) -> DataFrame:
    """(rule, key, copies) of keys stored more than once."""
    def repeated(df: DataFrame, rule: str, keys, key: Column) -> DataFrame:
        return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
                .select(F.lit(rule).alias("rule"), key.alias("key"), "copies"))

    occurrence = F.concat_ws("/", F.col("job_id").cast("string"),
                             F.date_format("scheduled_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    line = F.concat_ws("/", *[F.col(k).cast("string") for k in LOG_KEY])
    return repeated(runs, "job_runs.occurrence", OCCURRENCE_KEY, occurrence).unionByName(
        repeated(logs, "job_logs.line", LOG_KEY, line))


def fk_audit(jobs: DataFrame, runs: DataFrame, logs: DataFrame) -> DataFrame:
    """(rule, key, orphans): referenced keys that do not exist, and how many rows point at them.

    References are counted per key before the join, so a hot key is one row by then.
    """
    def orphans(children: DataFrame, ref: str, parents: DataFrame, rule: str) -> DataFrame:
        refs = children.groupBy(F.col(ref).alias("id")).agg(F.count(F.lit(1)).alias("orphans"))
        return (refs.join(parents.select("id"), "id", "left_anti")
                .select(F.lit(rule).alias("rule"), F.col("id").cast("string").alias("key"), "orphans"))

    return orphans(runs, "job_id", jobs, "job_runs.job_id").unionByName(
        orphans(logs, "run_id", runs, "job_logs.run_id"))


def child_counts(jobs: DataFrame, runs: DataFrame, logs: DataFrame) -> DataFrame:
    """(parent, id, children): runs of every job and log lines of every run."""
    return (count_per_key(jobs, runs, "id", "job_id", "children").select(F.lit("job").alias("parent"), "id", "children")
            .unionByName(count_per_key(runs, logs, "id", "run_id", "children")
                         .select(F.lit("run").alias("parent"), "id", "children")))
