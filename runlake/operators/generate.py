"""What a ``generate_text`` run produces: lines, output, progress log, outcome, timeline.

All are row-local. The ones that fan out first spread the still narrow rows, so
that runs with long outputs lying in one file do not end up in one task.
"""

from pyspark.sql import Column, DataFrame, functions as F

from runlake.config import DEFAULT_POLICY, Policy
from runlake.functions import payload, retry
from runlake.schema import FAILED, SUCCEEDED


def with_run_payload(runs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Runs with their job's typed payload, limits and ``payload_error``.

    A payload is parsed once per job, before the join.
    """
    parsed = payload.with_payload(jobs.select(
        F.col("id").alias("job_id"), "type", "payload", "max_retries", "timeout_sec")).drop("payload")
    return runs.join(parsed.withColumnRenamed("type", "job_type"), "job_id")


def _spread(runs: DataFrame) -> DataFrame:
    """Valid runs, narrow and spread by id: a run of 100,000 lines is one small row until here."""
    return (runs.filter(F.col("payload_error").isNull())
            .select(F.col("id").alias("run_id"), "attempt", "lines", "prefix", "fail_at", "fail_attempts")
            .repartition("run_id"))


def _text(i: Column) -> Column:
    return F.concat(F.col("prefix"), F.lit(" "), i.cast("string"))


def generate_lines(runs: DataFrame) -> DataFrame:
    """(run_id, i, line) for runs with a valid payload."""
    return (_spread(runs).select("run_id", "prefix", F.explode(F.sequence(F.lit(1), "lines")).alias("i"))
            .select("run_id", "i", _text(F.col("i")).alias("line")))


def generate_output(runs: DataFrame) -> DataFrame:
    """(run_id, output): the lines as one text, each ended by a newline."""
    # One join of the numbers with the text between them, rather than a join of built lines.
    numbers = F.sequence(F.lit(1), "lines").cast("array<string>")
    between = F.expr("concat('\\n', prefix, ' ')")
    return _spread(runs).select("run_id", F.concat(
        F.col("prefix"), F.lit(" "), F.call_function("array_join", numbers, between), F.lit("\n")).alias("output"))


def progress_log(runs: DataFrame) -> DataFrame:
    """(run_id, attempt, seq, level, line) that executing each run's attempt writes."""
    df = _spread(runs).withColumn("every", F.expr("greatest(1, lines div 20)").cast("int"))
    # Lines written before the end, and the progress marks among them: multiples of ``every`` and the last line.
    df = df.withColumn("reached", F.expr("IF(fail_at > 0, fail_at - 1, lines)"))
    df = df.withColumn("marks", F.expr(
        "CAST(reached div every AS INT) + IF(reached = lines AND lines % every != 0, 1, 0)"))
    df = df.withColumn("fails", F.expr("fail_at > 0 OR attempt <= fail_attempts"))
    df = df.withColumn("seq", F.explode(F.expr("sequence(1, 1 + marks + IF(fails, 1, 0))")))
    line = F.expr("""CASE WHEN seq = 1 THEN concat('generating ', lines, ' lines')
        WHEN seq <= 1 + marks THEN concat('wrote ', least((seq - 1) * every, lines), '/', lines, ' lines')
        WHEN fail_at > 0 THEN concat('failing on purpose after ', fail_at, ' lines')
        ELSE concat('failing attempt ', attempt, ' on purpose (fail_attempts=', fail_attempts, ')') END""")
    return df.select("run_id", "attempt", F.col("seq").cast("bigint").alias("seq"),
                     F.expr("IF(seq > 1 + marks, 'error', 'info')").alias("level"), line.alias("line"))


def expected_outcome(runs: DataFrame) -> DataFrame:
    """(run_id, attempt, succeeds, error) for each run's current attempt."""
    return (runs.withColumn("error", payload.expected_error(F.col("attempt")))
            .select(F.col("id").alias("run_id"), "attempt", F.col("error").isNull().alias("succeeds"), "error"))


def attempt_timeline(runs: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Every attempt a run needs: its outcome, the backoff before it and the waiting so far.

    Attempts go from 1 to the first success or the last allowed one; the closing
    row carries the run's final status.
    """
    allowed = F.col("max_retries") + 1
    never = F.col("payload_error").isNotNull() | (F.col("fail_at") > 0)
    needed = F.when(never, allowed).otherwise(F.least(allowed, F.col("fail_attempts") + 1))
    attempt = F.col("attempt")
    delay = lambda a: retry.delay_seconds(a, policy)
    waited = F.aggregate(F.filter(F.sequence(F.lit(1), F.col("_needed")), lambda a: a < attempt),
                         F.lit(0), lambda acc, a: acc + delay(a))
    df = (runs.withColumn("_needed", needed).drop("attempt", "error", "status")
          .withColumn("attempt", F.explode(F.sequence(F.lit(1), "_needed"))))
    df = df.withColumn("error", payload.expected_error(attempt))
    ended = F.when(F.col("error").isNull(), F.lit(SUCCEEDED)).otherwise(F.lit(FAILED))
    return df.select(
        F.col("id").alias("run_id"), "attempt", F.col("error").isNull().alias("succeeds"), "error",
        F.when(attempt == 1, F.lit(0)).otherwise(delay(attempt - 1)).alias("backoff_sec"),
        waited.alias("waited_sec"),
        F.when(attempt == F.col("_needed"), ended).otherwise(F.lit("QUEUED")).alias("status_after"))
