"""Point lookups, lists, log pages and run details."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from runlake import config
from runlake.schema import FINAL_STATUSES


def check_limit(limit: int, high: int) -> int:
    if not 1 <= limit <= high:
        raise ValueError(f"limit must be between 1 and {high}")
    return limit


def is_final(status: Column) -> Column:
    return status.isin(*FINAL_STATUSES)


def get(table: DataFrame, row_id) -> DataFrame:
    """The row with this id; no row means not found."""
    return table.filter(F.col("id") == F.lit(row_id))


def get_many(table: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per distinct requested id: the row found, and ``found``.

    ``ids`` is one column named ``id``.
    """
    wanted = ids.distinct()
    return wanted.join(table.withColumn("found", F.lit(True)), "id", "left") \
        .withColumn("found", F.coalesce("found", F.lit(False)))


def list_jobs(jobs: DataFrame, limit: int = config.LIST_LIMIT) -> DataFrame:
    check_limit(limit, config.LIST_LIMIT_MAX)
    return jobs.orderBy(F.desc("created_at"), "id").limit(limit)


def list_runs(runs: DataFrame, job_id=None, limit: int = config.LIST_LIMIT) -> DataFrame:
    """Newest occurrences first, without the output text."""
    check_limit(limit, config.LIST_LIMIT_MAX)
    if job_id is not None:
        runs = runs.filter(F.col("job_id") == F.lit(job_id))
    return (runs.withColumn("output", F.lit(None).cast("string"))
            .orderBy(F.desc("scheduled_time"), "id").limit(limit))


def list_runs_per_job(runs: DataFrame, limit: int = config.LIST_LIMIT) -> DataFrame:
    """``list_runs`` for every job at once, with ``rank`` 1 for the newest.

    Spark drops rows ranked below the limit before the shuffle, so a job owning
    most runs sends at most ``limit`` rows per map task.
    """
    check_limit(limit, config.LIST_LIMIT_MAX)
    newest = Window.partitionBy("job_id").orderBy(F.desc("scheduled_time"), "id")
    return (runs.withColumn("output", F.lit(None).cast("string"))
            .withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= limit))


def log_page(logs: DataFrame, run_id, attempt: int, from_seq: int = 1,
             limit: int = config.LOG_PAGE_LIMIT) -> DataFrame:
    """One page of one attempt's lines, in order."""
    check_limit(limit, config.LOG_PAGE_LIMIT_MAX)
    return (logs.filter((F.col("run_id") == F.lit(run_id)) & (F.col("attempt") == attempt)
                        & (F.col("seq") >= from_seq))
            .orderBy("seq").limit(limit))


def log_pages(logs: DataFrame, requests: DataFrame, limit: int = config.LOG_PAGE_LIMIT) -> DataFrame:
    """A page for each request (run_id, attempt, from_seq); requests are distinct.

    As with ``list_runs_per_job``, each map task keeps at most ``limit`` lines of a request.
    """
    check_limit(limit, config.LOG_PAGE_LIMIT_MAX)
    wanted = logs.join(requests, ["run_id", "attempt"]).filter(F.col("seq") >= F.col("from_seq"))
    order = Window.partitionBy("run_id", "attempt", "from_seq").orderBy("seq")
    return wanted.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= limit)


def log_page_cursors(logs: DataFrame, runs: DataFrame, requests: DataFrame,
                     limit: int = config.LOG_PAGE_LIMIT) -> DataFrame:
    """Pages with their run's status and the sequence number to continue from.

    ``requests``: run_id, attempt (NULL for the current one), from_seq. A request
    for an unknown run or an attempt the run has not reached gives no row.
    """
    known = runs.select(F.col("id").alias("run_id"), "status", F.col("attempt").alias("_current"))
    asked = (requests.join(known, "run_id")
             .withColumn("attempt", F.coalesce("attempt", "_current"))
             .filter(F.col("attempt").between(1, F.col("_current")) & (F.col("from_seq") >= 1))
             .drop("_current"))
    item = F.struct("seq", "ts", "level", "line")
    pages = (log_pages(logs, asked.select("run_id", "attempt", "from_seq"), limit)
             .groupBy("run_id", "attempt", "from_seq")
             .agg(F.array_sort(F.collect_list(item)).alias("lines"), F.max("seq").alias("_last")))
    empty = F.array().cast("array<struct<seq:bigint,ts:timestamp,level:string,line:string>>")
    return (asked.join(pages, ["run_id", "attempt", "from_seq"], "left")
            .select("run_id", "attempt", "status", "from_seq",
                    F.coalesce("lines", empty).alias("lines"),
                    F.coalesce(F.col("_last") + 1, F.col("from_seq").cast("bigint")).alias("next_seq")))


def current_attempt_lines(logs: DataFrame, runs: DataFrame) -> DataFrame:
    """Every line of each run's current attempt. Sort by (run_id, seq) to print."""
    return logs.join(runs.select(F.col("id").alias("run_id"), "attempt"), ["run_id", "attempt"])


def status_detail(runs: DataFrame) -> DataFrame:
    """Each run as (run_id, position, key, value) rows; absent values are left out."""
    def when(name: str) -> Column:
        return F.date_format(name, "yyyy-MM-dd HH:mm:ss")

    # Row names in their order.
    rows = [("run", F.col("id").cast("string")), ("job", F.col("job_id").cast("string")),
            ("status", F.col("status")), ("attempt", F.col("attempt").cast("string")),
            ("trigger", F.col("trigger")), ("scheduled", when("scheduled_time")),
            ("worker", F.col("worker_id")), ("started", when("started_at")),
            ("finished", when("finished_at")), ("retry at", when("next_attempt_at")),
            ("error", F.col("error")),
            ("output", F.concat((F.length("output") - F.length(F.replace("output", F.lit("\n"), F.lit("")))
                                 ).cast("string"), F.lit(" lines")))]
    cells = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(k).alias("key"), v.alias("value"))
                      for i, (k, v) in enumerate(rows)])
    return (runs.select(F.col("id").alias("run_id"), F.inline(cells))
            .filter(F.col("value").isNotNull()))


def with_job(runs: DataFrame, jobs: DataFrame, how: str = "inner") -> DataFrame:
    """Runs with their job's type and retry limit.

    Spark broadcasts ``jobs`` when it is small by its own measure; beyond that a
    job owning most runs is split by adaptive skew handling.
    """
    side = jobs.select(F.col("id").alias("job_id"), F.col("type").alias("job_type"), "max_retries")
    return runs.join(side, "job_id", how).select(*runs.columns, "job_type", "max_retries")


def job_names(runs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Add ``job_name``: the job's name, or the first 8 characters of an unknown id."""
    side = jobs.select(F.col("id").alias("job_id"), F.col("name").alias("_name"))
    short = F.substring(F.col("job_id").cast("string"), 1, 8)
    return (runs.join(side, "job_id", "left")
            .withColumn("job_name", F.coalesce("_name", short)).drop("_name"))
