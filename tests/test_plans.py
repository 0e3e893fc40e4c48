"""What the physical plans must show: pruning, pushdown, no Python, bounded groups."""

import re

import pytest
from conftest import SF
from helpers import ago, as_of, jobs, logs, running, runs
from pyspark.sql import functions as F

from runlake.operators import lookup, transitions, validate
from runlake.operators.inserts import first_occurrences
from runlake.plans import catalog
from runlake.plans.maintenance import maintenance_pass
from runlake.sources import dispatch, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    v = catalog.Views(spark, SF)
    as_text = lambda df, ids: df.select(*[F.col(c).cast("string").alias(c) if c in ids else F.col(c) for c in df.columns])
    tables.write_runs(as_text(v.runs, ("id", "job_id")), f"{root}/runs")
    tables.write_logs(as_text(v.lines, ("run_id",)), f"{root}/logs")
    as_text(v.jobs, ("id",)).write.parquet(f"{root}/jobs")
    return (tables.read_jobs(spark, f"{root}/jobs"), tables.read_runs(spark, f"{root}/runs"),
            tables.read_logs(spark, f"{root}/logs"))


@pytest.mark.parametrize("step", ["reap", "retry", "sweep", "pass"])
def test_open_run_operators_read_only_open_runs(stored, step):
    job, run, _ = stored
    df = {"reap": lambda: transitions.reap_stale(run, job, as_of()).changed,
          "retry": lambda: transitions.due_retries(run, job, as_of()).changed,
          "sweep": lambda: transitions.sweep_queued(run, job, as_of()).changed,
          "pass": lambda: maintenance_pass(run, job, as_of()).dispatches}[step]()
    text = plan(df)
    scan = next(l for l in text.splitlines() if "FileScan" in l and "runs" in l)
    assert re.search(r"PartitionFilters: \[.*status", scan)
    if step != "pass":
        column = {"reap": "last_heartbeat_at", "retry": "next_attempt_at", "sweep": "queued_at"}[step]
        assert re.search(rf"PushedFilters: \[.*LessThan(OrEqual)?\({column}", scan), scan
    assert text.count("FileScan") == 2 and "Inner" in text or step == "pass"


def test_stored_tables_read_back_whole(spark, stored):
    v = catalog.Views(spark, SF)
    assert [t.count() for t in stored] == [v.jobs.count(), v.runs.count(), v.lines.count()]
    ids = lambda df: sorted(map(str, (r.id for r in df.collect())))
    got = transitions.reap_stale(stored[1], stored[0], as_of_2000()).changed
    assert ids(got) == ids(catalog.QUERIES["reap_stale"](spark, SF))


def as_of_2000():
    return F.lit("2000-01-01").cast("timestamp")


def test_lists_are_top_k_and_read_no_output(stored):
    text = plan(lookup.list_runs(stored[1]))
    assert "TakeOrderedAndProject" in text and "output:string" not in text
    page = plan(lookup.log_page(stored[2], "7", 1))
    assert "TakeOrderedAndProject" in page and "EqualTo(run_id,7)" in page


def test_top_k_per_job_is_limited_before_the_shuffle(stored):
    text = plan(lookup.list_runs_per_job(stored[1], 5))
    exchange = text.index("Exchange hashpartitioning(job_id")
    assert text.rindex("WindowGroupLimit") > exchange, "the partial limit sits below the shuffle"


def test_filters_on_raw_columns_reach_the_scan(spark, tmp_path):
    spark.sql("SELECT 1L AS offset_no, '{}' AS value").write.parquet(f"{tmp_path}/m")
    text = plan(dispatch.decode(spark.read.parquet(f"{tmp_path}/m")).filter("offset_no = 7"))
    assert "EqualTo(offset_no,7)" in text
    spark.sql("SELECT 1L AS id, '{}' AS body").write.parquet(f"{tmp_path}/r")
    text = plan(validate.check_requests(spark.read.parquet(f"{tmp_path}/r"), as_of()).filter("id = 7"))
    assert "EqualTo(id,7)" in text


def test_a_snapshot_joins_open_runs_only(stored):
    text = plan(maintenance_pass(stored[1], stored[0], as_of()).snapshot)
    assert "Union" in text and re.search(r"PartitionFilters: \[.*status#\d+ IN \(QUEUED,RUNNING\)", text)


def test_first_copies_are_reduced_before_the_shuffle(stored):
    text = plan(first_occurrences(stored[1]))
    assert text.count("partial_min") >= 1


@pytest.mark.parametrize("name", sorted(k for k in catalog.QUERIES if not k.startswith("stream_")))
def test_batch_queries_run_no_python_and_no_cross_join(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF))
    for bad in ("Python", "ArrowEval", "BatchEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text
    if name == "maintenance_pass_limited":  # its picks, at most twice the limit of each step, follow within one row
        assert "WindowGroupLimit" in text and text.count("SinglePartition") <= 1 and "_rank" in text
        return
    assert "AllTuples" not in text and "SinglePartition" not in re.sub(r"TakeOrdered\w+", "", text)


def test_a_hot_join_key_is_split(spark):
    """One run with most lines, tiny thresholds, no broadcast: adaptive execution must split it."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, value in settings.items():
            spark.conf.set(k, value)
        log = spark.range(40_000).select(
            F.when(F.col("id") % 3 > 0, F.col("id") % 50).otherwise(F.lit(0)).cast("string").alias("run_id"),
            F.lit(1).alias("attempt"), F.col("id").alias("seq"), F.lit(ago(1)).alias("ts"), F.lit("info").alias("level"),
            F.md5(F.col("id").cast("string")).alias("line")).repartition(16)
        table = spark.range(50).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("attempt"))
        df = lookup.current_attempt_lines(log, table)
        assert len(df.collect()) == 40_000
        assert "skew=true" in plan(df)
    finally:
        for k, value in old.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def test_request_guards_broadcast_nothing_unbounded(spark):
    """Only a limit's picked ids are broadcast by hint; the rest is Spark's own size check."""
    table = runs(spark, running())
    text = transitions.reap_stale(table, jobs(spark, {}), as_of(), 15).marked._jdf.queryExecution().logical().toString()
    assert "broadcast" not in text


def test_a_limited_pass_scans_and_joins_little(spark, tmp_path):
    from helpers import as_of, jobs, runs
    from runlake.plans.maintenance import maintenance_pass
    tables = []
    for name, df in (("runs", runs(spark, {})), ("jobs", jobs(spark, {}))):
        df.write.parquet(f"{tmp_path}/{name}")
        tables.append(spark.read.parquet(f"{tmp_path}/{name}"))
    done = maintenance_pass(*tables, as_of(), limit=100)
    plan = done.dispatches._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 4 and plan.count("Join ") <= 3, plan
    assert "WindowGroupLimit" in plan
