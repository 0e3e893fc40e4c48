"""Streaming forms of the operators.

Every ``*_writer`` returns a ``foreachBatch`` function. Inside a micro-batch the
batch operators do the work, so a stream and its batch twin share one definition.
Delivery is at least once; keyed guards make the effect exactly once.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from runlake.config import DEFAULT_POLICY, Policy
from runlake.operators import fold, transitions
from runlake.operators.events import event_rows
from runlake.schema import LOG_KEY, LOGS, RUNS
from runlake.sources import dispatch, logs
from runlake.streaming.buckets import BucketedTable, KeyIndex
from runlake.streaming.batches import latest, read_batches, schema_of, write_batch, write_changes

Writer = Callable[[DataFrame, int], None]


def dispatch_writer(good_dir: str, dead_dir: str) -> Writer:
    """Decode messages; good ones and dead letters go to two folders."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        good, dead = dispatch.split(dispatch.decode(batch))
        write_batch(good, good_dir, batch_id)
        write_batch(dead, dead_dir, batch_id)
        batch.unpersist()
    return write


def claim_writer(runs: DataFrame | BucketedTable, changes: str, requests: Callable[[DataFrame], DataFrame],
                 as_of: Column) -> Writer:
    """Let arriving messages claim runs.

    A message repeated in a later batch may claim again, as a re-dispatch must,
    so messages are reduced only within their batch; the run's status decides.
    A batch reads the buckets of the runs it names and writes those it claims; ``latest`` of the
    changes gives all runs. A table that is not bucketed yet is copied once.
    """
    start = bucketed(runs, changes)

    def write(batch: DataFrame, batch_id: int) -> None:
        good, _ = dispatch.split(dispatch.decode(batch))
        asked = requests(good).persist()
        now = latest(start, changes, batch_id, asked.select(F.col("run_id").alias("id")).distinct())
        write_changes(transitions.claim(now, asked, as_of).changed, changes, batch_id)
        asked.unpersist()
    return write


def log_writer(target: str, existing: DataFrame, arrival=("ts", "line", "level")) -> Writer:
    """Append new log lines; a key already stored is ignored.

    What is stored is looked up in an index of keys beside ``target``, so stored lines are not read again.
    """
    index = KeyIndex(existing.sparkSession, f"{target}-index", LOG_KEY, dict(existing.dtypes))
    index.begin(existing)

    def write(batch: DataFrame, batch_id: int) -> None:
        first = logs.first_copies(batch, arrival).select(*LOGS).persist()
        write_batch(index.absent(first, batch_id), target, batch_id)
        index.add(read_batches(batch.sparkSession, target, schema_of(first), batch_id + 1, batch_id - 1), batch_id)
        first.unpersist()
    return write


def distinct_lines(stream: DataFrame, lateness: str) -> DataFrame:
    """Bounded-state form of ``log_writer``: any one copy of a line within ``lateness`` of the others."""
    return stream.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["run_id", "attempt", "seq"])


def closed_sessions(heartbeats: DataFrame, stale_after: int, lateness: str, keys=("run_id",)) -> DataFrame:
    """Sessions silent for longer than ``stale_after``, emitted as the watermark passes their reap time.

    Partial sessions are merged in each task before the shuffle.
    """
    heartbeats.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return (heartbeats.withWatermark("ts", lateness)
            .groupBy(*keys, F.session_window("ts", f"{stale_after} seconds"))
            .agg(F.min("ts").alias("session_start"), F.max("ts").alias("last_heartbeat"),
                 F.count(F.lit(1)).alias("beats"))
            .select(*keys, "session_start", "last_heartbeat",
                    F.col("session_window.end").alias("reap_at"), "beats"))


def append_writer(target: str) -> Writer:
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, target, batch_id)
    return write


def with_counts(runs: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return runs.select(*RUNS).withColumn("accepted", zero).withColumn("rejected", zero)


def bucketed(table: DataFrame | BucketedTable, changes: str) -> BucketedTable:
    return table if isinstance(table, BucketedTable) else BucketedTable.write(table, f"{changes}-start")


def state_writer(runs: DataFrame, jobs: DataFrame, changes: str,
                 policy: Policy = DEFAULT_POLICY) -> Writer:
    """Fold arriving events into the stored runs; event counts add up over batches.

    As with claims, a batch reads the buckets of the runs that it has events for, and writes those runs.
    """
    start = bucketed(with_counts(runs), changes)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        before = latest(start, changes, batch_id, batch.select(F.col("run_id").alias("id")).distinct())
        after = fold.state_fold(before.select(*RUNS), jobs, batch, policy)
        past = before.select("id", F.col("accepted").alias("_a"), F.col("rejected").alias("_r"))
        write_changes(after.join(past, "id").select(
            *RUNS, (F.col("accepted") + F.col("_a")).alias("accepted"),
            (F.col("rejected") + F.col("_r")).alias("rejected")), changes, batch_id)
        batch.unpersist()
    return write


EVENT_KEY = ["run_id", "attempt", "kind", "seq"]


def _store_lines(lines: DataFrame, target: str, batch_id: int) -> None:
    past = read_batches(lines.sparkSession, target, schema_of(lines), batch_id).select(*lines.columns)
    write_batch(logs.new_lines(past, lines).select(*lines.columns), target, batch_id)


def tail_writer(runs_dir: str, lines_dir: str, events_dir: str) -> Writer:
    """Emit the log events that each batch of changed runs and new lines makes known, with built-in operators alone.

    It reads the stored lines and sent events of the runs that a batch names again: a form for streams of few batches. A
    long one is followed by ``runlake.streaming.tail``, which reads nothing twice.

    A batch stores both and looks at the runs that either names, so a run's ``end`` comes
    with its last status even where no line follows, and a run without lines has its
    markers. A worker stores its lines before its status, so where inputs keep that order an ``end`` never
    precedes its lines; the set of events is the same in any order.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changed = batch.filter("run IS NOT NULL").select("run.*")
        arrived = batch.filter("line IS NOT NULL").select("line.*")
        write_changes(changed, runs_dir, batch_id)
        _store_lines(arrived, lines_dir, batch_id)
        touched = changed.select("id").unionByName(arrived.select(F.col("run_id").alias("id"))).distinct()
        runs = latest(changed.limit(0), runs_dir, batch_id + 1, touched)
        stored = read_batches(spark, lines_dir, schema_of(arrived), batch_id + 1).select(*LOGS)
        rows = event_rows(runs, stored.join(touched.withColumnRenamed("id", "run_id"), "run_id", "left_semi"))
        if batch_id > 0:
            sent = read_batches(spark, events_dir, schema_of(rows), batch_id)
            rows = rows.join(sent.select(*EVENT_KEY), EVENT_KEY, "left_anti")
        write_batch(rows, events_dir, batch_id)
    return write
