"""Runs as keyed state: equal to the fold, requeued by timers, and the start table read once."""

import datetime as dt

from helpers import NOW, ago, jobs, running, runs
from test_fold import EVENT, make_events
from test_streams import as_files, rows_of

from pyspark.sql import functions as F

from runlake.operators import fold
from runlake.schema import RUNS
from runlake.streaming import jobs as streams, state
from runlake.streaming.batches import latest, write_changes


def at(seconds):
    return NOW + dt.timedelta(seconds=seconds)


def collect(stream, target, progress):
    (stream.writeStream.foreachBatch(lambda rows, n: write_changes(rows, target, n)).outputMode("update")
     .option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination())


def test_without_timers_equals_the_fold(spark, tmp_path):
    table = runs(spark, dict(id="a"), running(id="b"), dict(id="c", job_id="gone"), dict(id="d", status="SUCCEEDED"))
    rows = sorted(make_events(3, {"a": 60, "b": 40, "c": 20, "d": 5, "unknown": 5}), key=lambda e: (e[1], e[2] is not None, e[2]))
    cut = next(i for i in range(len(rows) // 2, len(rows)) if rows[i][1] != rows[i - 1][1])
    events = spark.createDataFrame(rows, EVENT)
    stream = as_files(spark, events, [rows[:cut], rows[cut:]], tmp_path)
    collect(state.kept_runs(stream, table, jobs(spark, {}), "1 hour", timers=False), f"{tmp_path}/out", f"{tmp_path}/progress")
    got = latest(streams.with_counts(table), f"{tmp_path}/out")
    assert rows_of(got) == rows_of(fold.state_fold(table, jobs(spark, {}), events).select(*got.columns))


def test_timers_act_without_input_and_the_start_table_is_read_once(spark, tmp_path):
    table = runs(spark, running(id="silent", last_heartbeat_at=at(0)), running(id="spent", attempt=2, last_heartbeat_at=at(0)),
                 running(id="alive", last_heartbeat_at=at(0)), dict(id="waits", next_attempt_at=at(30)), dict(id="later", next_attempt_at=at(101)),
                 running(id="orphan", job_id="gone", last_heartbeat_at=at(0)), running(id="mute", last_heartbeat_at=None), dict(id="clock"))
    beat = lambda run, s, kind="heartbeat": (run, at(s), 1, kind, "w1", 1, None)
    parts = [[beat("alive", 15), beat("clock", 15, "claim")], [beat("clock", 30), beat("alive", 30)], [beat("clock", 45), beat("alive", 45)], [beat("alive", 60), beat("clock", 100)]]
    stream = as_files(spark, spark.createDataFrame([], EVENT), parts[:2], tmp_path / "one")
    collect(state.kept_runs(stream, table, jobs(spark, {}), "0 seconds"), f"{tmp_path}/out", f"{tmp_path}/progress")

    def now():
        return {r.id: r for r in latest(streams.with_counts(table), f"{tmp_path}/out").collect()}
    got = now()
    assert (got["silent"].status, got["silent"].attempt, got["silent"].error) == ("QUEUED", 2, "attempt 1 lost worker w1")
    assert got["silent"].queued_at == at(15) + dt.timedelta(microseconds=1)
    assert (got["spent"].status, got["spent"].error) == ("FAILED", "attempt 2 lost worker w1") and got["alive"].status == "RUNNING"
    assert (got["waits"].next_attempt_at, got["waits"].queued_at) == (None, at(30)), "due at the very moment"
    assert got["later"].next_attempt_at == at(101) and got["orphan"].status == got["mute"].status == "RUNNING"

    # The same stream goes on with a start table that can't be read any more.
    broken = table.withColumn("error", F.raise_error(F.lit("read again")).cast("string"))
    import os
    files = [f"{tmp_path}/two/all/{n}" for n in sorted(os.listdir(as_files(spark, spark.createDataFrame([], EVENT), parts[2:], tmp_path / "two") and tmp_path / "two" / "all"))]
    for i, name in enumerate(files):
        os.link(name, f"{tmp_path}/one/all/next{i}.parquet")
    collect(state.kept_runs(stream, broken, jobs(spark, {}), "0 seconds"), f"{tmp_path}/out", f"{tmp_path}/progress")
    got = now()
    assert (got["alive"].status, got["alive"].queued_at) == ("QUEUED", at(75) + dt.timedelta(microseconds=1))
    assert got["clock"].status == "QUEUED" and got["clock"].rejected == 1, "silent from 45 to 100: its beat at 100 comes too late"
    assert got["later"].next_attempt_at == at(101) and list(table.columns) == list(RUNS)
