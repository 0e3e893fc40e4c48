import datetime as dt

import pytest
from conftest import SF
from helpers import ago, as_of, jobs, logs, runs

from pyspark.sql import functions as F

from runlake.operators import events, fold, transitions
from runlake.plans import catalog
from runlake.sources import dispatch, tables
from runlake.streaming import batches, jobs as streams, tail
from runlake.streaming.batches import latest, read_batches, run_available, schema_of


def as_files(spark, df, parts, path):
    """Write ``parts`` row lists as files, oldest first, and stream them one file per batch."""
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, df.schema).coalesce(1).write.mode("append").parquet(f"{path}/p{i}")
    import glob, os, time
    stream_dir = f"{path}/all"
    os.makedirs(stream_dir)
    for i in range(len(parts)):
        (name,) = glob.glob(f"{path}/p{i}/*.parquet")
        os.link(name, f"{stream_dir}/{i}.parquet")
        os.utime(f"{stream_dir}/{i}.parquet", (1_000_000 + i * 10, 1_000_000 + i * 10))
    return tables.stream_folder(spark, stream_dir, df.schema, max_files=1)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_log_append_over_batches_keeps_the_first_copy(spark, tmp_path):
    stored = logs(spark, dict(seq=1, line="a"))
    parts = [[("r1", 1, 1, ago(9), "info", "A"), ("r1", 1, 2, ago(9), "info", "b")], [("r1", 1, 2, ago(99), "info", "B"), ("r1", 1, 3, ago(9), "info", "c")]]
    run_available(as_files(spark, stored, parts, tmp_path), streams.log_writer(f"{tmp_path}/out", stored), "t")
    assert sorted(r.line for r in read_batches(spark, f"{tmp_path}/out", schema_of(stored)).collect()) == ["b", "c"]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    stored = logs(spark)
    write = streams.log_writer(f"{tmp_path}/out", stored)
    one, two = logs(spark, dict(seq=1, line="a")), logs(spark, dict(seq=1, line="x"), dict(seq=2, line="b"))
    for df, n in ((one, 0), (two, 1), (two, 1)):
        write(df, n)
    assert sorted(r.line for r in read_batches(spark, f"{tmp_path}/out", schema_of(stored)).collect()) == ["a", "b"]


def test_state_over_batches_equals_one_fold(spark, tmp_path):
    v = catalog.Views(spark, SF)
    all_events = v.run_events
    rows = sorted(map(tuple, all_events.collect()), key=lambda r: (r[1], r[2]))
    mid = next(i for i in range(len(rows) // 2, len(rows)) if rows[i][1] != rows[i - 1][1])
    stream = as_files(spark, all_events, [rows[:mid], rows[mid:]], tmp_path)
    run_available(stream, streams.state_writer(v.runs, v.jobs, f"{tmp_path}/state"), "t")
    last = latest(streams.with_counts(v.runs), f"{tmp_path}/state")
    assert rows_of(last) == rows_of(fold.state_fold(v.runs, v.jobs, all_events).select(*last.columns))


def test_many_batches_with_compaction_equal_one_fold(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batches, "COMPACT_EVERY", 2)
    v = catalog.Views(spark, SF)
    table, all_events = v.runs.filter("id < 400"), v.run_events.filter("run_id < 400")
    rows = sorted(map(tuple, all_events.collect()), key=lambda r: (r[1], r[2]))
    cuts = [0, *sorted({next((i for i in range(len(rows) * k // 7, len(rows)) if rows[i][1] != rows[i - 1][1]), len(rows)) for k in range(1, 7)}), len(rows)]
    write, read = streams.state_writer(table, v.jobs, f"{tmp_path}/s"), []
    for n, (low, high) in enumerate(zip(cuts, cuts[1:])):
        write(spark.createDataFrame(rows[low:high], all_events.schema), n)
        read.append(len(batches._changes(spark, f"{tmp_path}/s", schema_of(streams.with_counts(table)), n + 1).inputFiles()))
    assert len(read) >= 4 and rows_of(latest(streams.with_counts(table), f"{tmp_path}/s")) == rows_of(latest(
        streams.with_counts(table), f"{tmp_path}/s", len(read)))
    last = latest(streams.with_counts(table), f"{tmp_path}/s", len(read))
    assert rows_of(last) == rows_of(fold.state_fold(table, v.jobs, all_events).select(*last.columns))
    assert max(read[3:]) <= max(read[:3]), "a later batch reads no more files than an early one"


def test_a_redispatched_message_may_claim_again_but_a_claimed_run_stays(spark, tmp_path):
    table = runs(spark, dict(id="1"), dict(id="2", next_attempt_at=ago(-5), scheduled_time=ago(1)))
    raw = spark.createDataFrame([], "offset_no long, partition_no int, arrived_at timestamp, value string")
    msg = lambda n, part, run: (n, part, ago(50 - n), '{"run_id": "%s"}' % run)
    stream = as_files(spark, raw, [[msg(1, 0, "1"), msg(2, 1, "1"), msg(3, 0, "2")], [msg(4, 2, "1"), msg(5, 2, "2")]], tmp_path)
    ask = lambda good: good.select("run_id", "arrived_at", "offset_no", F.concat(F.lit("w"), F.col("partition_no").cast("string")).alias("worker_id"))
    run_available(stream, streams.claim_writer(table, f"{tmp_path}/out", ask, as_of()), "t")
    got = {r.id: (r.status, r.worker_id) for r in latest(table, f"{tmp_path}/out").collect()}
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1, "only claimed runs are written"
    assert got == {"1": ("RUNNING", "w0"), "2": ("QUEUED", None)}


def test_tail_emits_each_event_once_and_ends_after_the_lines(spark, tmp_path):
    """A line while RUNNING, re-sent ones among more lines, the status alone, a run that never writes a line, lines before their run."""
    running, done = runs(spark, dict(status="RUNNING", worker_id="w", attempt=1)), runs(spark, dict(status="SUCCEEDED", attempt=2))
    quiet, last = runs(spark, dict(id="r2", status="FAILED", error="no")), runs(spark, dict(id="r3", attempt=2, status="QUEUED"))
    empty, none = logs(spark), runs(spark).limit(0)
    lines = [[("r1", 1, 1, ago(9), "info", "a1"), ("r3", 2, 5, ago(9), "info", "early")],
             [("r1", 1, 3, ago(8), "info", "a3"), ("r1", 1, 3, ago(9), "info", "first copy"), ("r1", 2, 1, ago(7), "info", "b1"), ("r1", 3, 1, ago(7), "info", "never")],
             [("r1", 1, 1, ago(99), "info", "again"), ("r1", 1, 2, ago(1), "info", "late")], [("r3", 2, 5, ago(99), "info", "again")]]
    given = [(running, lines[0]), (none, lines[1]), (done, lines[2]), (quiet, []), (last, lines[3])]
    inputs = [tail.tail_input(r, spark.createDataFrame(x, empty.schema)) for r, x in given]
    stream = tail.tail(as_files(spark, inputs[0], [df.collect() for df in inputs], tmp_path))
    run_available(stream, streams.append_writer(f"{tmp_path}/events"), "t")
    kept = spark.createDataFrame([lines[0][0], lines[0][1], *lines[1][1:], lines[2][1]], empty.schema)
    want = events.event_rows(done.unionByName(quiet).unionByName(last), kept)
    got = read_batches(spark, f"{tmp_path}/events", schema_of(want))
    assert rows_of(got.drop("batch")) == rows_of(want)
    assert sorted((r.run_id, r.batch) for r in got.filter("event = 'end'").collect()) == [("r1", 2), ("r2", 3)]
    assert [r.batch for r in got.filter("data LIKE '%early%'").collect()] == [4] and got.filter("data LIKE '%b1%'").first().batch == 2


def test_a_hot_run_costs_its_tail_what_arrives(monkeypatch):
    """Two hundred batches for one run: each reads one cursor of constant size and nothing else."""
    class Value:
        now, reads = None, 0

        def get(self):
            self.reads += 1
            return self.now

        def update(self, value):
            self.now = value

    class Handle:
        cursor, waiting = Value(), None

        def getValueState(self, *_):
            return self.cursor

        def getMapState(self, *_):
            return self.waiting  # not touched
    keeper, handle = tail.TailKeeper(), Handle()
    keeper.init(handle)
    line = lambda seq: dict(attempt=1, seq=seq, ts=ago(0), level="info", line="x", status=None, error=None, is_run=False)
    run = dict(attempt=1, status="RUNNING", error=None, seq=None, is_run=True)
    assert len(list(keeper.handleInputRows(("r",), [run], None))) == 1
    for n in range(200):
        fresh = range(n * 100, n * 100 + 100)
        assert len(list(keeper.handleInputRows(("r",), map(line, [*reversed(fresh), n * 50]), None))) == 100
    assert handle.cursor.now[-1] == [[1, 0, 19_999]] and handle.cursor.reads == 201


def test_ranges_of_seen_lines():
    import random
    rng = random.Random(5)
    for _ in range(50):
        ranges, seen = [], set()
        for _ in range(60):
            seq = rng.randrange(40)
            assert tail.add_seen(ranges, seq) == (seq not in seen)
            seen.add(seq)
        flat = [x for low, high in zip(ranges[::2], ranges[1::2]) for x in range(low, high + 1)]
        assert flat == sorted(seen) and all(b - a > 1 for a, b in zip(ranges[1::2], ranges[2::2]))


def test_bounded_deduplication(spark, tmp_path):
    empty = logs(spark)
    parts = [[("r1", 1, 1, ago(9), "info", "a"), ("r1", 1, 1, ago(9), "info", "a")], [("r1", 1, 1, ago(8), "info", "a"), ("r1", 1, 2, ago(8), "info", "b")]]
    stream = streams.distinct_lines(as_files(spark, empty, parts, tmp_path), "1 hour")
    run_available(stream, streams.append_writer(f"{tmp_path}/out"), "t")
    assert sorted(r.line for r in read_batches(spark, f"{tmp_path}/out", schema_of(empty)).collect()) == ["a", "b"]


def test_dead_letters(spark, tmp_path):
    good, dead = f"{tmp_path}/good", f"{tmp_path}/dead"
    raw = spark.createDataFrame([(1, "{}")], "offset_no int, value string")
    run_available(as_files(spark, raw, [[(1, "not json"), (2, '{"run_id": "a"}')]], tmp_path), streams.dispatch_writer(good, dead), "t")
    assert [r.offset_no for r in spark.read.parquet(good).collect()] == [2]
    assert [r.offset_no for r in spark.read.parquet(dead).collect()] == [1]
