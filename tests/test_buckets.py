"""Bucketed storage and the key index of streams: whole answers, and only the named buckets opened."""

import random

from helpers import ago, as_of, logs, runs

from pyspark.sql import functions as F

from runlake.streaming import buckets, jobs as streams
from runlake.streaming.buckets import BucketedTable, KeyIndex, bucket_of
from runlake.streaming.batches import latest


def keys_of(spark, rows):
    return spark.createDataFrame(rows, "run_id string, attempt int, seq bigint")


KINDS = dict(run_id="string", attempt="int", seq="bigint")


def test_index_finds_every_stored_key_over_merged_segments(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "FAN", 3)
    rng, stored = random.Random(7), {("r0", 1, s) for s in range(5)}
    index = KeyIndex(spark, str(tmp_path), KINDS, KINDS, buckets=4)
    index.begin(keys_of(spark, sorted(stored)))
    for n in range(10):
        batch = {(f"r{rng.randrange(6)}", 1, rng.randrange(60)) for _ in range(40)}
        got = {tuple(r) for r in index.absent(keys_of(spark, sorted(batch)), n).collect()}
        assert got == batch - stored, n
        index.add(keys_of(spark, sorted(got)), n)
        stored |= got
    assert len(buckets._segments(10)) == 2 and buckets._segments(10) == [(0, 8), (9, 9)]


def test_a_lookup_opens_only_buckets_whose_filter_hits(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), KINDS, KINDS)
    for n in range(3):
        index.add(keys_of(spark, [(f"run{i}", 1, n * 100 + s) for i in range(200) for s in range(20)]), n)
    fresh = keys_of(spark, [(f"run{i}", 2, s) for i in range(200) for s in range(5)])
    assert index.hits(fresh, 3) == [], "a thousand new keys open nothing"
    known = keys_of(spark, [("run7", 1, 105), ("run7", 9, 1)])
    (place,) = known.select(bucket_of("run_id", buckets.BUCKETS)).distinct().collect()
    assert index.hits(known, 3) == [((1, 1), [place[0]])]
    assert [tuple(r) for r in index.absent(known, 3).collect()] == [("run7", 9, 1)]
    assert index.hits(keys_of(spark, []), 3) == [] and index.absent(keys_of(spark, []), 3).collect() == []


def test_bits_of_long_filters(spark, tmp_path):
    """Several blocks a bucket: all keys are found, hardly any other."""
    index = KeyIndex(spark, str(tmp_path), KINDS, KINDS, buckets=2)
    index.add(spark.range(20_000).select(F.col("id").cast("string").alias("run_id"), F.lit(1).alias("attempt"), F.col("id").alias("seq")), 0)
    old = spark.range(15_000, 25_000).select(F.col("id").cast("string").alias("run_id"), F.lit(1).alias("attempt"), F.col("id").alias("seq"))
    assert index.absent(old, 1).count() == 5_000
    other = spark.range(3_000).select(F.col("id").cast("string").alias("run_id"), F.lit(2).alias("attempt"), F.col("id").alias("seq"))
    assert index.hits(other, 1) == []


def test_a_batch_that_names_ten_runs_opens_their_buckets(spark, tmp_path):
    table = runs(spark, *[dict(id=f"run{i}", scheduled_time=ago(i)) for i in range(500)])
    start = BucketedTable.write(table, f"{tmp_path}/start")
    ids = spark.createDataFrame([(f"run{i}",) for i in range(10)], "id string")
    named = {r[0] for r in ids.select(bucket_of("id", buckets.BUCKETS)).collect()}
    rows = start.read(ids)
    opened = {int(r[0].split("_bucket=")[1].split("/")[0]) for r in rows.select(F.input_file_name()).distinct().collect()}
    assert opened == named and len(named) <= 10
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan.replace("isnotnull(_bucket), ", "") and "Exchange" not in plan
    write = streams.claim_writer(start, f"{tmp_path}/out", lambda good: good.select("run_id", "arrived_at", "offset_no", F.lit("w").alias("worker_id")), as_of())
    message = spark.createDataFrame([(1, 0, ago(1), '{"run_id": "run3"}')], "offset_no long, partition_no int, arrived_at timestamp, value string")
    write(message, 0)
    write(message, 1)
    assert [r.id for r in latest(table, f"{tmp_path}/out").filter("status = 'RUNNING'").collect()] == ["run3"]


def test_log_batches_do_not_read_stored_lines(spark, tmp_path):
    """The lines of earlier batches are deleted; the index alone keeps re-sent ones out."""
    stored = logs(spark, dict(seq=1, line="a"))
    write = streams.log_writer(f"{tmp_path}/out", stored)
    for n in range(4):
        write(logs(spark, dict(seq=1, line="again"), dict(seq=n + 2, line=f"b{n}"), dict(seq=n + 1, line="again")), n)
        lines = spark.read.parquet(f"{tmp_path}/out/batch={n}").collect()
        assert [r.line for r in lines] == [f"b{n}"]
        spark.createDataFrame([], stored.schema).write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}")
