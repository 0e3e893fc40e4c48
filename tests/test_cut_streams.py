"""Event text cut over rows, and snapshots compared by digests."""

import random

from helpers import ago, runs
from pyspark.sql import functions as F

from runlake.operators import changes, events


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_any_cut_of_a_text_decodes_as_the_whole(spark, monkeypatch):
    monkeypatch.setattr(events, "STRETCH", 5)
    rng = random.Random(3)
    pieces = ["event: line", "event:end ", "data: x", "data:", "data: y ", ": note", "id: 7", "", "", "", "\r", "data: é\r", "event: "]
    texts = ["\n".join(rng.choices(pieces, k=rng.randrange(1, 40))) + rng.choice(["", "\n", "\n\n", "\r\n\r\n"]) for _ in range(40)] + ["", "\n\n", "data: z"]
    cut = []
    for i, t in enumerate(texts):
        at = sorted(rng.choices(range(len(t) + 1), k=rng.randrange(0, 12)))
        cut += [(i, pos, t[a:b]) for pos, (a, b) in enumerate(zip([0, *at], [*at, len(t)]))]
    rng.shuffle(cut)
    whole = events.sse_decode(spark.createDataFrame(list(enumerate(texts)), "stream_id int, text string"))
    got = events.sse_decode_rows(spark.createDataFrame(cut, "stream_id int, pos int, text string").repartition(4))
    assert rows_of(got) == rows_of(whole) and whole.count() > 50
    assert events.sse_decode_rows(spark.createDataFrame([], "stream_id int, pos int, text string")).collect() == []


def test_one_long_stream_spreads_over_tasks(spark):
    n = 100_000
    rows = spark.range(n).select(F.floor(F.col("id") / n).alias("stream_id"), F.col("id").alias("pos"), F.concat(F.lit("data: "), F.col("id"), F.lit("\n\n")).alias("text"))
    got = events.sse_decode_rows(rows)
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.agg(F.count("*"), F.min("position"), F.max("position"), F.sum((F.col("data").cast("int") + 1 == F.col("position")).cast("int"))).first() == (n, 1, n, n)


def test_changes_equal_a_plain_comparison_and_equal_ranges_stay_put(spark, tmp_path):
    rng = random.Random(9)
    old = [dict(id=f"r{i}", scheduled_time=ago(i), status="RUNNING", started_at=rng.choice([None, ago(5)]), finished_at=None, last_heartbeat_at=ago(i)) for i in range(3000)]
    new = [dict(r, last_heartbeat_at=ago(1)) for r in old if r["id"] != "r5"] + [dict(old[0], id="added")]
    new[100] = dict(new[100], started_at=None, finished_at=ago(5)) if new[100]["started_at"] else dict(new[100], finished_at=ago(5))
    new[200] = dict(new[200], worker_id="w9")
    for name, rows in (("old", old), ("new", new)):
        runs(spark, *rows).write.parquet(f"{tmp_path}/{name}")
    before, after = (spark.read.parquet(f"{tmp_path}/{x}") for x in ("old", "new"))
    found = changes.run_changes(before, after)
    assert {tuple(r) for r in found.collect()} == {("r5", "removed"), ("added", "added"), (new[100]["id"], "changed"), (new[200]["id"], "changed")}
    plan = found._jdf.queryExecution().executedPlan().toString()
    semi, join = plan.rindex("LeftSemi"), plan.index("FullOuter")
    assert plan.count("BroadcastHashJoin") >= 2 and join < semi, "ranges are dropped below the exchange of the join"
    kept = before.withColumn("_range", changes._range()).join(F.broadcast(spark.createDataFrame([(r,) for r in {
        x[0] for x in found.select(changes._range()).collect()}], "_range int")), "_range", "left_semi").count()
    assert kept < 10, "four changes move a handful of three thousand runs"
