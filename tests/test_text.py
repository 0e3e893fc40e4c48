import datetime as dt
import decimal

import pytest
from helpers import NOW, ago, as_of, row
from pyspark.sql import functions as F

from runlake.functions import ids, text


@pytest.mark.parametrize("seconds,want", [
    (300, "5m ago"), (-300, "in 5m"), (0, "0s ago"), (59.4, "59s ago"), (59.5, "59s ago"), (-59.5, "in 1m"), (59.6, "1m ago"),
    (90, "2m ago"), (89, "1m ago"), (3600, "1h ago"), (86400, "1d ago"), (-0.5, "in 1s"), (0.5, "0s ago"), (None, "–")])
def test_relative_time(spark, seconds, want):
    when = None if seconds is None else NOW - dt.timedelta(seconds=seconds)
    df = spark.createDataFrame([(when,)], "t timestamp")
    assert row(df.select(text.relative_time(F.col("t"), as_of()).alias("x"))).x == want


def test_tenths_of_every_millisecond_below_a_minute(spark):
    got = [r.t for r in spark.range(60_000).select("id", text._tenths(F.col("id")).alias("t")).orderBy("id").collect()]
    for ms, t in enumerate(got):
        exact = decimal.Decimal(ms / 1000.0)  # the double itself, ties upwards
        assert t == int((exact * 10).quantize(decimal.Decimal(1), decimal.ROUND_HALF_UP)), ms


@pytest.mark.parametrize("start,end,want", [
    (12.34, 0, "12.3s"), (60, 0, "1m 0s"), (59.99, 0, "60.0s"), (119.6, 0, "1m 60s"), (125, 5, "2m 0s"), (0, 3, "-3.0s"), (None, 0, "–")])
def test_took(spark, start, end, want):
    df = spark.createDataFrame([(None if start is None else ago(start), ago(end))], "s timestamp, e timestamp")
    assert row(df.select(text.took(F.col("s"), F.col("e"), as_of()).alias("x"))).x == want


@pytest.mark.parametrize("lines,tail,want", [(3, "\n", None), (5, "\n", None), (6, "\n", 1), (9, "", 3), (9, "\n", 4), (1, "", None)])
def test_output_preview(spark, lines, tail, want):
    body = "\n".join(f"l{i}" for i in range(lines)) + tail
    got = row(spark.createDataFrame([(body,)], "t string").select(text.output_preview(F.col("t"), 5).alias("x"), text.line_count(F.col("t")).alias("n")))
    assert got.n == body.count("\n")
    assert got.x == (body if want is None else "\n".join(body.split("\n")[:5]) + f"\n… {want} more lines")


def test_labels(spark):
    df = spark.createDataFrame([("0 9 * * *", "UTC", True), ("0 9 * * *", "Asia/Tokyo", False), (None, "UTC", True)], "c string, z string, e boolean")
    got = df.select(text.schedule_label(F.col("c"), F.col("z")), text.schedule_label(F.col("c"), F.col("z"), True),
                    text.next_label(F.col("c"), F.col("e"), F.lit(None).cast("timestamp"), as_of())).collect()
    assert [tuple(r) for r in got] == [("0 9 * * * (UTC)", "0 9 * * *", "–"), ("0 9 * * * (Asia/Tokyo)", "0 9 * * * (Asia/Tokyo)", "paused"),
                                       ("manual", "manual", "–")]


U = "0123abcd-0123-4567-89ab-0123456789ab"


@pytest.mark.parametrize("raw,want", [(U, U), (U.upper(), U), ("urn:uuid:" + U, U), ("{" + U + "}", U), (U.replace("-", ""), U),
                                      ("nope", None), (U[:-1], None), (U + "0", None), ("", None), (U.replace("a", "g"), None)])
def test_uuid(spark, raw, want):
    assert row(spark.createDataFrame([(raw,)], "r string").select(ids.normalize_uuid(F.col("r")).alias("u"))).u == want
