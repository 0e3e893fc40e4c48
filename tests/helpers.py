"""Small tables for tests: rows given as dicts, absent columns NULL or a default."""

import datetime as dt

from pyspark.sql import functions as F

from runlake.schema import JOBS, LOGS, RUNS, ddl

NOW = dt.datetime(2026, 9, 17, 10, 0, 0)


def ago(seconds):
    return NOW - dt.timedelta(seconds=seconds)


def as_of():
    return F.lit(NOW.isoformat(sep=" ")).cast("timestamp")


def _table(spark, columns, rows, defaults):
    data = [tuple({**defaults, **r}.get(c) for c in columns) for r in rows]
    return spark.createDataFrame(data, ddl(columns))


def jobs(spark, *rows):
    return _table(spark, JOBS, rows, dict(
        id="j1", name="job", type="generate_text", payload='{"lines": 1}', timezone="UTC", enabled=True,
        max_retries=1, timeout_sec=60, created_at=ago(1000), updated_at=ago(1000)))


def runs(spark, *rows):
    return _table(spark, RUNS, rows, dict(
        id="r1", job_id="j1", scheduled_time=ago(500), trigger="schedule", status="QUEUED", attempt=1,
        queued_at=ago(100)))


def logs(spark, *rows):
    return _table(spark, LOGS, rows, dict(run_id="r1", attempt=1, ts=ago(10), level="info"))


def running(**extra):
    return dict(status="RUNNING", worker_id="w1", started_at=ago(50), last_heartbeat_at=ago(20)) | extra


def row(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]
