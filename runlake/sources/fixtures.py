"""Views deriving jobs, runs, logs and messages from the supplied benchmark tables.

Each view is a list of SQL expressions over one whole base table, in the SQL that
Spark and DuckDB share, so that tests can evaluate the same text in both.
"""

import os

from pyspark.sql import DataFrame, SparkSession

from runlake.session import configure
from runlake.sources.tables import stream_folder

AS_OF = "TIMESTAMP '2000-01-01 00:00:00'"
_STATUS = """CASE WHEN o_orderstatus = 'O' THEN 'QUEUED' WHEN o_orderstatus = 'P' THEN 'RUNNING'
             WHEN o_orderkey % 6 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END"""
_FINAL = f"({_STATUS}) IN ('SUCCEEDED','FAILED')"


def _ago(seconds: str) -> str:
    return f"{AS_OF} - CAST({seconds} AS INT) * INTERVAL '1' SECOND"


_PAYLOAD = """CASE WHEN c_custkey % 50 = 0 THEN '{"lines": 0}'
       WHEN c_custkey % 50 = 1 THEN '{"lines": 12, "wrap_at": 72}'
       WHEN c_custkey % 50 = 2 THEN '{"lines": true}'
       WHEN c_custkey % 50 = 3 THEN '{"lines": 4, "prefix": "ba'
       ELSE concat('{"lines": ', CAST(c_custkey % 97 + 1 AS STRING), ', "fail_attempts": ', CAST(c_custkey % 3 AS STRING), '}') END"""
_CRON = """CASE c_custkey % 8 WHEN 1 THEN '*/15 * * * *' WHEN 2 THEN '0 9 * * *' WHEN 3 THEN '@hourly' WHEN 4 THEN '@every 30s'
       WHEN 5 THEN '0 */6 * * *' WHEN 6 THEN '0 0 1 * *' WHEN 7 THEN '30 8 * * 1-5' END"""
_ZONE = "CASE c_nationkey % 3 WHEN 0 THEN 'UTC' WHEN 1 THEN 'America/New_York' ELSE 'Asia/Kolkata' END"

VIEWS: dict[str, tuple[str, list[str]]] = {
    "jobs": ("customer", [
        "c_custkey AS id", "c_name AS name", "'generate_text' AS type", f"{_PAYLOAD} AS payload",
        f"{_CRON} AS cron_expr", f"{_ZONE} AS timezone",
        f"""CASE WHEN c_custkey % 8 = 0 THEN NULL
       ELSE {AS_OF} + CAST(c_custkey % 601 - 300 AS INT) * INTERVAL '1' SECOND END AS next_run_at""",
        "c_custkey % 10 <> 0 AS enabled", "CAST(c_custkey % 4 AS INT) AS max_retries",
        "CAST(60 * (c_custkey % 5 + 1) AS INT) AS timeout_sec",
        "TIMESTAMP '1995-01-01 00:00:00' + CAST(c_custkey % 1000 AS INT) * INTERVAL '1' HOUR AS created_at",
        "TIMESTAMP '1995-01-01 00:00:00' + CAST(c_custkey % 1000 AS INT) * INTERVAL '1' HOUR AS updated_at"]),
    "job_runs": ("orders", [
        "o_orderkey AS id", "o_custkey AS job_id", "o_orderdate AS scheduled_time",
        "CASE WHEN o_orderkey % 5 = 0 THEN 'manual' ELSE 'schedule' END AS trigger",
        f"{_STATUS} AS status", "CAST(o_orderkey % 4 + 1 AS INT) AS attempt",
        f"CASE WHEN ({_STATUS}) <> 'QUEUED' THEN concat('w', CAST(o_orderkey % 7 AS STRING)) END AS worker_id",
        f"{_ago('o_orderkey % 121')} AS queued_at",
        f"CASE WHEN ({_STATUS}) <> 'QUEUED' THEN {_ago('o_orderkey % 3600')} END AS started_at",
        f"CASE WHEN {_FINAL} THEN {_ago('o_orderkey % 60')} END AS finished_at",
        f"CASE WHEN ({_STATUS}) = 'RUNNING' AND o_orderkey % 11 <> 0 THEN {_ago('o_orderkey % 31')} END AS last_heartbeat_at",
        f"""CASE WHEN ({_STATUS}) = 'QUEUED' AND o_orderkey % 3 = 0
       THEN {AS_OF} + CAST(o_orderkey % 21 - 10 AS INT) * INTERVAL '1' SECOND END AS next_attempt_at""",
        "CAST(NULL AS STRING) AS error", "CAST(NULL AS STRING) AS output"]),
    "job_logs": ("lineitem", [
        "l_orderkey AS run_id", "CAST(l_suppkey % 3 + 1 AS INT) AS attempt", "CAST(l_linenumber AS BIGINT) AS seq",
        "l_shipdate AS ts", "CASE l_returnflag WHEN 'R' THEN 'error' WHEN 'A' THEN 'warn' ELSE 'info' END AS level",
        "concat('part ', CAST(l_partkey AS STRING)) AS line"]),
    "heartbeats": ("events", ["event_id AS offset_no", "user_id AS run_id", "ts", "event_type"]),
    "dispatch_raw": ("events", [
        "event_id AS offset_no", "CAST(event_id % 3 AS INT) AS partition_no", "ts AS arrived_at",
        """CASE event_id % 20 WHEN 0 THEN 'run_id=12' WHEN 1 THEN '{"run_id": ""}' WHEN 2 THEN '{"attempt": 3, "job_type": "generate_text"}'
    ELSE concat('{"run_id": "', CASE WHEN event_id % 20 = 4 THEN 'run-' ELSE '' END, CAST(user_id AS STRING), '", "job_id": "j', CAST(user_id % 50 AS STRING),
                '", "job_type": "generate_text", "attempt": ', CASE WHEN event_id % 20 = 3 THEN '3000000000' ELSE CAST(event_id % 4 + 1 AS STRING) END, '}') END AS value"""]),
    "run_events": ("lineitem", [
        "l_orderkey AS run_id",
        f"{AS_OF} + CAST(l_linenumber AS INT) * INTERVAL '1' SECOND AS at", "l_partkey AS tiebreak",
        """CASE l_partkey % 7 WHEN 0 THEN 'finish' WHEN 1 THEN 'fail' WHEN 2 THEN 'release'
       WHEN 3 THEN 'heartbeat' ELSE 'claim' END AS kind""",
        "concat('w', CAST(l_suppkey % 2 AS STRING)) AS worker_id", "CAST(l_suppkey % 2 + 1 AS INT) AS attempt",
        "concat('note ', CAST(l_partkey AS STRING)) AS message"]),
    # What workers report about runs; about one in 28 names the run's owner.
    "reports": ("lineitem", [
        "l_orderkey AS run_id", "concat('w', CAST(l_partkey % 7 AS STRING)) AS worker_id",
        "CAST(l_suppkey % 4 + 1 AS INT) AS attempt", "concat('text ', CAST(l_partkey AS STRING)) AS note"]),
    "durations": ("customer", [
        "c_custkey AS id",
        """CASE c_custkey % 6 WHEN 0 THEN concat(CAST(c_custkey % 90 AS STRING), 's')
       WHEN 1 THEN concat(CAST(c_custkey % 7 AS STRING), 'h', CAST(c_custkey % 60 AS STRING), 'm')
       WHEN 2 THEN concat(CAST(c_custkey AS STRING), 'ms') WHEN 3 THEN concat('-', CAST(c_custkey % 10 AS STRING), '.5h')
       WHEN 4 THEN CAST(c_custkey + 1 AS STRING) ELSE concat('m', CAST(c_custkey AS STRING)) END AS duration"""]),
    "uuids": ("orders", [
        "o_orderkey AS id",
        """CASE o_orderkey % 6 WHEN 0 THEN md5(CAST(o_orderkey AS STRING)) WHEN 1 THEN upper(md5(CAST(o_orderkey AS STRING)))
       WHEN 2 THEN concat(substr(md5(CAST(o_orderkey AS STRING)), 1, 8), '-1234-5678-9abc-', substr(md5(CAST(o_orderkey AS STRING)), 1, 12))
       WHEN 3 THEN concat('urn:uuid:', substr(md5(CAST(o_orderkey AS STRING)), 1, 8), '-ABCD-5678-9abc-', substr(md5(CAST(o_orderkey AS STRING)), 1, 12))
       WHEN 4 THEN concat('{', substr(md5(CAST(o_orderkey AS STRING)), 1, 8), '-ABCD-5678-9abc-', substr(md5(CAST(o_orderkey AS STRING)), 1, 12), '}')
       ELSE concat('nope-', CAST(o_orderkey AS STRING)) END AS raw"""]),
    "job_requests": ("customer", [
        "c_custkey AS id",
        f"""concat('{{"name": "', CASE WHEN c_custkey % 23 = 0 THEN '  ' ELSE c_name END, '"',
       CASE WHEN c_custkey % 29 = 0 THEN '' WHEN c_custkey % 31 = 0 THEN ', "type": "resize_image"' ELSE ', "type": "generate_text"' END,
       CASE WHEN c_custkey % 37 = 0 THEN '' WHEN c_custkey % 50 = 3 THEN ', "payload": "12 lines"' ELSE concat(', "payload": ', {_PAYLOAD}) END,
       CASE WHEN c_custkey % 8 = 0 THEN '' ELSE concat(', "cron_expr": "', {_CRON}, '"') END,
       CASE WHEN c_custkey % 41 = 0 THEN ', "timezone": "Europe/Atlantis"' WHEN c_custkey % 43 = 0 THEN ', "timezone": "Local"'
            WHEN c_nationkey % 3 = 0 THEN '' ELSE concat(', "timezone": "', {_ZONE}, '"') END,
       CASE WHEN c_custkey % 3 = 0 THEN concat(', "max_retries": ', CAST(c_custkey % 14 - 1 AS STRING)) ELSE '' END,
       CASE WHEN c_custkey % 7 = 0 THEN concat(', "timeout_sec": ', CAST((c_custkey % 5) * 21601 AS STRING)) ELSE '' END,
       CASE WHEN c_custkey % 47 = 0 THEN ', "owner": "ops"' ELSE '' END,
       CASE WHEN c_custkey % 53 = 0 THEN '' ELSE '}}' END,
       CASE WHEN c_custkey % 59 = 0 THEN ' 0' ELSE '' END) AS body"""]),
    # One event stream per conversation turn; blank lines of the text end a block.
    "sse_texts": ("conversations", [
        "conv_id", "turn",
        """replace(concat('event: ', role, chr(10), 'data: ', replace(text, chr(10), concat(chr(10), 'data: ')), chr(10), chr(10)),
       concat(chr(10), 'data: ', chr(10)), concat(chr(10), chr(10))) AS text"""]),
}
WHERE: dict[str, str] = {}


def base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, exprs = VIEWS[name]
    df = base(spark, sf_dir, table)
    return _project(df, name, exprs)


def view_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same view over the base table read as a stream."""
    table, exprs = VIEWS[name]
    schema = base(spark, sf_dir, table).schema
    return _project(stream_folder(spark, os.path.join(sf_dir, f"{table}.parquet"), schema), name, exprs)


def _project(df: DataFrame, name: str, exprs: list[str]) -> DataFrame:
    if name in WHERE:
        df = df.filter(WHERE[name])
    return df.selectExpr(*exprs)
