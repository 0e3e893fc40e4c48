"""Typed readers and writers of the three tables."""

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from runlake.schema import JOBS, LOGS, RUNS, ddl


def conform(df: DataFrame, columns: dict[str, str], keep_ids: bool = True) -> DataFrame:
    """Select ``columns`` in order with their types; absent nullable ones become NULL.

    Key columns keep the type they have (text in production, BIGINT in fixtures).
    """
    ids = {"id", "job_id", "run_id"} if keep_ids else set()
    have = dict(df.dtypes)
    return df.select(*[
        F.lit(None).cast(kind).alias(name) if name not in have
        else F.col(name) if name in ids or have[name] == kind
        else F.col(name).cast(kind).alias(name)
        for name, kind in columns.items()])


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ddl(JOBS)).parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return conform(spark.read.schema(ddl(RUNS)).parquet(path), RUNS)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ddl(LOGS)).parquet(path)


def write_runs(runs: DataFrame, path: str, mode: str = "error") -> None:
    """One folder per status, so a query on open runs never opens finished ones.

    Rows are range-partitioned by status and queue time: a status holding most
    rows spreads over many files, each with a narrow time range to skip by.
    """
    (runs.repartitionByRange("status", "queued_at", "id")
     .sortWithinPartitions("status", "queued_at")
     .write.mode(mode).partitionBy("status").parquet(path))


def write_logs(logs: DataFrame, path: str, mode: str = "error") -> None:
    """Sorted by the paging key over range partitions: a hot run spans many files."""
    (logs.repartitionByRange("run_id", "attempt", "seq")
     .sortWithinPartitions("run_id", "attempt", "seq")
     .write.mode(mode).parquet(path))


def stream_folder(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Stream the parquet files of a table, a folder of files or one ``.parquet`` file."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if os.path.isfile(path):
        return reader.option("pathGlobFilter", os.path.basename(path)).parquet(os.path.dirname(path))
    return reader.parquet(path)
