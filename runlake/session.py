"""Session settings the operators rely on, and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. The skew settings make adaptive execution split a hot
# join key over many tasks even where that costs one more shuffle.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.sql.parquet.filterPushdown": "true",
}

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    A machine-local folder is used only where none is set and Spark itself runs
    on one machine; elsewhere a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="runlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str, *partitions: str) -> DataFrame:
    """Write ``df`` to the shared folder, by folders of ``partitions``, and read it back, cutting its lineage.

    The exchanges of the write are its own, so their files go with it, not when the driver happens to collect its garbage.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession, purpose)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.partitionBy(*partitions).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
