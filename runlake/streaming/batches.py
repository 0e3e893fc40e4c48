"""Running streams to a folder of results.

Each micro-batch writes the folder named after its number, replacing what an
interrupted earlier try of it left there, so replays change nothing.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from runlake.session import shared_dir
from runlake.streaming.buckets import BucketedTable

COMPACT_EVERY = 16
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_store(spark: SparkSession) -> None:
    """Keyed state with timers needs the RocksDB store; the session keeps this setting."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def batch_dir(root: str, batch_id: int) -> str:
    return f"{root}/batch={batch_id}"


def write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(batch_dir(root, batch_id))


def schema_of(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


def read_batches(spark: SparkSession, root: str, schema, before: int | None = None, after: int = -1) -> DataFrame:
    """Everything written under ``root``, or only by the batches between ``after`` and ``before``.

    With ``before`` the folders are named, not listed: every batch below it has written one.
    """
    reader = spark.read.schema(f"{schema}, batch bigint").option("basePath", root)
    if before is None:
        return reader.parquet(root)
    folders = [batch_dir(root, n) for n in range(after + 1, before)]
    return reader.parquet(*folders) if folders else spark.createDataFrame([], f"{schema}, batch bigint")


def _base_dir(root: str, upto: int) -> str:
    return f"{root}-base/upto={upto}"


def _newest(versions: DataFrame, columns: list[str]) -> DataFrame:
    rest = [c for c in columns if c != "id"]
    return versions.groupBy("id").agg(F.max(F.struct("batch", *rest)).alias("_v")).select("id", "_v.*")


def _changes(spark: SparkSession, root: str, schema: str, batch_id: int) -> DataFrame:
    """Changed rows of the batches below ``batch_id``: the last compacted ones and those after."""
    upto = batch_id // COMPACT_EVERY * COMPACT_EVERY - 1
    tail = read_batches(spark, root, schema, batch_id, max(upto, -1))
    if upto < 0:
        return tail
    return tail.unionByName(spark.read.schema(f"{schema}, batch bigint").parquet(_base_dir(root, upto)))


def write_changes(df: DataFrame, root: str, batch_id: int) -> None:
    """As ``write_batch``, for changed rows that ``latest`` reads.

    Every ``COMPACT_EVERY`` batches the newest version of each changed row is written
    beside them, so a batch reads that and at most ``COMPACT_EVERY`` folders, however
    many came before.
    """
    write_batch(df, root, batch_id)
    if (batch_id + 1) % COMPACT_EVERY == 0:
        spark, schema = df.sparkSession, schema_of(df)
        past = _changes(spark, root, schema, batch_id).unionByName(read_batches(spark, root, schema, batch_id + 1, batch_id - 1))
        _newest(past, df.columns).select(*df.columns, "batch").write.mode("overwrite").parquet(_base_dir(root, batch_id))


def latest(start: DataFrame | BucketedTable, root: str, batch_id: int | None = None, ids: DataFrame | None = None) -> DataFrame:
    """The newest version of each row of ``start``, given the changed rows each batch wrote.

    With ``ids`` only those rows are looked at, and of a bucketed table only their buckets. Batches from ``batch_id`` on are left out.
    """
    start = start.read(ids) if isinstance(start, BucketedTable) else start
    versions = start.withColumn("batch", F.lit(-1).cast("bigint"))
    schema = schema_of(start)
    if batch_id is None:
        versions = versions.unionByName(read_batches(start.sparkSession, root, schema))
    elif batch_id > 0:
        versions = versions.unionByName(_changes(start.sparkSession, root, schema, batch_id))
    if ids is not None:
        versions = versions.join(ids, "id", "left_semi")
    return _newest(versions, start.columns).select(*start.columns)


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], purpose: str) -> None:
    """Process all available input once, batch by batch."""
    (stream.writeStream.foreachBatch(each)
     .option("checkpointLocation", shared_dir(stream.sparkSession, f"{purpose}-progress"))
     .trigger(availableNow=True).start().awaitTermination())
