"""Dispatch messages: decoding, encoding, and the Kafka end points."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from runlake.config import DISPATCH_TOPIC
from runlake.functions import strict_json
from runlake.operators.keys import pinned

_MEMBERS = "run_id variant, job_id variant, job_type variant, attempt bigint"


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add run_id, job_id, job_type, attempt and ``reject_reason`` (NULL for a good message).

    Members beyond these are allowed; absent ones are empty or zero. ``attempt`` is a
    BIGINT, as a message may hold any; it is compared, never narrowed.
    """
    df = messages.withColumn("_m", strict_json.read_whole(F.col(value), _MEMBERS))
    d = F.col("_m.d")
    sound = strict_json.is_whole(F.col(value), F.col("_m")) & (
        d.isNotNull() | (F.trim(F.col(value)) == "null"))
    for name in ("run_id", "job_id", "job_type"):
        sound = sound & strict_json.is_text(d[name])
    df = df.withColumn("_sound", F.coalesce(sound, F.lit(False)))

    def text(name: str) -> Column:
        return F.coalesce(strict_json.text_of(d[name]), F.lit(""))

    reason = (F.when(~F.col("_sound"), F.lit("decode dispatch: invalid message"))
              .when(text("run_id") == "", F.lit("decode dispatch: missing run_id")))
    df = df.withColumn("reject_reason", reason)
    good = F.col("reject_reason").isNull()
    for name in ("run_id", "job_id", "job_type"):
        df = df.withColumn(name, F.when(good, text(name)))
    df = df.withColumn("attempt", F.when(good, F.coalesce(d["attempt"], F.lit(0))))
    return pinned(df.drop("_m", "_sound"), ["run_id", "job_id", "job_type", "attempt", "reject_reason"])


def split(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good messages, dead letters)."""
    bad = F.col("reject_reason").isNotNull()
    return (decoded.filter(~bad).drop("reject_reason"),
            decoded.filter(bad).drop("run_id", "job_id", "job_type", "attempt"))


def encode(dispatches: DataFrame) -> DataFrame:
    """(key, value) messages from rows of run_id, job_id, job_type, attempt."""
    body = F.struct(F.col("run_id").cast("string").alias("run_id"),
                    F.col("job_id").cast("string").alias("job_id"), "job_type", "attempt")
    return dispatches.select(F.col("run_id").cast("string").alias("key"), F.to_json(body).alias("value"))


def read_kafka(spark: SparkSession, brokers: str, topic: str = DISPATCH_TOPIC) -> DataFrame:
    """Streaming (offset_no, partition_no, arrived_at, value); needs the Kafka connector on the class path."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers)
           .option("subscribe", topic).option("startingOffsets", "earliest").load())
    return raw.select(F.col("offset").alias("offset_no"), F.col("partition").alias("partition_no"),
                      F.col("timestamp").alias("arrived_at"), F.col("value").cast("string").alias("value"))


def write_kafka(messages: DataFrame, brokers: str, partitions: int, topic: str = DISPATCH_TOPIC) -> None:
    """Publish (key, value). Messages are spread over the topic, not hashed by key:

    a requeued run must not land where its dead worker was reading.
    """
    (messages.repartition(partitions)
     .withColumn("partition", F.pmod(F.monotonically_increasing_id(), F.lit(partitions)).cast("int"))
     .write.format("kafka").option("kafka.bootstrap.servers", brokers)
     .option("kafka.acks", "all").option("topic", topic).save())
