"""Log lines: idempotent append, batching into arrays and back."""

from pyspark.sql import DataFrame, functions as F

from runlake.config import LOG_BATCH_LINES
from runlake.operators.keys import absent_from, first_per_key
from runlake.schema import LOG_KEY, LOGS


def first_copies(lines: DataFrame, arrival=("ts", "line", "level")) -> DataFrame:
    """One copy of each (run_id, attempt, seq): the earliest by ``arrival``."""
    return first_per_key(lines, LOG_KEY, arrival)


def new_lines(existing: DataFrame, batch: DataFrame, arrival=("ts", "line", "level")) -> DataFrame:
    """The lines of ``batch`` to add: re-sent keys are ignored, the first copy wins."""
    return absent_from(first_copies(batch, arrival), existing, LOG_KEY)


def append(existing: DataFrame, batch: DataFrame, arrival=("ts", "line", "level")) -> DataFrame:
    cols = list(LOGS)
    return existing.select(*cols).unionByName(new_lines(existing, batch, arrival).select(*cols))


def to_batches(lines: DataFrame, size: int = LOG_BATCH_LINES) -> DataFrame:
    """Rows of parallel arrays, at most ``size`` distinct lines each: the bulk-insert form."""
    item = F.struct("seq", "ts", "level", "line")
    packed = (first_copies(lines)
              .groupBy("run_id", "attempt", F.floor((F.col("seq") - 1) / F.lit(size)).alias("batch_no"))
              .agg(F.array_sort(F.collect_list(item)).alias("items")))
    return packed.select("run_id", "attempt", "batch_no",
                         F.col("items.seq").alias("seqs"), F.col("items.ts").alias("times"),
                         F.col("items.level").alias("levels"), F.col("items.line").alias("texts"))


def unnest(batches: DataFrame) -> DataFrame:
    """One row per position of the parallel arrays."""
    zipped = F.arrays_zip("seqs", "times", "levels", "texts")
    return batches.select("run_id", "attempt", F.inline(zipped)).toDF(*LOGS)
