"""Heartbeat sessions: islands of heartbeats no more than ``stale_after`` apart."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from runlake.operators.transitions import seconds


def _slot(width: int) -> Column:
    micros = F.unix_micros("ts")
    return micros - F.pmod(micros, F.lit(width))


def heartbeat_sessions(heartbeats: DataFrame, stale_after: int, keys=("run_id",)) -> DataFrame:
    """(keys, session_start, last_heartbeat, reap_at, beats).

    Heartbeats of one key within a slot as wide as ``stale_after`` are always in
    one session, so a slot shrinks to its first, last and count before the
    shuffle. What is ordered per key then grows with elapsed time, not with rows.
    A gap equal to ``stale_after`` is still alive.
    """
    keys = list(keys)
    width = stale_after * 1_000_000
    slots = (heartbeats.groupBy(*keys, _slot(width).alias("_slot"))
             .agg(F.min("ts").alias("_first"), F.max("ts").alias("_last"), F.count(F.lit(1)).alias("_n")))
    order = Window.partitionBy(*keys).orderBy("_slot")
    gap = F.unix_micros("_first") - F.unix_micros(F.lag("_last").over(order))
    islands = slots.withColumn("_new", F.when(gap > width, 1).otherwise(0)).withColumn(
        "_island", F.sum("_new").over(order))
    return (islands.groupBy(*keys, "_island")
            .agg(F.min("_first").alias("session_start"), F.max("_last").alias("last_heartbeat"),
                 F.sum("_n").alias("beats"))
            .withColumn("reap_at", F.col("last_heartbeat") + seconds(stale_after)).drop("_island"))
