"""Differences between two snapshots of the runs."""

from pyspark.sql import Column, DataFrame, functions as F

# What counts as a visible change. Heartbeats do not.
SHOWN = ("status", "attempt", "worker_id", "started_at", "finished_at")
RANGES = 65_536


def _range() -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(RANGES)).cast("int")


def _digests(snapshot: DataFrame, side: str) -> DataFrame:
    """One digest per range of ids, whatever the order of rows; a NULL differs from its absence."""
    shown = [x for c in ("id", *SHOWN) for x in (F.isnull(c), F.col(c))]
    return snapshot.groupBy(_range().alias("_range")).agg(F.struct(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64(*shown)), F.bit_xor(F.xxhash64(F.lit(1), *shown))).alias(side))


def run_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(id, change) with change one of added, removed, changed. Unchanged runs are left out.

    Ids are dealt by hash into ``RANGES`` ranges. Each snapshot folds to one digest a range, and only runs of
    ranges whose digests differ are shuffled and joined: with few changes nearly all runs stay where they are.
    The set of those ranges is at most ``RANGES`` numbers, so it is broadcast.
    """
    both = _digests(before, "_a").join(_digests(after, "_b"), "_range", "full")
    differ = both.filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("_range")
    shown = F.struct(*SHOWN)

    def of(snapshot: DataFrame, name: str) -> DataFrame:
        return (snapshot.select("id", shown.alias(name), _range().alias("_range"))
                .join(F.broadcast(differ), "_range", "left_semi").select("id", name))
    joined = of(before, "_old").join(of(after, "_new"), "id", "full")
    change = (F.when(F.col("_old").isNull(), F.lit("added"))
              .when(F.col("_new").isNull(), F.lit("removed"))
              .when(~F.col("_old").eqNullSafe(F.col("_new")), F.lit("changed")))
    return joined.select("id", change.alias("change")).filter(F.col("change").isNotNull())
