"""Key-based building blocks shared by the table operators.

Reductions are plain aggregates, so each map task folds its copies of a key
before the shuffle: a key holding a third of all rows reaches the reducer as one
row per map task.
"""

from pyspark.sql import Column, DataFrame, functions as F


def pinned(df: DataFrame, computed=None) -> DataFrame:
    """The same rows, with filters on the ``computed`` columns (all, if not given) kept above their computation.

    Otherwise a filter on a derived column is rewritten in terms of the scan and
    repeats the parsing it depends on, once per mention. Filters on other columns
    still reach the scan. Computed columns come last.
    """
    computed = list(df.columns if computed is None else computed)
    return df.select(*[c for c in df.columns if c not in computed], F.inline(F.array(F.struct(*computed))))


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: the first by ``order``, whose columns must fix a total order of distinct rows."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*order, *rest)
    return (df.groupBy(*keys).agg(F.min(packed).alias("_first"))
            .select(*keys, "_first.*").select(*df.columns))


def absent_from(batch: DataFrame, existing: DataFrame, keys) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing``.

    The stored keys are first cut down to those the batch mentions. A batch far
    smaller than the table then turns into a filter on the table's scan instead
    of a shuffle of the table.
    """
    keys = list(keys)
    seen = existing.select(*keys).join(batch.select(*keys), keys, "left_semi")
    return batch.join(seen, keys, "left_anti").select(*batch.columns)


def overwrite(df: DataFrame, hit: Column, values: dict[str, Column]) -> DataFrame:
    """Set ``values`` on rows where ``hit`` is true; all expressions see the old row."""
    kinds = dict(df.dtypes)
    return df.select(*[
        F.when(hit, values[c].cast(kinds[c])).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in df.columns])


def update_from(table: DataFrame, picked: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """Update rows whose ``key`` is in ``picked``; others pass through unchanged.

    ``picked`` has one row per key. Its other columns may be used in ``values``.
    """
    cols = table.columns
    marked = table.join(picked.withColumn("_hit", F.lit(True)), key, "left")
    return overwrite(marked, F.col("_hit"), values).select(*cols)


def count_per_key(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, name: str) -> DataFrame:
    """Number of child rows for every parent; children are counted before the join."""
    counts = children.groupBy(F.col(child_key).alias(parent_key)).agg(F.count(F.lit(1)).alias(name))
    return (parents.select(parent_key).join(counts, parent_key, "left")
            .withColumn(name, F.coalesce(name, F.lit(0).cast("bigint"))))
