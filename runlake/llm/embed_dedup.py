"""Embedding near-dedup by a pivot-permutation index.

A vector is described by its ``NEAREST`` nearest of ``PIVOTS`` reference points, nearest
first. Close vectors rank the pivots alike. Inverted lists are kept per label and *triple* of a
vector's nearest pivots: two vectors meet in C(s, 3) lists if they share s pivots, so
they meet at all exactly if the shared-pivot count is 3 or more. What meets is
verified by cosine in double precision; nothing is capped.

A list is worked through in blocks of about ``BLOCK`` vectors, two blocks at a time, by
matrix products: no pair of vectors is ever a row. Short lists share tasks. By chance two unrelated vectors of
a label meet with probability near C(8, 3)^2 / C(``PIVOTS``, 3); more rows call for more pivots. A pair that
meets in several lists counts once, as every list counts it in inverse proportion to
C(s, 3), in whole numbers. For each product only the vectors with links come back, with
their link counts and the smallest vector of their component inside it.

Pivots are chosen from a sample of ``SAMPLE`` vectors, those with the smallest hash of
``vec_id``, so that they lie well apart around the sample's mean; seeded random directions
fill up. The sample alone reaches the driver. Every vector is indexed. Recall is below 1 only for pairs whose nearest pivots
differ much; see the README for figures against brute force.

Defined cases: equal vectors of a label are one entry with a count and are linked with
each other. A vector that is NULL, zero or holds NULL or non-finite components, and one without
label or ``vec_id``, links with nothing; vectors of different lengths don't link. Rows that repeat a
``vec_id`` are vectors of their own. Further columns are ignored. An empty table gives an empty result.
"""

from itertools import combinations
from math import comb, lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from runlake.llm.common import arrow_friendly, components, starts_of
from runlake.session import materialize

PIVOTS, NEAREST, SHARED = 1024, 8, 3
SAMPLE, APART = 2048, 0.6
BLOCK, TASK_ROWS = 512, 4096


def _matrix(column) -> np.ndarray:
    """Vectors of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def choose_pivots(sample: np.ndarray, n: int = PIVOTS) -> tuple[np.ndarray, np.ndarray]:
    """The centre of a sample and ``n`` unit pivots around it that lie well apart.

    Pivots inside one dense crowd would rank at random among its vectors, so a
    candidate near a chosen pivot is passed over. Random directions fill up.
    """
    dim = sample.shape[1]
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    centre = unit.mean(0) if len(unit) else np.zeros(dim)
    away = unit - centre
    size = np.linalg.norm(away, axis=1)
    away = away[size > 1e-9] / size[size > 1e-9, None]
    pivots, k = np.random.default_rng((3, dim)).normal(size=(n, dim)), 0
    pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
    for p in away:
        if k < n and (not k or (pivots[:k] @ p).max() < APART):
            pivots[k] = p
            k += 1
    return centre, pivots


def nearest_pivots(vectors: np.ndarray, centre: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Numbers of each vector's nearest pivots, nearest first."""
    unit = vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))
    far = -((unit - centre) @ pivots.T)
    near = np.argpartition(far, NEAREST, axis=1)[:, :NEAREST]
    return np.take_along_axis(near, np.argsort(np.take_along_axis(far, near, 1), axis=1, kind="stable"), 1).astype(np.int32)


def sample_vectors(vectors: DataFrame, n: int = SAMPLE) -> dict[int, np.ndarray]:
    """By dimension, the ``n`` of ``vectors`` (vec_id, vec) with the smallest hash of their id."""
    found = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).select("vec").toArrow().column(0).to_pylist()
    by_size: dict[int, list] = {}
    for v in found:
        by_size.setdefault(len(v), []).append(v)
    return {d: np.array(v, float) for d, v in by_size.items()}


def _describe(sample):
    chosen = {dim: choose_pivots(v) for dim, v in sample.items()}

    def run(batches):
        ready = dict(chosen)
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            for dim in np.unique(sizes).tolist():
                at = pa.array(np.flatnonzero(sizes == dim))
                if dim not in ready:
                    ready[dim] = choose_pivots(np.zeros((0, dim)))
                near = nearest_pivots(_matrix(batch.column(1).take(at)), *ready[dim])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(near) + 1) * NEAREST, pa.int32()), pa.array(near.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), lists], ["rep", "pivots"])
    return run


def _components(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id reachable in a boolean matrix of links."""
    label = ids.copy()
    while len(ids):
        low = np.minimum(label, np.where(linked, label[None, :], label[:, None]).min(1))
        if (low == label).all():
            break
        label = low
    return label


def _compare(at_least: float):
    weights = np.array([0] * SHARED + [lcm(*(comb(s, SHARED) for s in range(SHARED, NEAREST + 1))) // comb(s, SHARED)
                                       for s in range(SHARED, NEAREST + 1)])

    def within(block, whole, n, ids, pivots, x):
        """Links inside one list, or between two of its blocks: rows, shares, components."""
        linked = x @ x.T >= at_least  # rows of x have length 1
        np.fill_diagonal(linked, False)
        if not whole:  # pairs within a block are met where it is paired with itself
            linked &= block[:, None] != block[None, :]
        keep = np.flatnonzero(linked.any(1))
        if not len(keep):
            return keep, keep, keep
        linked, pivots = linked[np.ix_(keep, keep)], pivots[keep]
        _, codes = np.unique(pivots, return_inverse=True)
        has = np.zeros((len(keep), codes.max() + 1), np.float32)
        has[np.arange(len(keep))[:, None], codes.reshape(pivots.shape)] = 1
        shared = np.rint(has @ has.T).astype(int)
        return keep, np.where(linked, weights[shared], 0) @ n[keep], _components(linked, ids[keep])

    def links(table: pa.Table) -> pa.Table:
        """``table``: rows of some lists (key, i, j, block, rep, n, pivots, vec). Out: rep, share of links, component."""
        key, i, j = (table.column(c).to_numpy() for c in ("key", "i", "j"))
        order = np.lexsort((j, i, key))
        table = table.take(pa.array(order)).combine_chunks()
        key, i, j, block, ids, n = (table.column(c).to_numpy() for c in ("key", "i", "j", "block", "rep", "n"))
        vectors = table.column("vec").combine_chunks()
        values, ends = vectors.flatten().to_numpy(zero_copy_only=False).astype(float), np.concatenate(
            ([0], np.cumsum(vectors.value_lengths().to_numpy())))
        pivots = _matrix(table.column("pivots").combine_chunks()).astype(int)
        begins = starts_of(key, i, j)
        rows, shares, lows = [], [], []
        for low, high in zip(begins.tolist(), [*begins[1:].tolist(), len(key)]):
            x = values[ends[low]:ends[high]].reshape(high - low, -1)
            x = x / np.sqrt((x * x).sum(1, keepdims=True))
            keep, share, label = within(block[low:high], i[low] == j[low], n[low:high], ids[low:high], pivots[low:high], x)
            rows.append(ids[low + keep])
            shares.append(share)
            lows.append(label)
        return pa.table({c: pa.array(np.concatenate(v).astype(np.int64)) for c, v in (("rep", rows), ("share", shares), ("low", lows))})
    return links, int(weights[SHARED])


def link_vectors(vectors: DataFrame, at_least: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label)."""
    arrow_friendly(vectors.sparkSession)
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("vec"))
    good = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.forall(
        "vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("vec", lambda c: c != 0), F.lit(False))
    marks = ["label", "mark_a", "mark_b"]
    rows = materialize(v.select("vec_id", "label", "vec", good.alias("good"), F.xxhash64("vec").alias("mark_a"),
                                F.xxhash64(F.lit(1), "vec").alias("mark_b"), F.size("vec").alias("dim")), "vectors")
    classes = materialize(rows.filter("good").groupBy(*marks).agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n")).withColumn("rep", F.monotonically_increasing_id()), "classes")
    reps = rows.filter("good").join(classes, marks).filter("vec_id = first").dropDuplicates(["rep"])
    reps = materialize(reps.select("rep", "label", "dim", "n", "vec"), "vectors")

    described = reps.select("rep", "vec").mapInArrow(
        _describe(sample_vectors(rows.filter("good").select("vec_id", "vec"))), "rep long, pivots array<int>")
    described = materialize(described, "pivots")
    nearest = F.sort_array("pivots")
    triples = F.array(*[F.xxhash64("label", "dim", *[F.get(nearest, i) for i in c]) for c in combinations(range(NEAREST), SHARED)])
    lists = materialize(described.join(reps.select("rep", "label", "dim"), "rep").select("rep", F.explode(triples).alias("key")), "lists")
    long = lists.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").withColumn(
        "blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    entries = materialize(lists.join(long, "key").select("rep", "key", "blocks"), "lists")
    entries = entries.withColumn("block", F.pmod(F.xxhash64("rep", "key"), F.col("blocks")).cast("int"))
    # Lists of one block share tasks; a longer one has a task for each pair of its blocks.
    short = entries.filter("blocks = 1").count()
    shared = F.pmod(F.xxhash64("key"), F.lit(max(1, short // TASK_ROWS)))
    entries = entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    entries = entries.select("rep", "key", "blocks", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    entries = entries.withColumn("task", F.when(F.col("blocks") == 1, shared).otherwise(F.xxhash64("key", "i", "j")))
    entries = entries.drop("blocks").join(described, "rep").join(reps.select("rep", "n", "vec"), "rep")
    compare, unit = _compare(at_least)
    met = materialize(entries.groupBy("task").applyInArrow(compare, "rep long, share long, low long"), "links")

    first_of = classes.select("rep", "first")
    edges = met.select("rep", "low").distinct().join(first_of, "rep").join(
        first_of.select(F.col("rep").alias("low"), F.col("first").alias("low_first")), "low")
    # Components run over the smallest vec_id of each class.
    tops = components(edges, "first", "low_first").select(F.col("node").alias("first"), F.col("component").alias("top"))
    counts = met.groupBy("rep").agg((F.sum("share") / unit).cast("long").alias("links"))
    info = classes.join(counts, "rep", "left").join(tops, "first", "left").select(
        *marks, (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("top", "first").alias("top"))
    linked = rows.filter("good").join(info, marks).select("vec_id", "n_links", F.col("top").alias("component_id"))
    alone = rows.filter("NOT good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
