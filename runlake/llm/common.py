"""Shared parts: text bytes in numpy, word and shingle hashes, connected components."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from runlake.session import materialize

# Bytes of text that a Python worker handles at once; a longer document is one chunk of its own.
CHUNK_BYTES = 1 << 20
ARROW_ROWS = 500

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def arrow_friendly(spark):
    """Small Arrow batches, so that very long texts don't add up in a worker; hot join keys are split."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x = x ^ (x >> np.uint64(29))
    x = x * _M2
    return x ^ (x >> np.uint64(32))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column, NULL as empty, and the offset of every row."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Row ranges of at most ``limit`` bytes, or of one row."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, min(high, n)
        low = high


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of texts with A-Z lowered, as 64-bit hashes.

    A word's hash is a polynomial over random byte values, taken as a difference
    of running sums, so a chunk costs a few array passes whatever its words.
    """

    def __init__(self, lower: bool = True):
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True
        values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
        self.value = values.copy()
        if lower:
            self.value[65:91] = values[97:123]
        self.power = self.inverse = np.zeros(0, np.uint64)

    def _grow(self, n: int):
        if len(self.power) < n:
            self.power = np.cumprod(np.full(n, _BASE, np.uint64))
            self.inverse = np.cumprod(np.full(n, _INVERSE, np.uint64))

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """First byte, end byte, row and hash of every word, in text order."""
        n = len(data)
        if not n:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
        self._grow(n + 1)
        inside = ~self.space[data]
        first = np.zeros(n + 1, bool)
        first[offsets[:-1]] = True  # rows are apart
        starts = np.flatnonzero(inside & (first[:n] | np.concatenate(([True], ~inside[:-1]))))
        last = np.ones(n, bool)
        last[:-1] = ~inside[1:] | first[1:n]
        ends = np.flatnonzero(inside & last) + 1
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.value[data] * self.power[:n])))
        hashes = mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        rows = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
        return starts, ends, rows, hashes


def shingle_sets(hashes: np.ndarray, rows: np.ndarray, n_rows: int, k: int):
    """The distinct k-word shingles of every row, as (row, hash) sorted by both, and their number per row.

    A row of fewer than k words has its whole word sequence as one shingle; one
    without words has none.
    """
    odd = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    counts = np.bincount(rows, minlength=n_rows)
    at = np.arange(max(0, len(hashes) - k + 1))
    at = at[rows[at] == rows[at + k - 1]] if len(at) else at
    full = np.zeros(len(at), np.uint64)
    for j in range(k):
        full += hashes[at + j] * odd[j]
    first = np.concatenate(([0], np.cumsum(counts)[:-1])) if n_rows else np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    whole = np.zeros(len(short), np.uint64)
    for j in range(k - 1):
        has = counts[short] > j
        whole[has] += hashes[first[short[has]] + j] * odd[j]
    found = mix(np.concatenate((full + np.uint64(k), whole + counts[short].astype(np.uint64))))
    where = np.concatenate((rows[at], short)).astype(np.int64)
    order = np.lexsort((found, where))
    found, where = found[order], where[order]
    if len(found):
        new = np.concatenate(([True], (found[1:] != found[:-1]) | (where[1:] != where[:-1])))
        found, where = found[new], where[new]
    return where, found, np.bincount(where, minlength=n_rows)


def starts_of(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins in sorted columns."""
    change = np.zeros(len(columns[0]), bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge.

    Alternates the large-star and small-star steps of connected components: each
    replaces edges by edges to smaller nodes and never adds any, and the number of
    rounds follows the logarithm of a component's diameter. A node's neighbours are
    only ever reduced to their minimum, so a node with very many is no large group.
    Each round is a table in the shared folder.
    """
    def pairs(df, u, v):
        return df.filter(F.col(u) != F.col(v)).select(
            F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()

    def state(df):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()

    now = materialize(pairs(edges, a, b), "edges")
    seen = state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = materialize(both.filter("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        now = materialize(pairs(small.select(F.col("v").alias("x"), F.col("m").alias("y")).unionByName(
            least.select(F.col("u").alias("x"), F.col("m").alias("y"))), "x", "y"), "edges")
        before, seen = seen, state(now)
        if before == seen:
            break
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
