"""Storage in buckets by key, so that a batch opens what it names and no more."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BUCKETS = 16
# Segments that make one of the next level, and the filter: bitmaps of BITS bits for about KEYS_PER_BLOCK keys, PROBES bits a key.
FAN = 16
BITS, KEYS_PER_BLOCK, PROBES = 32_768, 1024, 8


def bucket_of(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n)).cast("int")


def touched(df: DataFrame, key: str, n: int) -> list[int]:
    """The buckets that ``df`` names: at most ``n`` numbers."""
    return sorted(r[0] for r in df.select(bucket_of(key, n)).distinct().collect())


class BucketedTable:
    """A table with one folder per bucket of its ``id``; a folder may hold any number of files."""

    def __init__(self, spark: SparkSession, path: str, schema, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.buckets = spark, path, schema, buckets

    @classmethod
    def write(cls, df: DataFrame, path: str, buckets: int = BUCKETS) -> "BucketedTable":
        (df.withColumn("_bucket", bucket_of("id", buckets)).hint("rebalance", "_bucket")
         .write.mode("overwrite").partitionBy("_bucket").parquet(path))
        return cls(df.sparkSession, path, df.schema, buckets)

    def read(self, ids: DataFrame | None = None) -> DataFrame:
        """All rows, or those of the buckets that hold ``ids``."""
        rows = self.spark.read.schema(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema) + ", _bucket int").parquet(self.path)
        if ids is not None:
            rows = rows.filter(F.col("_bucket").isin(touched(ids, "id", self.buckets)))
        return rows.drop("_bucket")


def _segments(upto: int) -> list[tuple[int, int]]:
    """Ranges of batches that hold all below ``upto``: at most FAN - 1 of each size."""
    found, low, size = [], 0, 1
    while size * FAN <= upto:
        size *= FAN
    while low < upto:
        while low + size > upto:
            size //= FAN
        found.append((low, low + size - 1))
        low += size
    return found


class KeyIndex:
    """The keys that earlier batches of a stream stored, with a filter for each bucket.

    Batch n adds a segment; FAN segments are merged into one of the next level, so a key is rewritten once per level
    and a batch sees few segments. A lookup reads the filters of the buckets that it names and opens only the segments' buckets
    whose filter hits. Segments are named by their batches, so a replay replaces them. The bucket follows the first key.
    """

    def __init__(self, spark: SparkSession, root: str, keys, kinds: dict[str, str], buckets: int = BUCKETS):
        self.spark, self.root, self.keys, self.kinds, self.buckets = spark, root, list(keys), kinds, buckets
        self.start = []

    def _path(self, what: str, segment: tuple[int, int]) -> str:
        return f"{self.root}/{what}/{segment[0]}-{segment[1]}"

    def _hashed(self, df: DataFrame, blocks: int) -> DataFrame:
        """Add the block of a key and its PROBES bits there."""
        first, second = F.xxhash64(F.lit(1), *self.keys), F.xxhash64(F.lit(2), *self.keys)
        step = F.pmod(F.shiftright(second, 15), F.lit(BITS // 2)) * 2 + 1
        bits = F.array(*[F.pmod(second + step * i, F.lit(BITS)) for i in range(PROBES)])
        return df.withColumn("_block", F.pmod(first, F.lit(blocks))).withColumn("_bits", bits)

    def _write(self, keys: DataFrame, segment: tuple[int, int]) -> None:
        path, schema = self._path("keys", segment), self._schema()
        (keys.select(*self.keys).withColumn("_bucket", bucket_of(self.keys[0], self.buckets)).hint("rebalance", "_bucket")
         .write.mode("overwrite").partitionBy("_bucket").parquet(path))
        rows = self.spark.read.schema(schema).parquet(path)
        count = rows.count()
        blocks = max(1, -(-count // (KEYS_PER_BLOCK * self.buckets)))
        bits = self._hashed(rows, blocks).select("_bucket", "_block", F.explode("_bits").alias("_bit"))
        filters = bits.groupBy("_bucket", "_block").agg(F.bitmap_construct_agg("_bit").alias("bits"))
        filters.write.mode("overwrite").parquet(self._path("filters", segment))
        self.spark.createDataFrame([(count, blocks)], "n bigint, blocks bigint").coalesce(1).write.mode("overwrite").parquet(self._path("sizes", segment))

    def _schema(self) -> str:
        return ", ".join(f"`{k}` {self.kinds[k]}" for k in self.keys) + ", _bucket int"

    def begin(self, keys: DataFrame) -> None:
        """Keys that were stored before the first batch."""
        self.start = [(-1, -1)]
        self._write(keys.select(*self.keys).distinct(), self.start[0])

    def add(self, keys: DataFrame, batch_id: int) -> None:
        """Store the keys of one batch, none of which is stored yet, and merge full levels."""
        self._write(keys, (batch_id, batch_id))
        size = FAN
        while (batch_id + 1) % size == 0:
            parts = [(low, low + size // FAN - 1) for low in range(batch_id + 1 - size, batch_id + 1, size // FAN)]
            whole = self.spark.read.schema(self._schema()).parquet(self._path("keys", parts[0]))
            for part in parts[1:]:
                whole = whole.unionByName(self.spark.read.schema(self._schema()).parquet(self._path("keys", part)))
            self._write(whole, (batch_id + 1 - size, batch_id))
            size *= FAN

    def hits(self, batch: DataFrame, batch_id: int) -> list[tuple[tuple[int, int], list[int]]]:
        """Per segment, the buckets whose filter may hold a key of ``batch``."""
        segments = self.start + _segments(batch_id)
        if not segments:
            return []
        named = touched(batch, self.keys[0], self.buckets)
        sizes = {s: self.spark.read.schema("n bigint, blocks bigint").parquet(self._path("sizes", s)).first() for s in segments}
        keys, found = batch.select(*self.keys).withColumn("_bucket", bucket_of(self.keys[0], self.buckets)), None
        byte = "cast(conv(hex(substring(bits, cast(p div 8 as int) + 1, 1)), 16, 10) as int)"
        for i, s in enumerate(segments):
            if not sizes[s] or not sizes[s].n:
                continue
            filters = self.spark.read.schema("_bucket int, _block bigint, bits binary").parquet(self._path("filters", s)).filter(
                F.col("_bucket").isin(named))
            may = self._hashed(keys, sizes[s].blocks).join(filters, ["_bucket", "_block"]).filter(
                F.expr(f"forall(_bits, p -> shiftright({byte}, cast(p % 8 as int)) & 1 = 1)"))
            may = may.select(F.lit(i).alias("segment"), "_bucket")
            found = may if found is None else found.unionByName(may)
        rows = found.distinct().collect() if found is not None else []  # at most segments times buckets
        return [(s, sorted(r[1] for r in rows if r[0] == i)) for i, s in enumerate(segments) if any(r[0] == i for r in rows)]

    def absent(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The rows of ``batch`` whose key no batch below ``batch_id`` stored."""
        stored = None
        for segment, buckets in self.hits(batch, batch_id):
            rows = self.spark.read.schema(self._schema()).parquet(self._path("keys", segment)).filter(F.col("_bucket").isin(buckets))
            stored = rows if stored is None else stored.unionByName(rows)
        return batch if stored is None else batch.join(stored.select(*self.keys), self.keys, "left_anti").select(*batch.columns)
