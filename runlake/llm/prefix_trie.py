"""Conversation prefix trie: one row for every distinct sequence of first turns, with totals of its subtree.

A conversation's prefixes are named by 128-bit rolling hashes. A node belongs to the smallest
conversation that starts with it, so (conv_id, depth) names a node, and what one conversation owns is
a path that ends with its last turn.

Subtree totals come from time-forward processing. A shard's nodes are sorted by reverse level order
(Spark's external sort); each node takes the messages for it from a priority queue, which spills sorted
runs, adds its own share and sends the total to its parent. Shards hold whole subtrees: a
node is light if the turns that its members have from it on are at most ``LIGHT``, and the topmost light
node of a path is the root of a shard. What shards send to the heavy nodes above them is summed by Spark.
Heavy nodes are processed likewise, in bands of ``BAND`` levels: bands are summed by their roots, the tree of
the roots is solved first (again in bands while it is large), and its totals are messages to the bands above.
So neither a crowd that shares its first turns nor one endless conversation is handled by one task.

``ends_sha256`` hashes the ids of the conversations that end at a node. The hash is serial by
definition; ids are sorted and packed in parallel and then streamed through it, never gathered.

Defined cases: turns are ordered by ``turn`` (NULL first), then role and text; every row is a turn, repeated
ones too. NULL roles and texts are empty. Rows without ``conv_id`` are no conversation. Without
conversations there is no root: an empty table gives an empty result. Further columns are ignored.
"""

import hashlib
import heapq
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from runlake.session import materialize

LIGHT = 1 << 14  # turns below the root of a shard, counted for every member
BAND = 64  # levels of heavy nodes in one shard
ONE_SHARD = 100_000  # heavy nodes that one task handles without bands
QUEUE_ROWS = 200_000  # messages in memory
STRETCH = 4096  # turns whose rolling hashes are made by one window
PACK = 4096  # ids in one packed text

TOTALS = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def ordered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, x, y, bytes) of every turn, numbered from 1, and (conv_id, n) of every conversation.

    ``x`` and ``y`` are hashes of role and text.
    """
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32)).sortWithinPartitions("conv_id", "turn", "role", "text")
    placed = materialize(rows.select(
        "conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), F.xxhash64("role", "text").alias("x"),
        F.xxhash64(F.lit(1), "role", "text").alias("y"), F.octet_length("text").cast("long").alias("bytes")), "turns")
    parts = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = materialize(parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "turns")
    numbered = placed.join(parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("at") - F.col("first") + F.col("before") + 1).alias("pos"), "x", "y", "bytes")
    return numbered, parts.groupBy("conv_id").agg(F.sum("n").alias("n"))


def spliced(turns: DataFrame, sizes: DataFrame, base: Column, shared: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``shared`` (at most ``most``) turns are those of conversation ``base`` instead.

    ``base`` and ``shared`` are expressions over ``conv_id``. Takes and returns what ``ordered`` returns.
    """
    plan = sizes.select("conv_id", "n", base.alias("base"), shared.alias("h"))
    held = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("held"))
    plan = plan.join(held, "base", "left").withColumn("head", F.least("h", F.coalesce("held", F.lit(0))))
    plan = materialize(plan.select("conv_id", "base", "h", "head", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n")), "plan")
    heads = turns.filter(F.col("pos") <= most).withColumnRenamed("conv_id", "base").join(
        plan.select("base", "conv_id", "head"), "base").filter("pos <= head").select("conv_id", "pos", "x", "y", "bytes")
    tails = turns.join(plan.select("conv_id", "h", "head"), "conv_id").filter("pos > h").select(
        "conv_id", (F.col("head") + F.col("pos") - F.col("h")).alias("pos"), "x", "y", "bytes")
    return heads.unionByName(tails), plan.select("conv_id", "n")


def _prefixes(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, bytes, n): the hashes of every prefix of a conversation of ``n`` turns."""
    turn = ["pos", "x", "y"]
    own = turns.select("conv_id", "pos", F.floor((F.col("pos") - 1) / STRETCH).alias("stretch"), F.xxhash64(*turn).alias("a"),
                       F.xxhash64(F.lit(2), *turn).alias("b"), "bytes")
    here = Window.partitionBy("conv_id", "stretch").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = materialize(own.select("conv_id", "stretch", F.col("pos").alias("depth"), *[F.bit_xor(c).over(here).alias(c) for c in "ab"], "bytes"), "prefixes")
    ends = rolled.groupBy("conv_id", "stretch").agg(F.max(F.struct("depth", "a", "b")).alias("e"))
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("conv_id", "stretch", *[F.bit_xor(f"e.{c}").over(earlier).alias(f"{c}0") for c in "ab"]).filter("stretch > 0")
    return rolled.join(ends, ["conv_id", "stretch"], "left").join(sizes, "conv_id").select(
        "conv_id", "depth", *[F.col(c).bitwiseXOR(F.coalesce(f"{c}0", F.lit(0))).alias(c) for c in "ab"], "bytes", "n")


class Queue:
    """A priority queue of integer tuples that keeps ``most`` in memory and the rest as sorted runs on disk."""

    def __init__(self, width: int, most: int = QUEUE_ROWS):
        self.width, self.most, self.heap, self.runs, self.n_runs = width, most, [], [], 0

    def push(self, item: tuple):
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            f = tempfile.TemporaryFile()
            f.write(np.array(sorted(self.heap), np.int64).tobytes())
            f.seek(0)
            run = self._read(f)
            heapq.heappush(self.runs, (next(run), self.n_runs, run))
            self.heap, self.n_runs = [], self.n_runs + 1

    def _read(self, f):
        with f:
            while data := f.read(self.width * 8 * 1024):
                yield from map(tuple, np.frombuffer(data, np.int64).reshape(-1, self.width).tolist())

    def take(self, *key):
        """All items that begin with ``key``, which none in the queue precedes."""
        k = len(key)
        while self.heap and self.heap[0][:k] == key:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:k] == key:
            item, i, run = self.runs[0]
            following = next(run, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, i, run))
            yield item


def _climb(most):
    def run(batches):
        queue = Queue(4, most)
        for batch in batches:
            ids, depths, parents, steps, convs, roots, children, leaves, saved = (c.to_pylist() for c in batch.columns)
            for i, node in enumerate(ids):
                depth = depths[i]
                for _, _, under, cost in queue.take(-depth, node):
                    children[i] += 1
                    leaves[i] += under
                    saved[i] += cost
                if not leaves[i]:
                    leaves[i] = 1
                if not roots[i]:
                    queue.push((steps[i] - depth, parents[i], leaves[i], saved[i]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], batch.column(4), *(pa.array(c, pa.int64()) for c in (children, leaves, saved))],
                ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"])
    return run


def climb(nodes: DataFrame, step: int = 1) -> DataFrame:
    """Totals of nodes that lie in shards: (conv_id, depth, parent_conv_id, n_convs, root_id, root_depth, n_children, n_leaves, saved_tokens).

    The last three are what a node has before its children in the same shard report; a parent is ``step`` levels up.
    """
    rows = nodes.repartition("root_depth", "root_id").sortWithinPartitions(F.desc("depth"), "conv_id").select(
        "conv_id", "depth", "parent_conv_id", F.lit(step).cast("long").alias("step"), "n_convs",
        ((F.col("depth") == F.col("root_depth")) & (F.col("conv_id") == F.col("root_id"))).alias("root"), "n_children", "n_leaves", "saved_tokens")
    return rows.mapInArrow(_climb(QUEUE_ROWS), TOTALS)


def _sent(totals: DataFrame, step: int = 1) -> DataFrame:
    """What parents get from ``totals``, summed: (conv_id, depth, children, leaves, saved)."""
    return totals.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - step).alias("depth")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))


def _plus(nodes: DataFrame, sent: DataFrame) -> DataFrame:
    got = nodes.join(sent, ["conv_id", "depth"], "left")
    for own, more in (("n_children", "children"), ("n_leaves", "leaves"), ("saved_tokens", "saved")):
        got = got.withColumn(own, F.col(own) + F.coalesce(more, F.lit(0)))
    return got.drop("children", "leaves", "saved")


def _heavy(nodes: DataFrame, marks: DataFrame, root: int, step: int, band: int, most: int) -> DataFrame:
    """Totals of a tree whose nodes lie ``step`` levels apart, band by band.

    ``marks`` (conv_id, depth, owner) names the node of a conversation's prefix at every ``band``-th depth.
    """
    seen = nodes.agg(F.count(F.lit(1)), F.max("depth")).first()
    if seen[0] <= most or seen[1] < step * band:
        return climb(nodes.withColumn("root_id", F.lit(root)).withColumn("root_depth", F.lit(0).cast("long")), step)

    def owner(df: DataFrame, depth: Column, name: str) -> DataFrame:
        """``name``: the node of the conversation's own prefix at ``depth``."""
        got = df.withColumn("at", depth).join(marks.select("conv_id", F.col("depth").alias("at"), "owner"), ["conv_id", "at"], "left")
        return got.withColumn(name, F.when(F.col("at") == 0, F.lit(root)).otherwise(F.col("owner"))).drop("at", "owner")
    wide = step * band
    sharded = owner(nodes, F.col("depth") - F.col("depth") % wide, "root_id").withColumn("root_depth", F.col("depth") - F.col("depth") % wide)
    sharded = materialize(sharded, "bands")
    bands = sharded.groupBy(F.col("root_id").alias("conv_id"), F.col("root_depth").alias("depth")).agg(
        F.sum("n_convs").alias("n_convs"), F.lit(0).cast("long").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    bands = materialize(owner(bands, F.greatest(F.col("depth") - wide, F.lit(0)), "parent_conv_id"), "bands")
    solved = materialize(_heavy(bands, marks, root, wide, band, most), "bands")
    below = solved.filter("depth > 0").drop("parent_conv_id").join(nodes.select("conv_id", "depth", "parent_conv_id"), ["conv_id", "depth"])
    return climb(_plus(sharded, _sent(below, step)), step)


def _pack(batches):
    """Runs of sorted ids of one node, as texts."""
    def text(key, ids):
        return (*key, ids[0], ",".join(map(str, ids)))

    def rows():
        key, ids = None, []
        for batch in batches:
            for *k, c in zip(*(x.to_pylist() for x in batch.columns)):
                if k != key or len(ids) == PACK:
                    if ids:
                        yield text(key, ids)
                    key, ids = k, []
                ids.append(c)
        if ids:
            yield text(key, ids)
    yield from _batches(rows(), [("conv_id", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())], 256)


def _digest(batches):
    """One hash a node over its texts in order."""
    def rows():
        key, sha = None, None
        for batch in batches:
            for *k, ids in zip(*(x.to_pylist() for x in batch.columns)):
                if k != key:
                    if key:
                        yield (*key, sha.hexdigest())
                    key, sha = k, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
        if key:
            yield (*key, sha.hexdigest())
    yield from _batches(rows(), [("conv_id", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())], 4096)


def _batches(rows, schema, size):
    schema, held = pa.schema(schema), []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) over the sorted ``member`` ids of ``ends`` (conv_id, depth, member)."""
    keys = ["conv_id", "depth", "member"]
    packed = ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(
        _pack, "conv_id long, depth long, first long, ids string")
    packed = packed.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first").select("conv_id", "depth", "ids")
    return packed.mapInArrow(_digest, "conv_id long, depth long, ends_sha256 string")


def build(turns: DataFrame, sizes: DataFrame, light: int = LIGHT, band: int = BAND, one_shard: int = ONE_SHARD) -> DataFrame:
    """All nodes of the conversations that ``ordered`` or ``spliced`` return.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)
    """
    spark = turns.sparkSession
    root, n_convs = sizes.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    if not n_convs:
        return spark.createDataFrame([], f"{TOTALS}, ends_sha256 string")
    prefixes = materialize(_prefixes(turns, sizes), "prefixes")
    named = materialize(prefixes.groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("n") - F.col("depth") + 1).alias("weight")), "nodes")
    members = materialize(prefixes.join(named, ["depth", "a", "b"]).select("conv_id", "depth", "n", "bytes", "owner", "n_convs", "weight"), "members")

    own, at = F.col("owner") == F.col("conv_id"), F.struct("depth", "owner")
    paths = materialize(members.groupBy("conv_id").agg(
        F.min(F.when(own, F.col("depth"))).alias("from"), F.max(F.when(~own, at)).alias("before"),
        F.min(F.when(F.col("weight") <= light, at)).alias("top")), "paths")
    nodes = materialize(members.filter(own).join(paths, "conv_id").select(
        "conv_id", "depth", F.when(F.col("depth") > F.col("from"), F.col("conv_id")).otherwise(
            F.coalesce("before.owner", F.lit(root))).alias("parent_conv_id"), "n_convs", F.col("top.owner").alias("root_id"),
        F.col("top.depth").alias("root_depth"), F.lit(0).cast("long").alias("n_children"), F.lit(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"), (F.col("weight") <= light).alias("light")), "nodes")

    low = materialize(climb(nodes.filter("light")), "totals")
    top = spark.createDataFrame([(root, 0, None, n_convs, 0, 0, 0)], TOTALS)
    high = nodes.filter("NOT light").select(*top.columns).unionByName(top)
    tops = low.join(nodes.filter("light AND conv_id = root_id AND depth = root_depth").select("conv_id", "depth"), ["conv_id", "depth"])
    has = F.count(F.lit(1)).alias("inside")
    inside = high.filter("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(has)
    high = _plus(high, _sent(tops)).join(inside, ["conv_id", "depth"], "left")
    high = high.withColumn("n_leaves", F.when(F.col("n_children") + F.coalesce("inside", F.lit(0)) == 0, 1).otherwise(F.col("n_leaves")))
    marks = members.filter((F.col("weight") > light) & (F.col("depth") % band == 0)).select("conv_id", "depth", "owner")
    totals = low.unionByName(_heavy(materialize(high.drop("inside"), "nodes"), marks, root, 1, band, one_shard))

    ends = members.filter("depth = n").select(F.col("owner").alias("conv_id"), "depth", F.col("conv_id").alias("member")).unionByName(
        sizes.filter("n = 0").select(F.lit(root).alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.col("conv_id").alias("member")))
    empty = F.lit(hashlib.sha256().hexdigest())
    return totals.join(digests(ends), ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", empty))


# Of conversations spliced as query op12_prefix_trie does; the checksum is computed bit by bit.
SQL = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
    {'r': coalesce(role, ''), 't': coalesce(text, '')} AS turn
  FROM conversations WHERE conv_id IS NOT NULL
),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce([4294967295] || flatten(list_transform(string_split(conv_id::VARCHAR, ''),
    lambda d: [ord(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])), lambda s, x: CASE WHEN x >= 0 THEN xor(s, x)
    WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
),
p AS (SELECT c.*, (SELECT count(*) FROM t WHERE t.conv_id = c.base AND t.pos <= c.h) AS head FROM c),
r AS (
  SELECT p.conv_id, t.pos AS depth, t.turn FROM p JOIN t ON t.conv_id = p.base WHERE t.pos <= p.h
  UNION ALL SELECT p.conv_id, p.head + t.pos - p.h, t.turn FROM p JOIN t ON t.conv_id = p.conv_id WHERE t.pos > p.h
),
w AS (
  SELECT p.conv_id, coalesce(l.turns, []) AS turns FROM p
  LEFT JOIN (SELECT conv_id, list(turn ORDER BY depth) AS turns FROM r GROUP BY conv_id) l ON l.conv_id = p.conv_id
),
m AS (
  SELECT conv_id AS member, d AS depth, turns[1:d] AS prefix, len(turns) AS n, coalesce(octet_length(encode(turns[d].t)), 0) AS bytes
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM w)
),
g AS (
  SELECT depth, prefix, min(member) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS cost,
    sha256(coalesce(string_agg(CASE WHEN depth = n THEN member::VARCHAR END, ',' ORDER BY member), '')) AS ends_sha256
  FROM m GROUP BY depth, prefix
),
o AS (SELECT m.member, m.depth, g.conv_id AS owner FROM m JOIN g ON g.depth = m.depth AND g.prefix = m.prefix),
q AS (
  SELECT g.conv_id, g.depth, u.owner AS parent_conv_id, g.n_convs, g.cost, g.ends_sha256
  FROM g LEFT JOIN o u ON u.member = g.conv_id AND u.depth = g.depth - 1
),
k AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM q WHERE depth > 0 GROUP BY ALL),
v AS (SELECT q.*, coalesce(k.n_children, 0) AS n_children FROM q LEFT JOIN k ON k.conv_id = q.conv_id AND k.depth = q.depth),
s AS (
  SELECT o.owner AS conv_id, o.depth, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(v.cost) AS saved
  FROM v JOIN o ON o.member = v.conv_id AND o.depth <= v.depth GROUP BY o.owner, o.depth
)
SELECT v.conv_id, v.depth::BIGINT AS depth, v.parent_conv_id, v.n_convs, v.n_children, s.n_leaves::BIGINT AS n_leaves,
  s.saved::BIGINT AS saved_tokens, v.ends_sha256
FROM v JOIN s ON s.conv_id = v.conv_id AND s.depth = v.depth
"""
