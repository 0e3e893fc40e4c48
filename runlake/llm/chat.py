"""Chat formatting with cumulative snapshots collapsed.

Logs often hold a conversation again each time it has grown. A rolling hash
over its turns names every prefix; a conversation whose whole is another's
proper prefix is dropped by an anti-join, equal ones leave the smallest ``conv_id``,
and what is maximal is rendered.

Turns are set in order by range partitioning, so a conversation of any length is
spread over partitions. Positions and rolling hashes run inside a partition and are
offset by the totals of the earlier ones. Rendered text comes in segments of at most ``SEGMENT``
turns, so no conversation is gathered whole; the segments of one, joined in order, are its text.

Defined cases: turns are ordered by ``turn``, then role and text; rows equal in all four
columns are one turn. NULL roles and texts render as empty and differ from empty ones in
comparisons; a NULL ``turn`` comes first. Rows without ``conv_id`` are no conversation and are left out.
Further columns are ignored. An empty table gives an empty result.
"""

from pyspark.sql import DataFrame, Window, functions as F

from runlake.session import materialize

SEGMENT = 64
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def ordered(turns: DataFrame) -> DataFrame:
    """(conv_id, role, text, pos, a, b): turns numbered from 1, with the hashes of the prefix that ends there."""
    keys = ["conv_id", "turn", "role", "text"]
    placed = materialize(turns.select(*keys).filter("conv_id IS NOT NULL").distinct().repartitionByRange(*keys)
                         .withColumn("part", F.spark_partition_id()), "turns")
    here = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)

    def offset(df: DataFrame, total, name: str) -> DataFrame:
        """The total over a conversation's earlier partitions."""
        sums = df.groupBy("conv_id", "part").agg(total(f"own_{name}").alias("t"))
        sums = sums.select("conv_id", "part", F.coalesce(total("t").over(earlier), F.lit(0).cast("long")).alias(f"off_{name}"))
        return df.join(sums, ["conv_id", "part"])

    counted = offset(placed.withColumn("own_n", F.lit(1).cast("long")), F.sum, "n")
    numbered = counted.withColumn("pos", F.row_number().over(here) + F.col("off_n")).drop("own_n", "off_n")
    turn = ["pos", F.isnull("role"), F.coalesce("role", F.lit("")), F.isnull("text"), F.coalesce("text", F.lit(""))]
    hashed = materialize(numbered.withColumn("own_a", F.xxhash64(*turn)).withColumn("own_b", F.xxhash64(F.lit(1), *turn)), "turns")
    hashed = offset(offset(hashed, F.bit_xor, "a"), F.bit_xor, "b")
    rolling = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hashed.select("conv_id", "role", "text", "pos", *[
        F.bit_xor(f"own_{c}").over(rolling).bitwiseXOR(F.col(f"off_{c}")).alias(c) for c in "ab"])


def maximal(prefixes: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies): conversations that are no proper prefix of another, the first of equal ones."""
    last = F.max(F.struct("pos", "a", "b"))
    whole = materialize(prefixes.groupBy("conv_id").agg(last.alias("w")).select("conv_id", F.col("w.pos").alias("n_turns"), "w.a", "w.b"),
                        "conversations")
    first = whole.groupBy("n_turns", "a", "b").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    proper = (prefixes.select("conv_id", "pos", "a", "b").join(whole.select("conv_id", "n_turns"), "conv_id")
              .filter("pos < n_turns").select(F.col("pos").alias("n_turns"), "a", "b").distinct())
    return first.join(proper, ["n_turns", "a", "b"], "left_anti").select("conv_id", "n_turns", "copies")


def format_chats(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, segment, n_turns, copies, text) of the maximal conversations in ``turns`` (conv_id, turn, role, text)."""
    prefixes = materialize(ordered(turns), "prefixes")
    kept = materialize(maximal(prefixes), "conversations")
    piece = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(CLOSE + "\n"))
    at = F.floor((F.col("pos") - 1) / segment).cast("long")
    pieces = prefixes.join(kept, "conv_id").select("conv_id", "n_turns", "copies", at.alias("segment"), "pos", piece.alias("piece"))
    return pieces.groupBy("conv_id", "segment", "n_turns", "copies").agg(
        F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("p")).select(
        "conv_id", "segment", "n_turns", "copies", F.array_join(F.transform("p", lambda p: p.piece), "").alias("text"))


SQL = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos, role, text
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)
),
c AS (
  SELECT conv_id, count(*) AS n_turns, list(coalesce('r' || role, '') || chr(0) || coalesce('t' || text, '') ORDER BY pos) AS turns
  FROM t GROUP BY conv_id
),
f AS (SELECT min(conv_id) AS conv_id, n_turns, turns, count(*) AS copies FROM c GROUP BY n_turns, turns),
p AS (SELECT DISTINCT list_slice(turns, 1, k) AS turns FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM c)),
m AS (SELECT conv_id, n_turns, copies FROM f WHERE turns NOT IN (SELECT turns FROM p))
SELECT t.conv_id, (t.pos - 1) // 64 AS segment, n_turns, copies,
  string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM t JOIN m ON t.conv_id = m.conv_id
GROUP BY t.conv_id, (t.pos - 1) // 64, n_turns, copies
"""
