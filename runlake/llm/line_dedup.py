"""Line dedup over overlapping windows of consecutive lines, with SQL functions only.

A text is cut at line feeds. Every ``window`` consecutive lines are hashed (two
64-bit hashes); a window found more than once anywhere keeps its first occurrence, by
``doc_id`` and then position, and the lines that its later occurrences cover go.
Covered positions of overlapping windows merge. Where a later occurrence overlaps the
first one in the same document, the first one's lines stay.

Keys are reduced by plain aggregates, so a window that a third of all documents
hold reaches the reducer as one row per map task; the join back to the occurrences is
one that adaptive execution splits. What is gathered per document is bounded by its
own lines.

Defined cases: a NULL text stays NULL and has no lines; an empty one has one line.
A text of fewer lines than a window loses none. A window of blank lines only is no
window. Rows equal in ``doc_id`` and text are one document and keep or lose the same
lines; a NULL ``doc_id`` comes before all others. Further columns pass through, whatever
their names. An empty table gives an empty result.
"""

from pyspark.sql import DataFrame, functions as F

from runlake.operators.keys import pinned
from runlake.session import materialize

WINDOW = 3
_NOT_BLANK = "[^ \\t\\r\\f\\x0B]"


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """(doc_id, mark, pos, key_a, key_b) of every window; ``mark`` is the text's hash."""
    hashed = texts.select("doc_id", "mark", F.transform(F.split("text", "\n", -1), lambda line: F.struct(
        F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"),
        line.rlike(_NOT_BLANK).alias("full"))).alias("h"))
    hashed = pinned(hashed.filter(F.size("h") >= window))
    steps = [F.slice("h", i + 1, F.size("h") - (window - 1)).alias(f"h{i}") for i in range(window)]
    rows = hashed.select("doc_id", "mark", F.posexplode(F.arrays_zip(*steps)).alias("pos", "w"))
    parts = [F.col(f"w.h{i}") for i in range(window)]
    full = parts[0].full
    for p in parts[1:]:
        full = full | p.full
    return rows.filter(full).select("doc_id", "mark", "pos", F.xxhash64(*[p.a for p in parts]).alias("key_a"),
                                    F.xxhash64(*[p.b for p in parts]).alias("key_b"))


def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row, n_lines, n_removed): ``row`` holds all columns of ``docs``, its text without the repeated lines."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text",
                       F.xxhash64("text").alias("mark"))
    windows = materialize(_windows(rows.filter(F.col("text").isNotNull()).select("doc_id", "mark", "text"), window).distinct(),
                          "windows")
    place = F.struct("doc_id", "mark", "pos")
    repeated = (windows.groupBy("key_a", "key_b").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
                .filter("n > 1").drop("n"))
    later = windows.join(repeated, ["key_a", "key_b"]).filter(~place.eqNullSafe(F.col("first")))
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    low = F.when(own, F.greatest("pos", F.col("first.pos") + window)).otherwise(F.col("pos"))
    covered = (later.select("doc_id", "mark", F.sequence(low, F.col("pos") + (window - 1)).alias("covers"))
               .groupBy("doc_id", "mark").agg(F.array_distinct(F.flatten(F.collect_set("covers"))).alias("covered"))
               .select(F.col("doc_id").alias("c_doc"), F.col("mark").alias("c_mark"), "covered"))
    joined = rows.join(covered, F.col("doc_id").eqNullSafe(F.col("c_doc")) & (F.col("mark") == F.col("c_mark")), "left")
    lines = pinned(joined.select("row", "covered", F.split("text", "\n", -1).alias("lines")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("covered"))
    text = F.when(F.col("covered").isNull(), F.col("row.text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    columns = [text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return lines.select(F.struct(*columns).alias("row"), F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
                        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"))


SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (
  SELECT doc_id, p, lines[p + 1] || chr(10) || lines[p + 2] || chr(10) || lines[p + 3] AS k
  FROM (SELECT doc_id, lines, unnest(range(0, len(lines) - 2)) AS p FROM d)
  WHERE regexp_matches(lines[p + 1] || lines[p + 2] || lines[p + 3], '[^ \t\r\f\x0B]')
),
f AS (
  SELECT doc_id, p, first_value(doc_id) OVER o AS fd, first_value(p) OVER o AS fp
  FROM w WINDOW o AS (PARTITION BY k ORDER BY doc_id, p)
),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = fd THEN greatest(p, fp + 3) ELSE p END, p + 3)) AS i
  FROM f WHERE doc_id <> fd OR p <> fp
),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL) AS text,
         count(*) AS n_lines, count(g.i) AS n_removed
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS i FROM d) l
  LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i
  GROUP BY l.doc_id
)
SELECT doc_id, coalesce(text, '') AS text, n_lines, n_removed FROM kept
"""
