"""N-gram Jaccard join by a token-group matrix.

Documents are sets of word shingles. Two link when
``100 * |A & B| >= at_least * |A | B|`` (``at_least`` a percentage). The join is exact up to equal 64-bit hashes.

The matrix's tokens are *segments*. The shingle universe is cut by hash into m
parts, m following the size class of a set; what a set has in one part is a
segment. Linked sets differ in at most D shingles, so at least m - D parts agree,
and m > D. A segment holds a few shingles, so a line or passage that a third of
all documents share makes no segment that they share: a hot shingle has no hot
list. Parts empty in both sets agree without telling anything; a set with that
many empty parts adds the segments of a second cut under each empty part, and so on.

1. *Partition.* Sets that share a segment are compared with the smallest document
   that has it (a star, never all pairs), and what links is a component; further stars around other sets
   join the components of a crowd. Sets that met the same
   smallest document, linked or not, are dealt into groups of about ``group_size``.
   A set that shares fewer segments with others, under one cut, than a linked set must is left out of all that follows, before and after the stars.
2. *Union.* The matrix holds each group's segments once, beside the components they come from.
   A segment, or a pair of groups, within one component has nothing left to find.
3. *Bound.* Two groups whose unions share fewer segments than a linked pair must stay shut; so does,
   inside an opened pair, a set with too few shingles in the other group's union.
4. *Open.* The sets that are left are compared exactly, by a product of 0/1 matrices.

Defined cases: a NULL, empty or blank text has an empty set, linked with nothing.
Rows with equal sets are one set, however many. Rows that share a ``doc_id`` are
separate documents, each judged by its own text; a NULL ``doc_id`` is counted but
never linked and has a NULL component. Further columns are ignored. An empty table
gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from runlake.llm.common import CHUNK_BYTES, Words, arrow_friendly, chunks, components, mix, shingle_sets, starts_of, text_bytes
from runlake.session import materialize

GROUP_SIZE = 512
KNOWN_SETS = 1 << 18
MOST_STARS, PAYS = 40, 20  # rounds of stars, and pairs that one link among them is worth
_SCHEMES = 128  # a segment's low bits name the size class whose cut made it


def _parts(smallest: int, d: int) -> int:
    """How many parts to cut a set of at least ``smallest`` shingles into, so that more than ``d`` of them rarely stay empty."""
    def margin(m: int) -> float:
        empty = (1 - 1 / m) ** smallest
        return (m * (1 - empty) - d - 0.5) / max(1e-9, (m * empty * (1 - empty)) ** 0.5)
    if not d:
        return 1
    tried = range(d + 1, 3 * d + 4, max(1, d // 50))
    return next((m for m in tried if margin(m) >= 2.5), max(tried, key=margin))


def size_classes(at_least: int):
    """Smallest sizes of the classes, and for each the parts m and the most shingles D in which two linked sets differ."""
    lows, parts, apart, low = [], [], [], 1
    while low < 1 << 40:
        high = max(low, low * 100 // at_least, low * 13 // 10)
        d = 2 * high * (100 - at_least) // (100 + at_least)
        lows.append(low)
        apart.append(d)
        parts.append(_parts(max(1, low * at_least // 100), d))
        low = high + 1
    assert len(lows) <= _SCHEMES, "a threshold so near to 1 has too many size classes"
    return np.array(lows), np.array(parts, np.uint64), np.array(apart)


def _cut(tokens, where, n_rows, scheme, m, path):
    """Segments of sorted sets under one cut: row, key and, per row, the number of parts that hold anything."""
    per_token = m[where]
    part = ((tokens >> np.uint64(32)) * per_token) >> np.uint64(32)
    begin = starts_of(where, part)
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(n_rows, np.int64)
    row = where[begin]
    key = np.add.reduceat(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), begin)
    key = mix(key + mix(part[begin] * np.uint64(_SCHEMES) + scheme[row]) + path)
    key = (key & ~np.uint64(_SCHEMES - 1)) | scheme[row]
    return row, key, np.bincount(row, minlength=n_rows)


def _below(tokens, scheme, m, d, path, depth):
    """Segments of a set's further cuts, one under every part that is empty."""
    filled = set((((tokens >> np.uint64(32)) * m) >> np.uint64(32)).tolist())
    for part in range(int(m)):
        if part in filled:
            continue
        under = mix(np.array([part + 1], np.uint64) + path)
        if depth > 20:
            yield mix(under) & ~np.uint64(_SCHEMES - 1) | scheme
            continue
        again = np.sort(mix(tokens ^ under))
        zero = np.zeros(len(again), np.int64)
        _, key, n = _cut(again, zero, 1, np.array([scheme]), np.array([m]), under)
        yield key
        if n[0] <= d:
            yield from _below(again, scheme, m, d, under, depth + 1)


def segments(where, tokens, sizes, classes, at_least):
    """(row, key, need) of every set; ``need``: how many of its segments a linked set has at least."""
    lows, parts, apart = classes
    n_rows = len(sizes)
    own = np.maximum(np.searchsorted(lows, sizes, "right") - 1, 0)
    reach = sizes * 100 // at_least
    out = []
    for up in (0, 1):  # a set also meets larger ones, under the cut of their class
        scheme = own + up
        use = sizes > 0 if not up else (sizes > 0) & (reach >= lows[np.minimum(scheme, len(lows) - 1)])
        at = use[where]
        t, w = tokens[at], where[at]
        m, d = parts[scheme], apart[scheme]
        scheme = scheme.astype(np.uint64)
        row, key, filled = _cut(t, w, n_rows, scheme, m, np.uint64(0))
        need = np.maximum(filled - d, 1)
        out.append((row, key, need[row]))
        for r in np.flatnonzero(use & (filled <= d)):
            low, high = np.searchsorted(w, (r, r + 1))
            more = np.concatenate(list(_below(t[low:high], scheme[r], m[r], d[r], np.uint64(0), 0)))
            out.append((np.full(len(more), r), more, np.ones(len(more), np.int64)))
    return tuple(np.concatenate(c) for c in zip(*out))


def _sets(words: int):
    """The shingle sets of a batch's texts, chunk by chunk: first row, row numbers, sorted shingles, set sizes."""
    split = Words()

    def of(column):
        data, offsets = text_bytes(column)
        for low, high in chunks(offsets, CHUNK_BYTES // 4):
            part = offsets[low:high + 1] - offsets[low]
            _, _, rows, hashes = split(data[offsets[low]:offsets[high]], part)
            yield (low, *shingle_sets(hashes, rows, high - low, words))
    return of


def _signatures(where, tokens, sizes):
    """Two 64-bit digests of every set."""
    out = []
    for salt in (0x2545F4914F6CDD1D, 0x632BE59BD9B4E019):
        total = np.zeros(len(sizes), np.uint64)
        begin = starts_of(where)
        if len(begin):
            total[where[begin]] = np.add.reduceat(mix(tokens ^ np.uint64(salt)), begin)
        out.append(total.view(np.int64))
    return out


def _members(words: int):
    def run(batches):
        sets = _sets(words)
        for batch in batches:
            found = [(sizes, *_signatures(where, tokens, sizes)) for _, where, tokens, sizes in sets(batch.column(1))]
            if found:
                n, a, b = (np.concatenate(c) for c in zip(*found))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b)],
                                                 ["doc_id", "n_shingles", "sig_a", "sig_b"])
    return run


def _entries(words: int, at_least: int):
    def run(batches):
        sets, classes = _sets(words), size_classes(at_least)
        seen = set()  # sets met lately in this task: a group of copies is sent once, or a few times
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for low, where, tokens, sizes in sets(batch.column(1)):
                a, b = _signatures(where, tokens, sizes)
                fresh = sizes > 0
                if len(seen) > KNOWN_SETS:
                    seen.clear()
                for i in np.flatnonzero(fresh):
                    mark = (a[i], b[i])
                    fresh[i] = mark not in seen
                    seen.add(mark)
                at = fresh[where]
                row, key, need = segments(where[at], tokens[at], np.where(fresh, sizes, 0), classes, at_least)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(ids[low + row].astype(np.int64)), pa.array(need.astype(np.int32))],
                    ["key", "doc_id", "need"])
    return run


def _verify(words: int, at_least: int):
    def run(batches):
        sets = _sets(words)
        for batch in batches:
            ids = np.stack([batch.column(i).to_numpy() for i in (0, 1)], 1)
            texts = pa.concat_arrays([batch.column(2), batch.column(3)])
            _, at, of = np.unique(ids.T.reshape(-1), return_index=True, return_inverse=True)
            got = []
            for _, where, tokens, sizes in sets(texts.take(pa.array(at))):
                got += np.split(tokens, np.cumsum(sizes)[:-1])
            keep = np.zeros(len(ids), bool)
            for i in range(len(ids)):
                x, y = got[of[i]], got[of[i + len(ids)]]
                if min(len(x), len(y)) * 100 >= at_least * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = both > 0 and 100 * both >= at_least * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([pa.array(ids[keep, 0]), pa.array(ids[keep, 1])], ["a", "b"])
    return run


def _open(words: int, at_least: int):
    """Compare the sets of one group with those of another (or with each other); rows: side, comp, text."""
    cells = 1 << 22

    def run(table: pa.Table) -> pa.Table:
        side, comp = (table.column(c).to_numpy() for c in ("side", "comp"))
        got = []
        for _, _, tokens, sizes in _sets(words)(table.column("text").combine_chunks()):
            got += np.split(tokens, np.cumsum(sizes)[:-1])
        n = np.array([len(t) for t in got])
        members = np.flatnonzero(side == side.max())
        union = np.unique(np.concatenate([got[i] for i in members]))
        # The bound: a set with too few shingles in the group's union opens none of its members.
        asked = [i for i in np.flatnonzero(side == 0) if 100 * np.isin(got[i], union, assume_unique=True).sum() >= at_least * n[i] > 0]
        if not asked:
            return pa.table({"x": pa.array([], pa.int64()), "y": pa.array([], pa.int64())})
        common = np.intersect1d(np.unique(np.concatenate([got[i] for i in asked])), union, assume_unique=True)
        both = np.zeros((len(asked), len(members)), np.float32)
        width = max(1, cells // (len(asked) + len(members)))
        for low in range(0, len(common), width):
            part = common[low:low + width]

            def rows(sets):
                out = np.zeros((len(sets), len(part)), np.float32)
                for r, i in enumerate(sets):
                    out[r, np.searchsorted(part, np.intersect1d(part, got[i], assume_unique=True))] = 1
                return out
            both += rows(asked) @ rows(members).T
        both = np.rint(both).astype(np.int64)
        linked = 100 * both >= at_least * (n[asked][:, None] + n[members][None, :] - both)
        x, y = np.nonzero(linked & (both > 0))
        pairs = np.unique(np.stack((comp[np.array(asked)[x]], comp[members[y]]), 1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        top = {}

        def find(c):
            while top.get(c, c) != c:
                c = top[c]
            return c
        keep = []  # a forest over the components is enough
        for k, (a, b) in enumerate(pairs.tolist()):
            a, b = find(a), find(b)
            if a != b:
                top[a] = b
                keep.append(k)
        pairs = pairs[keep]
        return pa.table({"x": pa.array(pairs[:, 0], pa.int64()), "y": pa.array(pairs[:, 1], pa.int64())})
    return run


def _linked(pairs: DataFrame, texts: DataFrame, words: int, at_least: int) -> DataFrame:
    """The pairs (a, b) whose texts are alike."""
    left, right = (texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
            .mapInArrow(_verify(words, at_least), "a long, b long"))


def _able(keyed: DataFrame, apart: str) -> DataFrame:
    """The rows of ``keyed`` (key, rep, need, ...) whose set may link with one of another ``apart``.

    A linked set shares at least ``need`` segments of one cut with the other set alone, so one that shares fewer with all others links with none.
    Who shares only what many texts have in common, like a line, goes here, before any text is moved.
    """
    by_key, by_set = Window.partitionBy("key"), Window.partitionBy("rep", F.expr(f"key & {_SCHEMES - 1}"))
    met = (keyed.withColumn("low", F.min(apart).over(by_key)).withColumn("high", F.max(apart).over(by_key))
           .filter("low < high").drop("low", "high"))
    return (met.withColumn("shares", F.count(F.lit(1)).over(by_set)).withColumn("least", F.min("need").over(by_set))
            .filter("shares >= least").drop("shares", "least"))


def _collapse(shared: DataFrame, near: DataFrame, tried: DataFrame, texts: DataFrame, alike, words: int, at_least: int,
              crowd: int) -> DataFrame:
    """(rep, comp) after further stars: a crowd that links in itself, but not with its first document, becomes one component.

    Every round each segment of more than ``crowd`` sets, so of more than one group, that still lies in several components picks one of its sets, by a hash salted by the
    round, and compares the sets of other components with it: as many pairs as rows, whatever a crowd's size. Rounds go on
    while they pay; what they leave apart is for the groups to compare.
    """
    near = materialize(shared.select("rep").distinct().join(near, "rep", "left").select("rep", F.coalesce("comp", "rep").alias("comp")), "near")
    for salt in range(1, MOST_STARS):
        keyed = shared.join(near, "rep").select("key", "rep", "n_shingles", "comp")
        pick = F.min(F.struct(F.xxhash64(F.lit(salt), "rep").alias("h"), "rep", "n_shingles", "comp")).alias("c")
        picks = materialize(keyed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("n"), pick).filter(
            (F.col("low") < F.col("high")) & (F.col("n") > crowd)).select("key", "c"), "picks")
        pairs = keyed.join(picks, "key").filter("comp <> c.comp").filter(alike("n_shingles", "c.n_shingles")).select(
            F.least("rep", "c.rep").alias("b"), F.greatest("rep", "c.rep").alias("a")).distinct().select("a", "b")
        fresh = materialize(pairs.join(tried, ["a", "b"], "left_anti"), "star")
        found = materialize(_linked(fresh, texts, words, at_least), "star")
        n, n_found = fresh.count(), found.count()
        if n_found:
            of = [near.select(F.col("rep").alias(c), F.col("comp").alias(f"comp_{c}")) for c in "ab"]
            merged = components(found.join(of[0], "a").join(of[1], "b").select("comp_a", "comp_b").distinct(), "comp_a", "comp_b")
            merged = merged.select(F.col("node").alias("comp"), "component")
            near = materialize(near.join(merged, "comp", "left").select("rep", F.coalesce("component", "comp").alias("comp")), "near")
        if n_found * PAYS < n or not n:
            break
        tried = tried.unionByName(fresh)
    return near


def link_documents(docs: DataFrame, words: int = 5, at_least: int = 80, group_size: int = GROUP_SIZE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest ``doc_id`` reachable by links, its own included.
    """
    arrow_friendly(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    members = materialize(docs.mapInArrow(
        _members(words), "doc_id long, n_shingles long, sig_a long, sig_b long"), "sets")
    sig = ["n_shingles", "sig_a", "sig_b"]
    firsts = members.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*sig).agg(F.min("doc_id").alias("rep"))
    rep_of = materialize(members.filter("doc_id IS NOT NULL").join(firsts, sig).select(
        "doc_id", "rep", *sig).distinct(), "reps")

    by_key = Window.partitionBy("key")
    entries = docs.filter("doc_id IS NOT NULL").mapInArrow(_entries(words, at_least), "key long, doc_id long, need int")
    met = materialize(entries.withColumn("low", F.min("doc_id").over(by_key)).withColumn(
        "high", F.max("doc_id").over(by_key)).filter("low < high").select("key", "doc_id", "need"), "segments")
    one = rep_of.select("doc_id", "rep", "n_shingles")
    first = F.min(F.struct("rep", "n_shingles")).over(by_key)
    shared = materialize(_able(met.join(one, "doc_id").select("key", "rep", "n_shingles", "need").distinct(), "rep")
                         .withColumn("first", first).withColumn("last", F.max("rep").over(by_key))
                         .filter("first.rep < last").drop("last"), "segments")

    def alike(x, y):
        return f"least({x}, {y}) * 100 >= greatest({x}, {y}) * {at_least}"

    wanted = shared.select(F.col("rep").alias("doc_id")).distinct()
    texts = materialize(docs.join(wanted, "doc_id", "left_semi"), "texts")
    star = (shared.filter("rep > first.rep").filter(alike("n_shingles", "first.n_shingles"))
            .select(F.col("rep").alias("a"), F.col("first.rep").alias("b")).distinct())
    star = materialize(star, "star")
    near = components(_linked(star, texts, words, at_least), "a", "b")
    near = _collapse(shared, near.select(F.col("node").alias("rep"), F.col("component").alias("comp")), star, texts, alike, words, at_least, group_size)

    # Groups of similar sets: those that met the same smallest one, whether they link or not.
    open_keys = materialize(_able(shared.join(near, "rep", "left").select(
        "key", "rep", F.coalesce("comp", "rep").alias("comp"), "need", F.col("first.rep").alias("center")), "comp"), "segments")
    inside = open_keys.groupBy("rep", "comp").agg(F.min("center").alias("center"))
    blocks = inside.groupBy("center").agg(F.ceil(F.count(F.lit(1)) / group_size).alias("blocks"))
    groups = materialize(inside.join(blocks, "center").select(
        "rep", "comp", F.xxhash64("center", F.pmod(F.xxhash64("rep"), F.col("blocks"))).alias("gid")), "groups")
    matrix = materialize(open_keys.join(groups.select("rep", "gid"), "rep").groupBy("key", "gid").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("need").alias("need")), "matrix")
    left, right = (matrix.select("key", *[F.col(c).alias(f"{c}_{i}") for c in ("gid", "low", "high", "need")]) for i in (0, 1))
    opened = (left.join(right, "key").filter("gid_0 <= gid_1 AND least(low_0, low_1) < greatest(high_0, high_1)")
              .groupBy("gid_0", "gid_1", F.expr(f"key & {_SCHEMES - 1}").alias("scheme"))
              .agg(F.count(F.lit(1)).alias("overlap"), F.min(F.greatest("need_0", "need_1")).alias("need"))
              .filter("overlap >= need").select("gid_0", "gid_1").distinct())
    opened = materialize(opened, "opened")
    inside = groups.select("gid", "comp", F.col("rep").alias("doc_id")).join(texts, "doc_id")
    ends = opened.select("gid_0", "gid_1", F.inline(F.expr(
        "filter(array(struct(gid_0 AS gid, 0 AS side), struct(gid_1 AS gid, 1 AS side)), s -> s.side = 0 OR gid_0 <> gid_1)")))
    across = (ends.join(inside, "gid").select("gid_0", "gid_1", "side", "comp", "text")
              .groupBy("gid_0", "gid_1").applyInArrow(_open(words, at_least), "x long, y long"))
    joined = components(across, "x", "y").select(F.col("node").alias("comp"), F.col("component").alias("top"))

    ids = (one.select("rep").distinct().join(near, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
           .join(joined, "comp", "left").select("rep", F.coalesce("top", "comp").alias("component_id")))
    linked = rep_of.join(ids, "rep").select("doc_id", *sig, "component_id")
    return (members.join(linked, ["doc_id", *sig], "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
