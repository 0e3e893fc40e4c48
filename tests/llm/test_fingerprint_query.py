"""Query op7 against a plain-Python SimHash, with NULL and repeated ids, repeated rows and empty tables."""

import hashlib
import random
import re

import xxhash

from runlake.llm import simhash
from runlake.llm.queries import QUERIES


def spark_hash(*values, seed=42):
    for v in values:
        if v is not None:
            seed = xxhash.xxh64(v.to_bytes(4, "little") if isinstance(v, int) else v.encode(), seed).intdigest()
    return seed


def plain(text):
    """128 bits: each pair of words votes with its letters for the bits of its hash and against the others."""
    words = re.split(r"[ \t\n\x0b\f\r]+", text.lower())
    bits, total, votes = 0, 0, [0] * 128
    for i, x in enumerate(words):
        y = words[i + 1] if i + 1 < len(words) else None
        w = min(len(x) + len(y or ""), 24)
        total += w
        whole = spark_hash(x, y) << 64 | spark_hash(1, x, y)
        for b in range(128):
            votes[b] += w * (whole >> b & 1)
    for b in range(128):
        bits |= (2 * votes[b] > total) << b
    return bits


def want(rows):
    rows = [(d, t or "") for d, t in rows]
    order = sorted({d for d, _ in rows}, key=lambda d: (d is not None, d))
    signed = lambda h: h - (h >> 63 << 64)
    out = []
    for d, t in rows:
        after = order[(order.index(d) + 1) % len(order)]
        following = min((x for e, x in rows if e == after), key=lambda x: signed(spark_hash(x)))
        k = len(t) // 4
        edited = t[:len(t) - k] + following[:k]
        a, b, c = plain(t), plain(edited), plain(following)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{a:032x}", f"{b:032x}",
                    1 - (a ^ b).bit_count() / 128, 1 - (a ^ c).bit_count() / 128,
                    sum((a ^ plain(x)).bit_count() <= simhash.RADIUS for _, x in rows) - 1 if d is not None and d % 100 == 0 else None))
    return sorted(out, key=str)


def made(spark, path, rows):
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    got = QUERIES["op7_document_fingerprints"](spark, str(path))
    return sorted((tuple(r) for r in got.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                                                "near_next", "n_within").collect()), key=str)


def test_equals_brute_force_with_odd_ids(spark, tmp_path):
    rng = random.Random(4)
    some = lambda: " ".join(rng.choice(["the", "Cat", "saß", "日本", "x", "longerword", "\t", "\n"]) for _ in range(rng.randrange(1, 60)))
    rows = [(i * 50, some()) for i in range(12)] + [(None, some()), (None, some()), (None, None), (100, some()), (100, some()), (100, ""), (-7, None)]
    rows += [rows[3], rows[3], rows[3], (700, rows[0][1]), (800, rows[0][1] + " more")]
    assert made(spark, tmp_path / "odd", rows) == want(rows)


def test_small_tables(spark, tmp_path):
    assert made(spark, tmp_path / "none", []) == []
    one = [(5, "only one text here")]
    assert made(spark, tmp_path / "one", one) == want(one)


def test_texts_cross_the_network_once(spark):
    """The heads' branch of the plan reads the same exchange of (key, text) as the rows' branch."""
    docs = spark.createDataFrame([(i, f"text number {i} of a few") for i in range(50)] + [(None, "no id")], "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = simhash.with_edits(docs)
        both.collect()
        shown = both._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    read = [x for x in shown.splitlines() if re.search(r"Scan ExistingRDD\[doc_id", x)]
    assert len(read) == 1 and "ReusedExchange" in shown
    assert {r.doc_id for r in both.select("doc_id").collect()} == {None, *range(50)}
