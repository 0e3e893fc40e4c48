"""The prefix trie against brute force, whatever the shards; its queue and its defined cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from runlake.llm import prefix_trie
from runlake.llm.queries import QUERIES, SQL

SCHEMA = "conv_id long, turn long, role string, text string, n_convs long"


def brute(convs):
    """Every node of ``convs`` ({id: [(role, text), ...]}) as the operator returns them."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    totals = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        totals[p] = (sum(totals[k][0] for k in kids[p]) or 1, own + sum(totals[k][1] for k in kids[p]))
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), *totals[p], hashlib.sha256(
        ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


def conversations(rows):
    convs = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs[c].append((role or "", text or ""))
    return dict(convs)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(7)


def made(df):
    return sorted(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def some(seed, n=60, endless=90):
    rng = random.Random(seed)
    rows = [(-3, None, None, None), (-3, 0, "a", "é"), (-3, 0, "a", "é"), (None, 1, "u", "x"), (500, 2, None, ""), (501, None, "", None)]
    rows += [(900, t, "u", f"t{t}") for t in range(endless)] + [(901, t, "u", f"t{t}") for t in range(endless // 2)]
    for c in range(n):
        first = "hot" if c % 3 else rng.choice("abc")
        rows += [(c, t, rng.choice("ua") if t else "u", first if not t else rng.choice(["x", "yy", "zß"])) for t in range(rng.randrange(1, 7))]
    rows += [(c, t, "u", f"copy{t}") for c in range(1000, 1030) for t in range(3)]
    return rows


@pytest.mark.parametrize("light, band, one_shard", [(1 << 14, 64, 100_000), (3, 2, 4), (10, 5, 0), (0, 3, 2)])
def test_equals_brute_force_for_any_shards(spark, light, band, one_shard):
    rows = some(light)
    got = prefix_trie.build(*prefix_trie.ordered(table(spark, rows)), light=light, band=band, one_shard=one_shard)
    assert made(got) == brute(conversations(rows))


def test_stretches_packs_and_spilled_messages_change_nothing(spark, monkeypatch):
    rows = some(5)
    for name in ("STRETCH", "PACK", "QUEUE_ROWS"):
        monkeypatch.setattr(prefix_trie, name, 4)
    assert made(prefix_trie.build(*prefix_trie.ordered(table(spark, rows)))) == brute(conversations(rows))


def test_spliced_query_equals_brute_force_and_sql(spark, tmp_path):
    rows = some(9) + [(c, t, "u", f"{c % 7} {t}") for c in range(2001, 2060, 2) for t in range(c % 9)]
    table(spark, rows).drop("n_convs").write.parquet(f"{tmp_path}/conversations.parquet")
    convs = conversations(rows)
    rebuilt = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = convs.get(base, [])[:h] + turns[h:]
    got = made(QUERIES["op12_prefix_trie"](spark, str(tmp_path)))
    assert got == brute(rebuilt) and any(not t for t in rebuilt.values())
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
        assert sorted(con.execute(SQL["op12_prefix_trie"]).fetchall()) == got


def test_empty_tables(spark):
    assert made(prefix_trie.build(*prefix_trie.ordered(table(spark, [])))) == []
    assert made(prefix_trie.build(*prefix_trie.ordered(table(spark, [(None, 1, "u", "x")])))) == []


def test_queue_gives_items_in_order_across_spilled_runs():
    rng, queue = random.Random(1), prefix_trie.Queue(3, most=5)
    items = [(rng.randrange(6), rng.randrange(4), i) for i in range(200)]
    for item in items:
        queue.push(item)
    assert queue.runs
    for a in range(6):
        for b in range(4):
            assert sorted(queue.take(a, b)) == sorted(x for x in items if x[:2] == (a, b))
    assert not queue.heap and not queue.runs
