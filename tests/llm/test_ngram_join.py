"""The n-gram join against all pairs."""

import random
import re

import pytest

from runlake.llm.ngram_join import link_documents, segments, size_classes

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def brute(rows, k, at_least):
    """Component of every (doc_id, text), by comparing all."""
    sets = [shingles(t, k) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if rows[i][0] is not None and rows[j][0] is not None and a and b and 100 * len(a & b) >= at_least * len(a | b):
                top[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i)]
        out.append((doc, len(sets[i]), None if doc is None else min(ids)))
    return out


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def check(spark, rows, k, at_least, **more):
    got = [tuple(r) for r in link_documents(table(spark, rows), k, at_least, **more).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, k, at_least), key=str)


@pytest.mark.parametrize("k,at_least", [(4, 85), (5, 80)])
def test_chains_of_edits_near_the_threshold(spark, k, at_least):
    """Copies with few to many edits, so that links sit on both sides of the threshold and components chain."""
    rng = random.Random(at_least)
    rows = []
    for base in range(6):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.choice((9, 30, 90, 300)))]
        for _ in range(14):
            rows.append((len(rows), edited(rng, words, rng.randrange(0, max(2, len(words) // 25)))))
    hot = " ".join(f"hot{i}" for i in range(40))
    rows += [(len(rows) + i, hot + " " + " ".join(f"w{rng.randrange(500)}" for _ in range(25))) for i in range(30)]
    rng.shuffle(rows)
    check(spark, rows, k, at_least, group_size=4)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "A b"), (5, "a  B"), (6, "a b c d e"), (7, "a b c d e"), (8, "a b"),
            (9, "x " * 3000), (10, "x " * 3001), (None, "a b c d e"), (6, "a b c d e"), (11, "q " + " ".join(map(str, range(400)))),
            (12, " ".join(map(str, range(400))))]
    check(spark, rows, 5, 80)


def test_empty_table_and_clashing_columns(spark):
    assert link_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = spark.createDataFrame([(1, "a b", 5, 6), (2, "a b", 7, 8)], "doc_id long, text string, key long, rep long")
    assert sorted(map(tuple, link_documents(rows).collect())) == [(1, 1, 1), (2, 1, 1)]


def test_linked_sets_always_share_a_segment():
    """The pigeonhole, for small sets where empty parts are common."""
    import numpy as np
    rng = np.random.default_rng(1)
    for at_least in (80, 85):
        classes = size_classes(at_least)
        for _ in range(400):
            n = int(rng.integers(1, 60))
            x = np.sort(rng.integers(0, 2**64, n, dtype=np.uint64))
            y = np.unique(np.concatenate((x[rng.random(n) > 0.08], rng.integers(0, 2**64, int(rng.integers(0, 4)), dtype=np.uint64))))
            both = len(np.intersect1d(x, y))
            if both and 100 * both >= at_least * (len(x) + len(y) - both):
                where, tokens = np.repeat([0, 1], [len(x), len(y)]), np.concatenate((x, y))
                row, key, need = segments(where, tokens, np.array([len(x), len(y)]), classes, at_least)
                shared = np.intersect1d(key[row == 0], key[row == 1])
                assert len(shared)
                scheme = shared & np.uint64(127)
                assert any((scheme == s).sum() >= max(1, need[(row == 0) & ((key & np.uint64(127)) == s)].min()) for s in np.unique(scheme))


def test_a_crowd_of_near_copies_collapses_before_groups_are_opened(spark, monkeypatch):
    """Eight hundred texts a few edits from one another, on both sides of the threshold; brute force by a matrix product."""
    import numpy as np
    from runlake.llm import ngram_join
    rng = random.Random(12)
    words = [f"w{i}" for i in range(120)]
    rows = [(i, edited(rng, words, rng.randrange(1, 5))) for i in range(800)]
    sets = [{tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for _, t in rows]
    place = {s: k for k, s in enumerate(sorted(set().union(*sets)))}
    cells = np.zeros((len(rows), len(place)), np.float32)
    for i, s in enumerate(sets):
        cells[i, [place[x] for x in s]] = 1
    both, n = cells @ cells.T, cells.sum(1)
    linked = 100 * both >= 80 * (n[:, None] + n[None, :] - both)
    want = np.arange(len(rows))
    while True:
        least = np.where(linked, want[None, :], len(rows)).min(1)
        if (least == want).all():
            break
        want = least
    assert 0.05 < linked.mean() < 0.95, "neither all nor none are linked directly"
    stars, whole = [], ngram_join._collapse
    monkeypatch.setattr(ngram_join, "_collapse", lambda *a: stars.append(whole(*a)) or stars[-1])
    got = {r.doc_id: r.component_id for r in link_documents(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, group_size=16).collect()}
    assert [got[i] for i in range(len(rows))] == want.tolist()
    left = stars[0].join(spark.createDataFrame([(i, int(w)) for i, w in enumerate(want)], "rep long, top long"), "rep")
    assert left.filter("comp <> top").count() < 100, "the stars alone join most of them"


def test_linked_sets_share_as_many_segments_as_both_need():
    """What sets are left out by: enough common segments of one cut for either side."""
    import numpy as np
    rng = np.random.default_rng(4)
    for at_least in (80, 85):
        classes, linked = size_classes(at_least), 0
        for _ in range(400):
            n = int(rng.integers(1, 400))
            x = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            y = np.unique(np.concatenate((x[rng.random(n) > 0.08], rng.integers(0, 2**64, int(rng.integers(0, 1 + n // 12)), dtype=np.uint64))))
            both = len(np.intersect1d(x, y))
            if both and 100 * both >= at_least * (len(x) + len(y) - both):
                linked += 1
                where, tokens = np.repeat([0, 1], [len(x), len(y)]), np.concatenate((x, y))
                row, key, need = segments(where, tokens, np.array([len(x), len(y)]), classes, at_least)
                shared = np.intersect1d(key[row == 0], key[row == 1])
                cut = key & np.uint64(127)
                assert any((shared & np.uint64(127) == s).sum() >= need[cut == s].max() for s in np.unique(shared & np.uint64(127)))
        assert linked > 100


def test_texts_that_share_too_little_are_not_moved(spark, monkeypatch):
    """A passage that all texts have makes segments of its own, but no text goes to another for it."""
    from runlake.llm import ngram_join
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(i, passage + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))) for i in range(80)]
    copies = [edited(rng, rows[i][1].split(), 1) for i in range(6)]
    rows += [(100 + i, t) for i, t in enumerate(copies)]
    moved, write = {}, ngram_join.materialize

    def seen(df, purpose):
        moved[purpose] = write(df, purpose)
        return moved[purpose]
    monkeypatch.setattr(ngram_join, "materialize", seen)
    check(spark, rows, 5, 80)
    texts = {r.doc_id for r in moved["texts"].collect()}
    assert texts >= {*range(6), *range(100, 106)} and len(texts) < 24
    assert moved["groups"].count() < 24
