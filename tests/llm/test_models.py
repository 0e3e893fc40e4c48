"""Embedding dedup, the classifier, mixing and LM scoring against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runlake.llm import embed_dedup, lm_score, mixing, quality
from runlake.llm.common import components, text_bytes
from runlake.llm.queries import QUERIES


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(200, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    top = {}

    def find(x):
        while top.get(x, x) != x:
            x = top[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e} and not components(
        spark.createDataFrame([], "a long, b long"), "a", "b").collect()


def test_links_between_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 32))
    near = [b + rng.normal(size=32) * s * np.linalg.norm(b) / 32**0.5 for b in base[:25] for s in (0.02, 0.1, 0.15, 0.25)]
    crowd = [base[0] + rng.normal(size=32) * 0.08 for _ in range(60)]
    vectors = [list(map(float, v)) for v in (*base, *near, *crowd, base[3], base[3], base[4] * 2)]
    labels = [i % 40 % 2 for i in range(40)] + [i // 4 % 2 for i in range(100)] + [0] * 60 + [1, 1, 0]
    rows = [(i, v, l) for i, (v, l) in enumerate(zip(vectors, labels))]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 32, 1), (n + 2, [float("nan")] * 32, 1), (n + 3, [None] * 32, 1), (n + 4, vectors[0], None),
             (n + 5, [1.0, 2.0], 0), (n + 6, [2.0, 4.0], 0), (n + 7, [float("inf")] * 32, 0), (n + 8, [], 0)]
    got = {r.vec_id: r for r in embed_dedup.link_vectors(spark.createDataFrame(
        [(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, key int").repartition(3)).collect()}
    assert len(got) == len(rows)

    def linked(i, j):
        (_, a, k), (_, b, l) = rows[i], rows[j]
        if i == j or k is None or k != l or not a or not b or len(a) != len(b) or not all(x is not None and np.isfinite(x) for x in a + b):
            return False
        a, b = np.array(a), np.array(b)
        return bool(a.any() and b.any()) and a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= 0.98
    want = [[j for j in range(len(rows)) if linked(i, j)] for i in range(len(rows))]
    assert all(got[i].n_links <= len(w) for i, w in enumerate(want))
    assert sum(r.n_links for r in got.values()) >= 0.95 * sum(map(len, want))
    for i, r in got.items():
        assert r.kept == (r.component_id == i) and (want[i] or r.component_id == i)
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert embed_dedup.link_vectors(empty).collect() == []


def test_recall_near_the_threshold():
    """Pairs at cosine 0.98 to 0.985, the hardest to find, share three of their nearest pivots nearly always."""
    rng = np.random.default_rng(4)
    for dim in (64, 256):
        x = rng.normal(size=(4000, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        model = embed_dedup.choose_pivots(x[:embed_dedup.SAMPLE])
        noise = rng.normal(size=x.shape)
        noise -= (noise * x).sum(1, keepdims=True) * x
        noise /= np.linalg.norm(noise, axis=1, keepdims=True)
        y = 0.981 * x + (1 - 0.981**2) ** 0.5 * noise
        a, b = (embed_dedup.nearest_pivots(v, *model) for v in (x, y))
        shared = (a[:, :, None] == b[:, None, :]).sum((1, 2))
        assert (shared[embed_dedup.SAMPLE:] >= embed_dedup.SHARED).mean() >= 0.97


def test_sum_of_squares_is_the_pairwise_sum():
    rng = np.random.default_rng(5)
    m = quality.Machine(4)
    m.weight, m.factors = rng.normal(size=m.weight.shape), rng.normal(size=m.factors.shape)
    bucket, value, stats = np.array([3, 9]), np.array([0.6, 0.8]), rng.normal(size=(1, 4))
    index, x = np.concatenate((bucket, (1 << quality.WORD_BITS) + np.arange(4))), np.concatenate((value, stats[0]))
    want = m.bias + m.weight[index] @ x + sum(m.factors[index[i]] @ m.factors[index[j]] * x[i] * x[j] for i in range(6) for j in range(i))
    assert m.logits(1, np.array([0, 0]), bucket, value, stats)[0][0] == pytest.approx(want)


def test_classifier_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op4_quality_classifier"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert len(got) > 50 and np.mean([r.predicted == r.quality for r in got]) > 0.95


def test_classifier_on_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, None, "a"), (2, "", 0, "b"), (2, "word " * 30000, 5, "c"), (None, "x", 1, "d")],
                                 "doc_id long, text string, n_chars long, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, quality.train(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, None), (2, 0), (None, 1)], "doc_id long, quality int")
    scores = [r.score for r in quality.score(docs, quality.train(docs, one)).collect()]
    assert len(scores) == 4 and all(0 <= s <= 1 for s in scores)
    assert quality.score(docs.limit(0), quality.train(docs.limit(0), one)).collect() == []


def test_raking_meets_its_targets(spark):
    rng = random.Random(6)
    cells = [(a, b, float(rng.randrange(1, 100))) for a in "pqr" for b in "xyz"]
    goals = {"a": {"p": 0.5, "q": 0.3, "r": 0.2}, "b": {"x": 0.1, "y": 0.6, "z": 0.3}}
    targets = {c: spark.createDataFrame(list(g.items()), "value string, share double") for c, g in goals.items()}
    got = {(r.a, r.b): r.fitted for r in mixing.rake(spark.createDataFrame(cells, "a string, b string, weight double"), targets).collect()}
    total = sum(w for *_, w in cells)
    w = np.array([x for *_, x in cells]).reshape(3, 3)
    for _ in range(500):
        w *= (np.array(list(goals["a"].values())) * total / w.sum(1))[:, None]
        w *= np.array(list(goals["b"].values())) * total / w.sum(0)
    assert [got[a, b] for a, b, _ in cells] == pytest.approx(w.ravel(), rel=1e-3)


def test_mixing(spark):
    rows = [(i, "t" * 400, None if i % 50 == 0 else "s0" if i % 3 else f"s{i % 4}", "en", "z") for i in range(4000)]
    rows += [(5000, None, "s0", None, "z"), (5001, "", "s9", "en", "z"), (None, "abc", "s0", "en", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, weight string")
    by = {"source": F.col("source"), "lang": F.col("lang")}
    got = mixing.mix(docs, by, {"source": 0.5, "lang": 0.9}).collect()
    assert len(got) == len(rows) and {r.row.weight for r in got} == {"z"} and all(0 <= r.probability <= 1 for r in got)
    have, share, kept = {}, {}, {}
    for r in got:
        have[r.row.source] = have.get(r.row.source, 0) + r.weight
        share[r.row.source] = share.get(r.row.source, 0) + r.weight * r.probability
        kept[r.row.source] = kept.get(r.row.source, 0) + r.weight * r.kept
    total = sum(v**0.5 for v in have.values())
    for s, v in have.items():
        assert share[s] / sum(share.values()) == pytest.approx(v**0.5 / total, rel=2e-3)
        assert kept[s] / sum(kept.values()) == pytest.approx(v**0.5 / total, abs=0.03)
    assert mixing.mix(docs.limit(0), by, {"source": 0.5}).collect() == []


def test_lm_scores(spark):
    rng = random.Random(8)
    def sentence():
        return " ".join(rng.choice(["a b c d", "e f g h", "i j k l"]) for _ in range(40))
    texts = [sentence() for _ in range(150)] + [None, "", " ", "a", "zz " * 20000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n int").repartition(3)
    frequent = lm_score.vocabulary(docs)
    net = lm_score.train(docs, frequent)
    got = {r.doc_id: r for r in lm_score.score(docs, frequent, net).collect()}
    assert [(got[i].n_tokens, got[i].log_likelihood, got[i].mean_log_probability) for i in (150, 151, 152)] == [(0, 0.0, None)] * 3
    import pyarrow as pa
    data, offsets = text_bytes(pa.array(texts[:1]))
    _, _, near = lm_score.Windows(frequent)(data, offsets)
    want = 0.0
    for w in near:
        hidden = np.tanh(sum(net.near[i][w[s + 2]] for i, s in enumerate(lm_score.SIDES)))
        logits = net.out @ hidden + net.bias
        want += logits[w[2]] - np.log(np.exp(logits).sum())
    assert got[0].log_likelihood == pytest.approx(float(want), rel=1e-4)
    shuffled = texts[0].split()
    rng.shuffle(shuffled)
    new = spark.createDataFrame([(1, texts[0]), (2, " ".join(shuffled))], "doc_id long, text string")
    ordered, mixed = (r.mean_log_probability for r in lm_score.score(new, frequent, net).orderBy("doc_id").collect())
    assert ordered > mixed
    assert lm_score.score(docs.limit(0), lm_score.vocabulary(docs.limit(0)), lm_score.train(docs.limit(0), frequent)).collect() == []


def test_lm_trains_on_every_word(spark, monkeypatch):
    texts = ["a b", "c", None, "", "d e f g", "a b", "x " * 3000]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    frequent = lm_score.vocabulary(docs)
    taken = []
    monkeypatch.setattr(lm_score.Network, "train", lambda self, windows, past: taken.append(windows.copy()))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    table = pa.Table.from_batches(list(lm_score._sequences(frequent)([batch])))
    list(lm_score._train(lm_score.Network().flat())(table.select(["classes"]).to_batches()))
    _, _, want = lm_score.Windows(frequent)(*text_bytes(batch.column(0)))
    assert sum(table.column("n").to_pylist()) == len(want) == 3009 and (np.concatenate(taken) == want).all()


def test_lm_step_follows_the_gradient():
    rng = np.random.default_rng(3)
    windows = rng.integers(0, 6, (50, 5)).astype(np.uint8)
    net = lm_score.Network()
    flat, past = net.flat(), [np.full(s, 1e9, np.float32) for s in lm_score.Network.shapes]
    net.train(windows, past)  # so slow that a step is the gradient, scaled
    step = (flat - net.flat()) / (lm_score.RATE / 1e9**0.5)

    def loss(at, by):
        moved = flat.copy()
        moved[at] += by
        return -lm_score.Network(moved).log_probabilities(windows).astype(float).mean()
    n = lm_score.CLASSES * lm_score.WIDTH
    for at in (0, 17, n + 40, 3 * n + 5, 4 * n + 3, 4 * n + 50, 5 * n + 2, 5 * n + 100):
        assert step[at] == pytest.approx((loss(at, 0.05) - loss(at, -0.05)) / 0.1, rel=0.05, abs=2e-3)


def test_lm_step_holds_the_classes_of_a_block_only():
    windows = np.random.default_rng(5).integers(0, 200, (lm_score.STEP, 5)).astype(np.uint8)
    net, past = lm_score.Network(), [np.full(s, 1e-4, np.float32) for s in lm_score.Network.shapes]
    one = lm_score.Network()
    net.train(windows, past)
    got = net.log_probabilities(windows)
    assert net.cells.shape == (lm_score.BLOCK, lm_score.CLASSES) and lm_score.BLOCK < lm_score.STEP
    assert got.mean() > one.log_probabilities(windows).mean()
    hidden = np.tanh(sum(net.near[i][windows[:, s + 2]] for i, s in enumerate(lm_score.SIDES)).astype(float))
    logits = hidden @ net.out.T + net.bias
    want = logits[np.arange(len(windows)), windows[:, 2]] - np.log(np.exp(logits).sum(1))
    assert np.abs(got - want).max() < 1e-4


def test_lm_counts_are_merged_seldom(monkeypatch):
    """A merge sorts all words held, so it may not come with every chunk."""
    texts = [f"a b w{i} w{i + 1} v{i % 7}" for i in range(600)] + [None, ""]
    monkeypatch.setattr(lm_score, "chunks", lambda offsets: ((i, i + 1) for i in range(len(offsets) - 1)))
    monkeypatch.setattr(lm_score, "COUNTED", 150)
    merges, real = [], np.unique
    monkeypatch.setattr(lm_score.np, "unique", lambda x, **how: (how.get("return_inverse") and merges.append(len(x)), real(x, **how))[1])
    table = pa.Table.from_batches(list(lm_score._count([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])])))
    got = {}
    for r in table.to_pylist():
        got[r["word"]] = got.get(r["word"], 0) + r["n"]
    hashes = lm_score.Words()(*text_bytes(pa.array(texts)))[3].view(np.int64)
    assert got == dict(zip(*(x.tolist() for x in real(hashes, return_counts=True)))) and sum(got.values()) == 3000
    assert len(merges) < 30


def test_lm_scores_are_of_words(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "CLASSES", lm_score.HASHED + 4)  # three words with classes of their own
    monkeypatch.setattr(lm_score.Network, "shapes", ((4, 68, lm_score.WIDTH), (68, lm_score.WIDTH), (68,)))
    monkeypatch.setattr(lm_score, "HELD", 50)
    rng = random.Random(12)
    texts = [" ".join(rng.choice(["a", "b", "c", *(f"r{int(rng.paretovariate(0.5))}" for _ in range(2))]) for _ in range(rng.randrange(30))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    words = lm_score.vocabulary(docs)
    net = lm_score.Network()
    new = [*texts, "a b", "never1 a never2", None, ""]
    split, known = lm_score.Words(), {}

    def hashes(text):
        return split(*text_bytes(pa.array([text], pa.string())))[3].tolist()
    for t in texts:
        for h in hashes(t):
            known[h] = known.get(h, 0) + 1
    rare = {h: n for h, n in known.items() if h not in words.frequent.tolist()}
    # scored in the driver: patches don't reach tasks
    table = pa.RecordBatch.from_arrays([pa.array([*range(len(new) - 1), None]), pa.array(new)], ["doc_id", "text"])
    got, counts = {}, {r.word: r.n for r in words.counts.collect()}
    for run in lm_score._classed(words, net.flat())([table.slice(0, 30), table.slice(30)]):
        run = pa.Table.from_batches([run])
        at = [(i, counts[w]) for i, w in enumerate(run.column("word")[0].as_py()) if w in counts]
        kind = pa.array([[(w & (2**64 - 1)) >> 58 for w in run.column("word")[0].as_py()]], pa.list_(pa.int8()))
        found = pa.table({"pos": pa.array([i for i, _ in at], pa.int32()), "n": pa.array([n for _, n in at], pa.int64())})
        for r in lm_score._whole(words.total, words.distinct)(run.append_column("kind", kind), found).to_pylist():
            got[r["doc_id"]] = (r["n_tokens"], r["log_likelihood"])
    assert len(got) == len(new)
    for i, t in enumerate(new[:-1]):
        near = lm_score.Windows(words)(*text_bytes(pa.array([t], pa.string())))[2]
        want = float(net.log_probabilities(near).sum())
        for h in hashes(t):
            if h not in words.frequent.tolist():
                same = [n for g, n in rare.items() if g >> 58 == h >> 58]
                want += float(np.log((rare.get(h, 0) + lm_score.ALPHA) / (sum(same) + lm_score.ALPHA * (len(same) + 1))))
        assert got[i] == (len(near), pytest.approx(want, rel=1e-4, abs=1e-4))


def test_lm_tells_unseen_words_from_rare_ones(spark):
    rng = random.Random(13)
    texts = [" ".join(f"w{min(3000, int(rng.paretovariate(0.4)))}" for _ in range(300)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    words = lm_score.vocabulary(docs)
    net = lm_score.Network()
    split = lm_score.Words()

    def hashed(text):
        return int(split(*text_bytes(pa.array([text], pa.string())))[3][0])
    counted = {r.word & (2**64 - 1): r.n for r in words.counts.collect()}
    rare = next(w for w in sorted({w for t in texts for w in t.split()}) if hashed(w) not in words.frequent.tolist() and counted[hashed(w)] > 1)
    unseen = next(f"u{i}" for i in range(10**5) if hashed(f"u{i}") >> 58 == hashed(rare) >> 58)  # of the same class
    new = spark.createDataFrame([(1, rare), (2, unseen), (None, unseen), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.log_likelihood for r in lm_score.score(new, words, net).collect()}
    assert got[1] - got[2] == pytest.approx(np.log((counted[hashed(rare)] + lm_score.ALPHA) / lm_score.ALPHA))
    assert got[None] == got[2] and got[3] == 0


def test_rows_at_the_driver_are_bounded_however_often_an_id_repeats(spark, monkeypatch):
    seen, real = [], quality.Machine.fit
    monkeypatch.setattr(quality.Machine, "fit", lambda self, documents, labels: seen.append(len(documents)) or real(self, documents, labels))
    rows = [(i if i < 40 else 77, f"text number {i}", 5) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(77, 1)], "doc_id long, quality int")
    quality.train(docs, labels, rows=20)
    assert len(seen) == 1 and 0 < seen[0] <= 20
    odd = docs.withColumnRenamed("n_chars", "n chars").withColumn("n_chars", F.lit("7")).withColumn("row", F.lit(1)).withColumn("score", F.lit("x"))
    got = quality.score(odd, quality.train(odd, labels, rows=20), whole=True)
    assert got.columns == ["row", "score"] and got.select("row.*").columns == odd.columns and got.count() == 3000


def test_raking_joins_cells_once_a_marginal(spark, monkeypatch):
    """Every join of small tables is a broadcast made at the driver, round after round."""
    plans, real = [], mixing.materialize

    def seen(df, *where):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, *where)
    monkeypatch.setattr(mixing, "materialize", seen)
    cells = spark.createDataFrame([(a, b, float(1 + i + 3 * j)) for i, a in enumerate("vw") for j, b in enumerate("xyz")], "a string, b string, weight double")
    mixing.rake(cells, {c: mixing.tempered(cells, c, 0.5) for c in "ab"})
    rounds = [p for p in plans if "scale_1" in p]
    assert rounds
    for p in rounds:  # one for each marginal, and the first one's again below the second one's sums
        assert sum("Join " in x for x in p.splitlines()) == 3


def test_classifier_holds_its_rows_once(spark, monkeypatch):
    """The numbers of all rows are views of the buffers received, one beside the other."""
    held, real = [], quality.Machine.fit

    def fit(machine, documents, labels):
        held.extend(documents)
        return real(machine, documents, labels)
    monkeypatch.setattr(quality.Machine, "fit", fit)
    docs = spark.createDataFrame([(i, f"some words of text {i}", 10) for i in range(40)], "doc_id long, text string, n_chars long").coalesce(1)
    quality.train(docs, docs.select("doc_id", (docs.doc_id % 2).cast("int").alias("quality")))
    assert len(held) > 20
    for a, b in zip(held, held[1:]):
        assert all(x.ctypes.data + x.nbytes == y.ctypes.data for x, y in zip(a, b))


def test_lm_step_writes_to_what_is_kept():
    """A step makes no large arrays anew, and goes where it went when it did."""
    import tracemalloc
    rng = np.random.default_rng(9)
    net, past = lm_score.Network(), [np.full(s, 1e-4, np.float32) for s in lm_score.Network.shapes]
    near, out, bias = (x.astype(float) for x in (net.near, net.out, net.bias))
    seen = [x.astype(float) for x in past]
    for k in range(4):
        windows = rng.integers(0, 256, (lm_score.STEP if k < 3 else 77, 5)).astype(np.uint8)
        tracemalloc.start()
        net.train(windows, past)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 150_000 or k in (0, 3)
        n, sides, target = len(windows), [windows[:, s + 2] for s in lm_score.SIDES], windows[:, 2]
        hidden = np.tanh(sum(near[i][c] for i, c in enumerate(sides)))
        p = np.exp(hidden @ out.T + bias)
        p /= p.sum(1, keepdims=True)
        p[np.arange(n), target] -= 1
        back, g_near = p @ out * (1 - hidden * hidden) / n, np.zeros_like(near)
        for i, c in enumerate(sides):
            np.add.at(g_near[i], c, back)
        for x, g, s in zip((near, out, bias), (g_near, p.T @ hidden / n, p.sum(0) / n), seen):
            s += g * g
            x -= lm_score.RATE * g / np.sqrt(s)
    for got, want in zip((net.near, net.out, net.bias), (near, out, bias)):
        assert np.abs(got - want).max() < 1e-4


@pytest.mark.parametrize("frequent", [0, 1, 191, "alike"])
def test_lm_classes_of_words(frequent):
    rng = np.random.default_rng(6)
    words = rng.integers(0, 2**64, 191 if frequent == "alike" else frequent, dtype=np.uint64)
    if frequent == "alike":  # first bits that don't tell words apart
        words[1] = words[0] ^ np.uint64(1)
    words = np.sort(words)
    hashes = np.concatenate((words, rng.integers(0, 2**64, 5000, dtype=np.uint64), words ^ np.uint64(2), [np.uint64(0)]))
    got = lm_score.Windows(lm_score.Vocabulary(words, None, None, None)).classes(hashes)
    place = {int(w): i + 1 for i, w in enumerate(words)}
    assert got.dtype == np.uint8 and got.tolist() == [place.get(int(h), 192 + (int(h) >> 58)) for h in hashes]


def test_lm_chunks_stay_in_cache():
    offsets = np.arange(0, 3_000_000, 1000)
    ranges = list(lm_score.chunks(offsets))
    assert [x[0] for x in ranges] == [0, *(x[1] for x in ranges[:-1])] and ranges[-1][1] == len(offsets) - 1
    assert max(offsets[high] - offsets[low] for low, high in ranges) <= 1 << 18
