"""Language ID against a plain-Python naive Bayes, its defined cases, and held-out accuracy."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from runlake.llm import langid
from runlake.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, score string"


def grams(text):
    """Buckets of a text's n-grams, number by number."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    if not words:
        return []
    codes = [0]
    for i, w in enumerate(words):
        codes += ([0] if i else []) + [ord(c) for c in w]
    if not text.lower()[-1].isalpha():
        codes.append(0)
    found = []
    for size in langid.SIZES:
        for i in range(len(codes) - size + 1):
            v = (size + sum(c * int(langid._ODD[j]) for j, c in enumerate(codes[i:i + size]))) % 2**64
            found.append((v ^ v >> 31) * int(langid._ODD[4]) % 2**64 >> 64 - langid.BITS)
    return found


def brute(learn, texts):
    docs, counts = Counter(), defaultdict(Counter)
    for text, lang in learn:
        if lang is not None:
            docs[lang] += 1
            counts[lang].update(grams(text))
    out = []
    for text in texts:
        own = grams(text)
        if not own or not docs:
            out.append(("und", 0.0))
            continue
        score = {k: math.log(n / sum(docs.values())) + sum(math.log((counts[k][g] + langid.SMOOTHING) / (
            sum(counts[k].values()) + langid.SMOOTHING * 2**langid.BITS)) for g in own) for k, n in docs.items()}
        best = min(sorted(score), key=lambda k: -score[k])
        out.append((best, 1 / sum(math.exp(v - score[best]) for v in score.values())))
    return out


def test_equals_plain_naive_bayes(spark):
    rng = random.Random(4)
    pools = {"aa": ["the", "this", "Then", "that's", "cat"], "bb": ["ça", "où", "École", "le", "les"], "cc": ["мир", "это", "the", "ИЛИ"]}
    rows = []
    for i in range(90):
        lang = rng.choice(sorted(pools))
        text = rng.choice(["", " ", "12 "]) + rng.choice([" ", ", ", "--"]).join(rng.choices(pools[lang], k=rng.randrange(1, 9))) + rng.choice(["", ".", "\n"])
        rows.append((i, text, lang, "x"))
    rows += [(90, None, "aa", None), (91, "", "bb", None), (92, "12 34!", "cc", None), (93, "the cat", None, None), (94, "a", "dd", None),
             (7, rows[7][1], rows[7][2], "x"), (None, "the cat", "aa", None), (95, "x" * 300, "aa", None)]
    learn = [(t, l) for d, t, l, _ in rows if d is not None and zlib.crc32(str(d).encode()) % 5]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    model = langid.train(docs.filter(F.col("doc_id").isNotNull() & ~langid.held_out(F.col("doc_id"))))
    got = sorted(((r.doc_id is None, r.doc_id, r.lang_pred, r.score) for r in langid.predict(docs, model).collect()), key=str)
    want = sorted(((d is None, d, *w) for (d, _, _, _), w in zip(rows, brute(learn, [r[1] for r in rows]))), key=str)
    assert [(g[0], g[1], g[2]) for g in got] == [(w[0], w[1], w[2]) for w in want]
    assert all(abs(g[3] - w[3]) < 1e-9 and 0 <= g[3] <= 1 for g, w in zip(got, want))


def test_long_texts_go_in_steps(spark, monkeypatch):
    monkeypatch.setattr(langid, "STEP", 7)
    text = "la maison où l'école est " * 40
    docs = spark.createDataFrame([(1, text, "fr", None), (2, "the house " * 30, "en", None)], SCHEMA)
    model = langid.train(docs)
    monkeypatch.setattr(langid, "STEP", 1 << 15)
    again = langid.train(docs)
    assert (model.shares == again.shares).all() and model.languages == ["en", "fr"]
    assert {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()} == {1: "fr", 2: "en"}


def test_nothing_to_learn_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "words", None, None), (2, None, None, None)], SCHEMA)
    assert langid.train(docs) is None
    assert [(r.lang_pred, r.score) for r in langid.predict(docs, None).collect()] == [("und", 0.0)] * 2
    empty = spark.createDataFrame([], SCHEMA)
    assert langid.train(empty) is None and langid.predict(empty, langid.train(docs.withColumn("lang", F.lit("en")))).collect() == []


def test_ties_take_the_first_language_and_many_languages(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "same words", "b", None), (2, "same words", "a", None)], SCHEMA)
    model = langid.train(docs)
    assert {(r.lang_pred, round(r.score, 9)) for r in langid.predict(docs, model).collect()} == {("a", 0.5)}
    many = spark.createDataFrame([(i, f"word{i} text", f"l{i:03}", None) for i in range(70)], SCHEMA).coalesce(1)
    assert len(langid.train(many).languages) == 70 and langid.train(many).shares.shape == (70, 1 << langid.BITS)
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 69)
    with pytest.raises(ValueError):
        langid.train(many)


def test_held_out_accuracy(spark):
    got = QUERIES["op11_language_id"](spark, "/root/testdata/sf0.01")
    langs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.join(langs, "doc_id").collect()
    assert len(rows) == 1000
    held = [r for r in rows if r.held_out]
    assert len(held) > 150 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
