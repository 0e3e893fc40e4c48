"""The pipeline, stage by stage, on the smallest tables, and what it does with planted cases."""

import pytest
from test_ngram_join import brute
from test_text_operators import plain_dedup

import corpus_pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    root = tmp_path_factory.mktemp("stages")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{root}/{i}")
        out.append(docs)
        docs = spark.read.parquet(f"{root}/{i}")
    return [*out, docs]


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_stay(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_classifier_keeps_good_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    assert all((d in kept) == (q == 1) for d, q in labels.items())


def test_lines(stages):
    want = plain_dedup(rows(stages[1]))
    assert dict(rows(stages[2])) == {d: t for d, (t, n) in want.items() if t or not n}
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_one_of_each_group(stages):
    groups = brute(rows(stages[2]), 5, 80)
    assert {d for d, _ in rows(stages[3])} == {d for d, _, c in groups if d == c}


def test_sample_and_round_trip(stages):
    before, after = dict(rows(stages[3])), dict(rows(stages[4]))
    assert after and all(before[d] == t for d, t in after.items())
    assert dict(rows(stages[5])) == after and all(len(r.ids) == r.n_tokens > 0 for r in stages[5].collect())


def test_odd_documents_pass_through(spark):
    docs = spark.createDataFrame([(None, None, None, None, None, 1), (1, None, "en", "s", None, 2), (1, "", None, None, 0, 3), (2, "a b c", "en", "s", 5, 4)],
                                 "doc_id long, text string, lang string, source string, n_chars long, row long")
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs.limit(0), SF).collect()
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert len(stage(spark, docs, SF).collect()) <= 4, name
    assert len(corpus_pipeline.one_of_each_group(spark, docs, SF).collect()) == 4
