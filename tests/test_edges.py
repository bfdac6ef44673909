"""Null, empty and rank-deficient input, and both sides of every size switch."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import exact
from lexigear.operators import decomposition as dc
from lexigear.operators import features as ft
from lexigear.operators import search as se
from lexigear.operators import tokens as tk
from lexigear.operators import weighting as wt
from lexigear.plans import lsa
from lexigear.sources import dumps, tables

TEXTS = ["wolves hunt cats", None, "", "the cats chase boxes", "wolf cat box chase", "hunt hunt hunt"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"t{i}", t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, title string, text string").persist()


def tokens(df):
    return {r.doc_id: r.features for r in df.collect()}


@pytest.mark.parametrize("words", [["cats", None], ["cats"], [None], []])
def test_stop_words_shipped_and_joined(spark, docs, words):
    raw = docs.withColumn("features", F.split("text", " "))
    listed = spark.createDataFrame([(w,) for w in words], "term string")
    sides = [tokens(tk.drop_words(raw, listed, max_list=n)) for n in (100, 0)] + [tokens(tk.drop_words(raw, words))]
    expected = {i: [w for w in (t.split(" ") if t is not None else []) if w not in words] for i, t in enumerate(TEXTS)}
    assert sides == [expected] * 3


def test_lemmas_shipped_and_joined(docs):
    shipped, joined = (tokens(tk.tokens_lemma(docs, max_map=n)) for n in (1000, 0))
    assert shipped == joined
    assert shipped[0] == ["wolf", "hunt", "cat"] and shipped[1] == shipped[2] == []


def test_only_tokens_pass_through_python(docs):
    plan = tk.tokens_lemma(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan


@pytest.mark.parametrize("tokenize", [tk.tokens_regex, tk.tokens_exercise, tk.tokens_split, tk.tokens_lemma])
def test_fit_with_null_text(docs, tokenize):
    model = lsa.fit(tokenize(docs).select("doc_id", "title", "features"), 10, 2)
    rows = {r.doc_id: r.u for r in model.documents.collect()}
    assert rows[1] == [0.0] * model.k and len(rows) == len(TEXTS)


@pytest.mark.parametrize("texts", [[], [None], ["same words here"] * 3])
def test_fit_without_weights(spark, texts):
    """No documents, no terms, or no weight that differs from zero: no concepts."""
    rows = [(i, "t", t) for i, t in enumerate(texts)]
    docs = tk.tokens_regex(spark.createDataFrame(rows, "doc_id long, title string, text string"))
    model = lsa.fit(docs.select("doc_id", "title", "features"), 10, 2)
    assert model.k == 0 and model.concepts().count() == 0
    assert [r.u for r in model.documents.collect()] == [[]] * len(texts)


def matrix(spark, dense):
    rows = [(i, [j for j, x in enumerate(r) if x], [float(x) for x in r if x]) for i, r in enumerate(dense.tolist())]
    return spark.createDataFrame(rows, "doc_id long, ids array<int>, weights array<double>").persist()


@pytest.mark.parametrize("block", [None, 3, 8])
def test_solver_by_block_width(spark, block):
    dense = np.random.default_rng(1).standard_normal((60, 20))
    dense[:, 15:] = dense[:, :5]  # rank 15
    sigma, v = dc.factorize(matrix(spark, dense), 20, 12, block=block)
    expected = np.linalg.svd(dense, compute_uv=False)
    assert np.allclose(sigma, expected[:12]) and np.allclose(v.T @ v, np.eye(12), atol=1e-8)
    sigma, _ = dc.factorize(matrix(spark, dense), 20, 20, block=block)
    assert len(sigma) == 15


def test_solver_keeps_small_concepts(spark):
    """A value of 1e-8 of the largest is above the default limit, as a zero is below it."""
    dense = np.diag([1.0, 1e-8, 0.0])
    sigma, _ = dc.factorize(matrix(spark, dense), 3, 3)
    assert np.allclose(sigma, [1.0, 1e-8], rtol=1e-6)
    assert len(dc.factorize(matrix(spark, dense), 3, 3, r_cond=1e-7)[0]) == 1


def test_solver_that_does_not_settle_returns_what_it_has(spark):
    dense = np.random.default_rng(2).standard_normal((80, 60))
    with pytest.warns(UserWarning, match="have not settled"):
        sigma, v = dc.factorize(matrix(spark, dense), 60, 4, block=4, max_passes=2)
    assert len(sigma) == 4 and v.shape == (60, 4)


def test_block_products_in_slices(spark, monkeypatch):
    dense = np.random.default_rng(3).standard_normal((30, 10))
    x = np.random.default_rng(4).standard_normal((10, 100))
    monkeypatch.setattr(dc, "MAX_SHIPPED_BYTES", 1)
    assert np.allclose(dc.gram_times(matrix(spark, dense), x), dense.T @ dense @ x)


@pytest.mark.parametrize("size", [ft.UNROLL_LIMIT, ft.UNROLL_LIMIT + 1])
def test_scaling_of_a_null_vector(spark, size):
    rows = [(0, [1.0] * size), (1, None), (2, [3.0] * size)]
    df = spark.createDataFrame(rows, "i int, features array<double>")
    for scale, value in ((ft.standardize, 2**-0.5), (ft.normalize_pop, 1.0)):
        found = {r.i: r.features for r in scale(df).collect()}
        assert found[1] is None
        assert np.allclose(found[0], -value) and np.allclose(found[2], value)


def test_one_hot_of_many_and_null_values(spark):
    df = spark.range(3000).select(F.col("id").cast("double").alias("d"), F.col("id").cast("string").alias("c"), F.lit(None).cast("string").alias("none"))
    row = ft.one_hot(df, "d", ("c", "none"), ()).where("d = 7").head().features
    assert len(row) == 3001 and row[0] == 7.0 and sum(row[1:]) == 1.0


def test_vocabulary_broadcast_and_joined(docs):
    found = tk.tokens_regex(docs)
    vocab = wt.vocabulary(found, 5)
    sides = [sorted(map(tuple, wt.tfidf(found, vocab, n).collect())) for n in (5, wt.MAX_BROADCAST_TERMS + 1)]
    assert sides[0] == sides[1]


def test_queries_are_lemmatized_like_documents(spark, docs, folder):
    plain = docs.where("doc_id = 4 OR doc_id = 5")
    lexicon = tk.lexicon_of(plain.select(F.split("text", " ").alias("features")))
    model = lsa.fit(tk.tokens_lemma(plain, lexicon=lexicon).select("doc_id", "title", "features"), 10, 2, tokenizer="nlp", lexicon=lexicon)
    dc.save_model(model, folder)
    for m in (model, dc.load_model(spark, folder)):
        assert lsa.query_terms(m, "Wolves, cats and zebras") == ["wolf", "cat", "zebras"]
        assert se.search_cosine(m, lsa.query_terms(m, "wolves cats"), 1).head().doc_id == 4


def test_grid_times_each_run(docs):
    runs = lsa.grid(docs, {"regex": tk.tokens_regex}, (5,), (1, 2))
    assert len({r["runtime_seconds"] for r in runs}) == 2
    shared = lsa.grid(docs, {"regex": tk.tokens_regex}, (5,), (1, 2), shared=True)
    assert len({r["runtime_seconds"] for r in shared}) == 1
    assert [round(r["energy"], 9) for r in runs] == [round(r["energy"], 9) for r in shared]


def test_text_before_the_first_block(spark, folder):
    good = '<doc id="1" url="u" title="t">\nbody\n</doc>\n'
    spark.createDataFrame([(f'see id="9" url="x" title="y">\nnot one\n</doc>\n{good}',), (good.replace("1", "2"),)], "value string").repartition(2).write.text(folder)
    read = sorted(r.doc_id for r in dumps.read_documents(spark, folder).collect())
    assert read == sorted(r.doc_id for r in dumps.parse_documents(dumps.read_dump(spark, folder)).collect()) == ["1", "2"]


def test_stable_ids_of_copies(spark):
    df = spark.createDataFrame([(1, "a")] * 7 + [(2, None)], "n int, s string")
    found = tables.with_stable_id(df, rows_per_task=3)
    assert found.count() == 8 and found.select("point_id").distinct().count() == 8


GIVEN = ["f1_top_terms_given", "f2_top_docs_given", "f3_concept_table_given", "f4_top_docs_with_genres_given", "c7_compare_concepts_given"]


@pytest.mark.parametrize("name", GIVEN)
def test_given_factors_stay_tables(spark, monkeypatch, name):
    """The whole result of the SQL, and no table comes to the driver on the way."""
    sf = "/root/testdata/sf0.001"

    def refuse(self, *a):
        raise AssertionError("a table came to the driver")

    with monkeypatch.context() as m:
        m.setattr(type(spark.range(1)), "toArrow", refuse)
        found = getattr(exact, name)(spark, sf)
    wanted = duckdb.sql(exact.SQL[name].replace("FROM embeddings", f"FROM '{sf}/embeddings.parquet'"))
    rows = lambda r: sorted(map(repr, r))
    assert rows(tuple(r[c] for c in wanted.columns) for r in found.collect()) == rows(wanted.fetchall())
