import math

import numpy as np
import pytest
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.sql import functions as F

from lexigear.operators import concepts as co
from lexigear.operators import decomposition as dc
from lexigear.operators import search as se
from lexigear.operators import tokens as tk
from lexigear.operators import weighting as wt
from lexigear.plans import lsa

DOCS = [
    (0, "sun sun moon star".split()),
    (1, "moon star comet comet rare".split()),
    (2, "star river".split()),
    (3, "river river bank star moon".split()),
    (4, ["unseen"]),
    (5, []),
    (6, "bank sun comet star".split()),
    (7, "sun river moon".split()),
    (8, "comet bank bank".split()),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"doc {i}", f) for i, f in DOCS]
    return spark.createDataFrame(rows, "doc_id long, title string, features array<string>").persist()


def dense(matrix, num_terms):
    rows = matrix.orderBy("doc_id").select("ids", "weights").collect()
    out = np.zeros((len(rows), num_terms))
    for i, r in enumerate(rows):
        out[i, r.ids] = r.weights
    return out


def by_hand(terms):
    n = len(DOCS)
    df = {t: sum(t in f for _, f in DOCS) for t in terms}
    return np.array([[math.log(n / df[t]) * f.count(t) / len(f) if f else 0.0 for t in terms] for _, f in DOCS])


def test_counts(docs):
    rows = {(r.doc_id, r.term): (r.tf, r.doc_len) for r in wt.term_freqs(docs).collect()}
    assert rows == {(i, t): (f.count(t), len(f)) for i, f in DOCS for t in f}
    assert {r.doc_id: r.doc_len for r in wt.doc_lengths(docs).collect()} == {i: len(f) for i, f in DOCS}
    terms = {t for _, f in DOCS for t in f}
    assert {r.term: r.df for r in wt.doc_freqs(docs).collect()} == {t: sum(t in f for _, f in DOCS) for t in terms}


def test_counting_does_not_shuffle(docs):
    plan = wt.term_freqs(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryTableScan")[0]


def test_vocabulary_ties_and_idf(docs):
    rows = wt.vocabulary(docs, 4).orderBy("term_id").collect()
    # star 5, moon 4, then bank, comet, river, sun with 3 each.
    assert [(r.term_id, r.term, r.df) for r in rows] == [(0, "star", 5), (1, "moon", 4), (2, "bank", 3), (3, "comet", 3)]
    assert rows[0].idf == pytest.approx(math.log(9 / 5))


def test_term_in_every_document_has_weight_zero(spark):
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"])], "doc_id long, features array<string>")
    weights = {(r.doc_id, r.term): r.weight for r in wt.tfidf(docs, wt.vocabulary(docs, 10), 10).collect()}
    assert weights == {(1, "a"): 0.0, (2, "a"): 0.0, (1, "b"): pytest.approx(math.log(2) / 2)}


def test_matrix(docs):
    vocab = wt.Vocabulary.fetch(wt.vocabulary(docs, 5))
    matrix = wt.doc_term_matrix(docs, vocab)
    np.testing.assert_allclose(dense(matrix, 5), by_hand(vocab.terms))
    long = {(r.doc_id, r.term_id): r.weight for r in wt.matrix_entries(matrix).collect()}
    joined = wt.tfidf(docs, wt.vocabulary(docs, 5), 5).collect()
    assert long == {(r.doc_id, r.term_id): pytest.approx(r.weight) for r in joined}


def test_corpus_stats(docs):
    row = wt.corpus_stats(docs, 3).head()
    assert (row.num_docs, row.num_tokens, row.empty_docs, row.num_terms, row.vocabulary_size) == (9, 27, 1, 8, 3)


def test_full_rank_factors(docs):
    model = lsa.fit(docs, 6, 6)
    a = by_hand(model.vocab.terms)
    u = np.array([r.u for r in model.documents.orderBy("doc_id").collect()])
    np.testing.assert_allclose(u @ np.diag(model.sigma) @ model.v.T, a, atol=1e-12)
    np.testing.assert_allclose(u.T @ u, np.eye(model.k), atol=1e-10)
    np.testing.assert_allclose(model.v.T @ model.v, np.eye(model.k), atol=1e-12)
    np.testing.assert_allclose(model.sigma, np.linalg.svd(a, compute_uv=False)[: model.k], atol=1e-12)
    assert all(column[np.abs(column).argmax()] > 0 for column in model.v.T)


def random_matrix(spark, rows, terms, rank=None, seed=3):
    rng = np.random.default_rng(seed)
    if rank is None:
        a = rng.random((rows, terms)) * (rng.random((rows, terms)) < 0.05)
    else:
        a = rng.random((rows, rank)) @ rng.random((rank, terms))
    frame = [(i, np.flatnonzero(r).tolist(), r[r != 0].tolist()) for i, r in enumerate(a)]
    return a, spark.createDataFrame(frame, "doc_id long, ids array<int>, weights array<double>").repartition(5).persist()


def test_one_pass_product(spark):
    a, frame = random_matrix(spark, 300, 70)
    x = np.random.default_rng(0).random((70, 45))
    np.testing.assert_allclose(dc.gram_times(frame, x), a.T @ (a @ x), rtol=1e-12)


def test_many_documents_per_step(spark, monkeypatch):
    monkeypatch.setattr(dc, "DOUBLES_PER_STEP", 500)
    a, frame = random_matrix(spark, 120, 40)
    x = np.random.default_rng(0).random((40, 33))
    np.testing.assert_allclose(dc.gram_times(frame, x), a.T @ (a @ x), rtol=1e-12)
    v, s = np.linalg.svd(a)[2][:3].T, np.array([1.0, 2.0, 3.0])
    u = {r.doc_id: r.u for r in dc.project(frame, s, v).collect()}
    np.testing.assert_allclose(np.array([u[i] for i in range(120)]), a @ v / s, atol=1e-12)


def test_truncated_factors_against_other_solvers(spark):
    a, frame = random_matrix(spark, 900, 600)
    sigma, v = dc.factorize(frame, 600, 12)
    exact = np.linalg.svd(a, full_matrices=False)
    np.testing.assert_allclose(sigma, exact[1][:12], rtol=1e-10)
    # The same subspace, whatever the signs.
    np.testing.assert_allclose(np.abs(np.diag(v.T @ exact[2][:12].T)), 1.0, atol=1e-6)
    rows = frame.rdd.map(lambda r: Vectors.sparse(600, r.ids, r.weights))
    np.testing.assert_allclose(sigma, RowMatrix(rows).computeSVD(12).s.toArray(), rtol=1e-8)


def test_restart_and_low_rank(spark, monkeypatch):
    monkeypatch.setattr(dc, "MAX_BLOCKS", 4)
    monkeypatch.setattr(dc, "SMALL", 10)
    a, frame = random_matrix(spark, 700, 500)
    sigma, _ = dc.factorize(frame, 500, 10)
    np.testing.assert_allclose(sigma, np.linalg.svd(a, compute_uv=False)[:10], rtol=1e-9)
    b, low = random_matrix(spark, 80, 300, rank=4)
    sigma, v = dc.factorize(low, 300, 10)
    assert len(sigma) == 4 and v.shape == (300, 4)
    np.testing.assert_allclose(sigma, np.linalg.svd(b, compute_uv=False)[:4], rtol=1e-9)


def test_wide_factors_are_shipped_in_blocks(docs, monkeypatch):
    whole = lsa.fit(docs, 6, 6)
    monkeypatch.setattr(dc, "MAX_SHIPPED_BYTES", 6 * 8 * 2)
    parts = lsa.fit(docs, 6, 6)
    one, two = (np.array([r.u for r in m.documents.orderBy("doc_id").collect()]) for m in (whole, parts))
    np.testing.assert_allclose(np.abs(one), np.abs(two), atol=1e-9)


@pytest.fixture(scope="module")
def model(docs):
    return lsa.fit(docs, 6, 6, keep=True)


def scores(df, key="doc_id"):
    return [(r[key], r.score) for r in df.collect()]


def ranked(values, ids, n=10):
    pairs = [(i, round(float(s), 9)) for i, s in zip(ids, values) if not np.isnan(s)]
    return sorted(pairs, key=lambda p: (-p[1], p[0]))[:n]


def close(found, expected):
    assert [i for i, _ in found] == [i for i, _ in expected]
    np.testing.assert_allclose([s for _, s in found], [s for _, s in expected], atol=2e-9)


def unit_rows(a):
    with np.errstate(invalid="ignore"):
        return a / np.linalg.norm(a, axis=1, keepdims=True)


def query_row(model, terms):
    q = np.zeros(len(model.vocab))
    for t in terms:
        if t in model.vocab.terms:
            i = list(model.vocab.terms).index(t)
            q[i] += model.vocab.idf[i]
    return q


def test_searches(model):
    a = by_hand(model.vocab.terms)
    # With as many concepts as terms, concept space is term space.
    assert model.k == np.linalg.matrix_rank(a) == 6
    ids = range(len(a))
    q = query_row(model, ["sun", "bank", "sun", "nothing"])
    close(scores(se.search(model, ["sun", "bank", "sun", "nothing"])), ranked(a @ q, ids))
    close(scores(se.search_cosine(model, ["sun", "bank", "sun"])), ranked(unit_rows(a) @ q / np.linalg.norm(q), ids))
    close(scores(se.similar_docs(model, 3)), ranked(unit_rows(a) @ unit_rows(a)[3], ids))
    t = list(model.vocab.terms).index("sun")
    close(scores(se.similar_terms(model, "sun"), "term_id"), ranked(unit_rows(a.T) @ unit_rows(a.T)[t], range(6)))
    close(scores(se.docs_for_term(model, "sun")), ranked(unit_rows(a)[:, t], ids))
    close(scores(se.docs_for_term(model, "sun", normalized=False)), ranked(a[:, t], ids))


def test_unknown_words(model):
    assert {s for _, s in scores(se.search(model, ["nothing"]))} == {0.0}
    assert scores(se.search_cosine(model, ["nothing"])) == []
    assert scores(se.search_cosine(model, ["nothing"], docs="U")) == []
    with pytest.raises(KeyError):
        se.similar_terms(model, "nothing")
    with pytest.raises(KeyError):
        se.similar_docs(model, 99)


def test_batch_search_equals_single_searches(spark, model):
    queries = {1: ["sun"], 2: ["bank", "moon"], 3: ["nothing"], 4: ["comet", "comet"]}
    frame = spark.createDataFrame(list(queries.items()), "query_id long, features array<string>")
    for cosine, single in ((False, se.search), (True, se.search_cosine)):
        for per_pass in (1000, 2):
            rows = se.batch_search(model, frame, n=3, cosine=cosine, queries_per_block=per_pass).orderBy("query_id", "rank").collect()
            assert {r.query_id for r in rows} == {1, 2, 4}
            for query, terms in queries.items():
                if query != 3:
                    close([(r.doc_id, r.score) for r in rows if r.query_id == query], scores(single(model, terms, n=3)))


def test_batch_search_with_many_copies(spark):
    rows = [(i, f"doc {i}", ["sun", "moon"] if i % 3 else ["star"]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, title string, features array<string>").repartition(6)
    model = lsa.fit(docs, 10, 3)
    frame = spark.createDataFrame([(1, ["sun"])], "query_id long, features array<string>")
    found = se.batch_search(model, frame, n=5).orderBy("rank").collect()
    assert [r.doc_id for r in found] == [1, 2, 4, 5, 7]


def test_model_round_trip(spark, model, folder):
    dc.save_model(model, folder)
    back = dc.load_model(spark, folder)
    assert scores(se.search(back, ["sun"])) == scores(se.search(model, ["sun"]))
    np.testing.assert_array_equal(back.v, model.v)


def test_concepts(model):
    terms = co.top_terms(model, 2, 3).collect()
    for c in (0, 1):
        order = np.argsort(-model.v[:, c], kind="stable")[:3]
        assert [r.term_id for r in terms if r.concept == c] == order.tolist()
    docs = co.top_docs(model, 2, 3)
    u = {r.doc_id: r.u for r in model.documents.collect()}
    for c in (0, 1):
        best = sorted(u, key=lambda d: (-u[d][c], d))[:3]
        assert [r.doc_id for r in docs.where(F.col("concept") == c).orderBy("rank").collect()] == best
    table = co.concept_table(co.top_terms(model, 2, 3), docs).orderBy("concept").collect()
    assert len(table) == 2 and table[0].terms.count(",") == 2


def test_top_docs_are_cut_before_the_shuffle(model):
    plan = co.top_docs(model)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_truncate(model):
    two = model.truncate(2)
    assert two.k == 2 and two.v.shape[1] == 2
    assert {len(r.u) for r in two.documents.collect()} == {2}


def test_normalize_rows_drops_zero_rows(model):
    rows = dc.normalize_rows(dc.scale_docs(model), "us").collect()
    assert {r.doc_id for r in rows} == {0, 1, 2, 3, 6, 7, 8}
    np.testing.assert_allclose([np.linalg.norm(r.us) for r in rows], 1.0)
    lengths = {r.term: np.linalg.norm(r.vs) for r in dc.scale_terms(model).collect()}
    a = by_hand(model.vocab.terms)
    assert lengths == {t: pytest.approx(np.linalg.norm(a[:, i])) for i, t in enumerate(model.vocab.terms)}


def test_genres(spark):
    df = spark.createDataFrame([("drama, comedy/ crime ,a,b,c",), ("war",), ("",)], "genre string")
    rows = [r.g for r in df.select(co.genre_labels(F.col("genre")).alias("g")).collect()]
    assert rows == [["drama", "comedy", "crime", "a", "b"], ["war"], []]


def test_grid_and_best(spark):
    docs = spark.createDataFrame([(i, " ".join(f)) for i, f in DOCS], "doc_id long, text string")
    runs = lsa.grid(docs, num_freqs=(3, 6), ks=(1, 2))
    assert len(runs) == 8 and {r["tokenizer"] for r in runs} == {"regex", "nlp"}
    frame = spark.createDataFrame([tuple(r.values()) for r in runs], lsa.RUN_SCHEMA)
    best = lsa.pick_best(frame).head()
    assert best.energy == pytest.approx(max(r["energy"] for r in runs))


def test_movies(spark):
    rows = [("Up", "drama", "The dogs run"), ("Up", "war", "A dog and cats"), ("In", "war", "cat dog house")]
    model = lsa.movie_lsa(spark.createDataFrame(rows, "Title string, Genre string, Plot string"), 10, 2)
    listed = co.top_docs(model).collect()
    assert {r.title for r in listed} == {"Up", "In"} and len({r.doc_id for r in listed}) == 3


# Directions kept as a table


def sparse_rows(spark, dense):
    rows = [([int(j) for j in np.flatnonzero(r)], [float(r[j]) for j in np.flatnonzero(r)]) for r in dense]
    return spark.createDataFrame(rows, "ids array<int>, weights array<double>").persist()


def decaying(rows=90, columns=100, seed=4):
    rng = np.random.default_rng(seed)
    left, right = (np.linalg.qr(rng.standard_normal((n, 80)))[0] for n in (rows, columns))
    return left * np.exp(-np.arange(80) / 4) @ right.T


def test_directions_in_a_table(spark, monkeypatch):
    """The same factors as on the driver, with restarts, several ranges and a deeper tree."""
    from lexigear.operators import blocks

    dense = decaying()
    frame = sparse_rows(spark, dense)
    exact = np.linalg.svd(dense, compute_uv=False)
    local = dc.factorize(frame, 100, 6, block=10)
    monkeypatch.setattr(blocks, "RANGE_BYTES", 1)
    monkeypatch.setattr(blocks, "TOP_BYTES", 0)
    table = dc.factorize(frame, 100, 6, block=10, local_bytes=0)
    np.testing.assert_allclose(table[0], exact[:6], rtol=1e-12)
    np.testing.assert_allclose(table[0], local[0], rtol=1e-12)
    np.testing.assert_allclose(table[1], local[1], atol=1e-7)
    np.testing.assert_allclose(table[1].T @ table[1], np.eye(6), atol=1e-12)


def test_tree_of_small_decompositions(spark, monkeypatch):
    from lexigear.operators import blocks

    monkeypatch.setattr(blocks, "TOP_BYTES", 0)
    rng = np.random.default_rng(1)
    parts = [np.linalg.qr(rng.standard_normal((9, 5))) for _ in range(20)]
    frame = spark.createDataFrame([(i, bytearray(r.tobytes())) for i, (_, r) in enumerate(parts)], "node int, r binary")
    turns = {r.node: np.frombuffer(r.t).reshape(-1, 5) for r in blocks.tree_factors(frame, 20, 5).collect()}
    q = np.vstack([part @ turns[i] for i, (part, _) in enumerate(parts)])
    np.testing.assert_allclose(q.T @ q, np.eye(5), atol=1e-14)
    whole = np.vstack([part @ r for part, r in parts])
    np.testing.assert_allclose(q @ (q.T @ whole), whole, atol=1e-13)


@pytest.mark.parametrize("local_bytes", [dc.LOCAL_BYTES, 0])
def test_a_broken_run_goes_on(spark, folder, monkeypatch, local_bytes):
    frame = sparse_rows(spark, decaying())
    options = dict(block=20, local_bytes=local_bytes)
    whole = dc.factorize(frame, 100, 5, **options)
    name = "gram_times" if local_bytes else "gram_times_shipped"
    real, calls = getattr(dc, name), []

    def failing(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(dc, name, failing)
    with pytest.raises(RuntimeError, match="lost"):
        dc.factorize(frame, 100, 5, progress=folder, **options)
    before = len(calls)
    again = dc.factorize(frame, 100, 5, progress=folder, **options)
    np.testing.assert_allclose(again[0], whole[0], rtol=1e-12)
    np.testing.assert_allclose(again[1], whole[1], atol=1e-9)
    assert before == 2
    if local_bytes:
        resumed = len(calls) - before
        calls.clear()
        monkeypatch.setattr(dc, name, lambda *a, **k: (calls.append(1), real(*a, **k))[1])
        dc.factorize(frame, 100, 5, **options)
        assert resumed == len(calls) - 1  # the passes before the loss were not done again


def test_grid_goes_on(spark, folder, monkeypatch):
    docs = spark.createDataFrame([(i, f"t{i}", " ".join("abcdefghijklm"[j] * 4 for j in range(13) if (i * 7 + j * 3) % 5)) for i in range(60)], "doc_id long, title string, text string")
    real, calls = lsa.factorize, []

    def counted(*args, **kwargs):
        calls.append(args[2])
        if len(calls) == 3:
            raise RuntimeError("lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(lsa, "factorize", counted)
    options = dict(num_freqs=(5, 8), ks=(2, 4), folder=folder, tokenizers={"regex": tk.tokens_regex})
    with pytest.raises(RuntimeError, match="lost"):
        lsa.grid(docs, **options)
    runs = lsa.grid(docs, **options)
    assert [r["run_name"] for r in runs] == [f"regex_{n}_{k}" for n in (5, 8) for k in (2, 4)]
    assert len(calls) == 3 + 2
    energies = [r["energy"] for r in lsa.grid(docs, **options | {"folder": None})]
    np.testing.assert_allclose([r["energy"] for r in runs], energies)


def test_batch_search_scans_once(spark, model, capsys):
    """Many blocks of queries, one scan; more of them than may be shipped, several."""
    names = list(model.vocab.terms)
    rows = [(i, [names[i % len(names)], names[(i * 5 + 1) % len(names)]]) for i in range(60)]
    frame = spark.createDataFrame(rows, "query_id long, features array<string>")
    once = {(r.query_id, r["rank"]): (r.doc_id, r.score) for r in se.batch_search(model, frame, n=3, queries_per_block=7).collect()}
    many = {(r.query_id, r["rank"]): (r.doc_id, r.score) for r in se.batch_search(model, frame, n=3, queries_per_block=25, shipped_bytes=1).collect()}
    assert once == many and len(once) > 60
    sent = [(np.arange(2) + 2 * i, spark.sparkContext.broadcast(np.ones((2, model.k)))) for i in range(5)]
    capsys.readouterr()
    se.scan_once(model, sent, 3, False).explain()
    assert capsys.readouterr().out.count("MapInPandas") == 1
