"""Queries over factors, groups and labels taken from given tables, so that SQL knows the
whole result; each stands beside its SQL."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import oracles as o
from checks import queries as q
from lexigear.functions import text as fx
from lexigear.operators import classify as jc
from lexigear.operators import clusters as cl
from lexigear.operators import concepts as co
from lexigear.operators import decomposition as dc
from lexigear.operators import features as ft
from lexigear.operators import outliers as ol
from lexigear.operators import search as se
from lexigear.operators import tokens as tk
from lexigear.operators import weighting as wt
from lexigear.plans import gearbox, lsa
from lexigear.shared import numbered_rows, shared_folder, through_table
from lexigear.sources import sinks, tables

SQL: dict[str, str] = {}


def exact(sql: str):
    """Registers a query with its SQL."""

    def register(fn):
        SQL[fn.__name__] = sql
        return q.query(fn)

    return register


# Concepts: the rows of ``embeddings`` as factors U and V


@dataclass(frozen=True)
class GivenModel(dc.LsaModel):
    """A model whose terms are a table too, so that no row of it passes through the driver."""

    given_terms: DataFrame | None = None

    def terms(self) -> DataFrame:
        return self.given_terms


def given_model(spark, sf, terms: bool = True) -> dc.LsaModel:
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("u"))
    name = F.concat(F.lit("vec "), F.col("vec_id").cast("string"))
    documents = rows.select(F.col("vec_id").alias("doc_id"), name.alias("title"), "u")
    width = rows.agg(F.max(F.size("u"))).first()[0] or 0
    given = numbered_rows(rows, "vec_id").select(F.col("no").alias("term_id"), name.alias("term"), F.col("u").alias("v")) if terms else None
    return GivenModel(wt.Vocabulary([], [], []), np.arange(width, 0, -1.0), np.empty((0, width)), documents, given_terms=given)


RANKED = """
each AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS no,
                generate_subscripts(embedding, 1) - 1 AS concept, CAST(unnest(embedding) AS DOUBLE) AS weight FROM embeddings),
top AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY concept ORDER BY weight DESC, vec_id) AS rank FROM each
                      WHERE concept < 25) WHERE rank <= 25)
"""


def numbered(top: DataFrame) -> DataFrame:
    return top.withColumns({c: F.col(c).cast("long") for c in ("concept", "rank", "term_id") if c in top.columns})


@exact(f"WITH {RANKED} SELECT concept, rank, no AS term_id, 'vec ' || vec_id AS term, weight FROM top")
def f1_top_terms_given(spark, sf):
    return numbered(co.top_terms(given_model(spark, sf)))


@exact(f"WITH {RANKED} SELECT concept, rank, vec_id AS doc_id, 'vec ' || vec_id AS title, weight FROM top")
def f2_top_docs_given(spark, sf):
    return numbered(co.top_docs(given_model(spark, sf, terms=False)))


@exact(f"WITH {RANKED} SELECT concept, string_agg('vec ' || vec_id, ', ' ORDER BY rank) AS terms, string_agg('vec ' || vec_id, ', ' ORDER BY rank) AS titles FROM top GROUP BY concept")
def f3_concept_table_given(spark, sf):
    model = given_model(spark, sf)
    return numbered(co.concept_table(co.top_terms(model), co.top_docs(model)))


@exact(f"WITH {RANKED} SELECT concept, rank, vec_id AS doc_id, 'vec ' || vec_id AS title, weight, 'g' || label || ', x, ' || vec_id AS genres FROM top")
def f4_top_docs_with_genres_given(spark, sf):
    genre = F.concat(F.lit("g"), F.col("label").cast("string"), F.lit(" / x, "), F.col("vec_id").cast("string"))
    genres = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("doc_id"), genre.alias("genre"))
    listed = co.top_docs_with_genres(co.top_docs(given_model(spark, sf, terms=False)), genres)
    return numbered(listed.withColumn("genres", F.array_join("genres", ", ")))


@exact(f"""WITH {RANKED}, few AS (SELECT * FROM top WHERE concept < 5)
SELECT x.concept AS left_concept, y.concept AS right_concept, count(*) AS shared_terms, string_agg(x.vec_id, ' ' ORDER BY 'vec ' || x.vec_id) AS terms
FROM few x JOIN few y USING (vec_id) GROUP BY ALL""")
def c7_compare_concepts_given(spark, sf):
    top = co.top_terms(given_model(spark, sf), num_concepts=5)
    shared = tk.compare_concepts(top, top)
    shared = shared.withColumn("terms", F.array_join(F.transform("terms", lambda t: F.substring(t, 5, 20)), " "))
    return shared.withColumns({c: F.col(c).cast("long") for c in ("left_concept", "right_concept")})


# Decomposition: all searches again through the iterating solver, in blocks narrower than k


def iterated(spark, sf) -> dc.LsaModel:
    return lsa.fit(q.regex_docs(spark, sf), o.NUM_FREQ, o.NUM_FREQ, block=16)


def tabled(spark, sf) -> dc.LsaModel:
    """With directions and images in a table by ranges of terms."""
    return lsa.fit(q.regex_docs(spark, sf), o.NUM_FREQ, o.NUM_FREQ, block=30, local_bytes=0)


W60 = o.weights(o.NUM_FREQ)


@exact(o.SEARCH)
def f7_search_tabled(spark, sf):
    return se.search(tabled(spark, sf), o.QUERY)


@exact(W60 + "SELECT round(sum(w * w), 6) AS energy FROM a")
def e1_svd_energy_iterated(spark, sf):
    return iterated(spark, sf).concepts().agg(F.round(F.sum(F.col("sigma") ** 2), 6).alias("energy"))


@exact(o.SEARCH_COSINE)
def f8_search_cosine_iterated(spark, sf):
    return se.search_cosine(iterated(spark, sf), o.QUERY)


@exact(W60 + f"""SELECT tok.doc_id, round(coalesce(sum(w * w), 0) / n.size / n.size, 6) AS squared FROM tok JOIN ({o.DOC_NORM}) n USING (doc_id) LEFT JOIN a USING (doc_id) GROUP BY tok.doc_id, n.size""")
def e4_normalized_rows_given(spark, sf):
    """Squares of the rows of U S over those of the documents' weights."""
    rows = dc.scale_docs(q.full_rank(spark, sf))
    unit = dc.normalize_rows(rows, "us").select("doc_id", "us")
    return unit.select("doc_id", F.round(q.squared("us"), 6).alias("squared"))


# Tokens and queries


@exact(o.oracle_sql()["c3_tokens_lemma"])
def c3_tokens_lemma_joined(spark, sf):
    """The form for lemma maps too large to ship."""
    return q.token_report(tk.tokens_lemma(q.documents(spark, sf), max_map=0).select("doc_id", "features"))


@exact(o.oracle_sql()["d8_tfidf"])
def d8_tfidf_joined(spark, sf):
    """The form for vocabularies too large to broadcast."""
    docs = q.regex_docs(spark, sf)
    weights = wt.tfidf(docs, wt.vocabulary(docs, o.WIDE_FREQ), wt.MAX_BROADCAST_TERMS + 1)
    known = wt.vocabulary(docs, o.WIDE_FREQ).select("term")
    found = weights.join(known, "term", "left_semi")
    return found.select("doc_id", F.col("term_id").cast("long").alias("term_id"), "term", q.rounded("weight", 9))


@exact(f"""WITH base AS ({o.oracle_sql()["d10_corpus_stats"]})
SELECT *, (SELECT count(DISTINCT source) FROM documents) AS num_files,
       (SELECT count(DISTINCT w) FROM (SELECT unnest(regexp_split_to_array(lower(text), '\\s')) AS w FROM benchmark)) AS num_stop_words FROM base""")
def d10_corpus_stats_whole(spark, sf):
    """With files and stop words; the sources stand for files."""
    files = q.table(spark, sf, "documents", "doc_id").select("source")
    words = tables.read_stopwords(spark, q.written_words(spark, sf))
    return wt.corpus_stats(q.regex_docs(spark, sf), o.WIDE_FREQ, files, words)


def lemma_query_sql() -> str:
    """Benchmark texts with an s behind each word, lemmatized with the documents' words."""
    return f"""WITH words AS (SELECT DISTINCT unnest({o.LETTERS}) AS w FROM documents),
forms AS (SELECT item_id, pos, w || 's' AS f FROM (
  SELECT item_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS w FROM (SELECT item_id, {o.LETTERS} AS ws FROM benchmark))),
options AS (SELECT DISTINCT f, f AS c FROM forms UNION SELECT DISTINCT f, left(f, length(f) - length(s.a)) || s.b FROM forms,
  (VALUES {", ".join(f"('{a}', '{b}')" for a, b in tk.NOUN_SUFFIXES)}) s(a, b) WHERE ends_with(f, s.a)),
best AS (SELECT f, arg_min(c, (length(c), c)) AS lemma FROM options JOIN words ON c = w GROUP BY f),
out AS (SELECT item_id, pos, coalesce(lemma, f) AS t FROM forms LEFT JOIN best USING (f)),
kept AS (SELECT item_id, string_agg(t, ' ' ORDER BY pos) AS terms FROM out WHERE length(t) > 2 AND t NOT IN ({o.STOP}) GROUP BY item_id)
SELECT item_id, coalesce(terms, '') AS terms FROM benchmark LEFT JOIN kept USING (item_id)"""


@exact(lemma_query_sql())
def f5_query_terms_lemma(spark, sf):
    docs = q.documents(spark, sf)
    lexicon = tk.lexicon_of(docs.select(fx.matches("text", fx.LETTERS).alias("features")))
    model = dc.LsaModel(wt.Vocabulary([], [], []), np.empty(0), np.empty((0, 0)), docs, "nlp", lexicon)
    plural = F.regexp_replace("text", r"(\p{L}+)", "$1s")
    items = q.table(spark, sf, "benchmark", "item_id").select("item_id", plural.alias("text"))
    found = lsa.query_tokens(model, items, key="item_id")
    return found.select("item_id", fx.joined(F.col("features")).alias("terms"))


# Clusters: three groups far apart, whose averages are the centers


def grouped_points(spark, sf) -> DataFrame:
    """Points near (100 g, 50 g) for the group g of their label."""
    group = F.pmod(F.col("label"), F.lit(3)).cast("int")
    e = lambda j: F.get("embedding", F.lit(j)).cast("double")
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("vec_id").alias("point_id"), group.alias("source_file"),
        F.array(100.0 * group + e(0), 50.0 * group + e(1)).alias("features"),
    )


GROUPED = """
points AS MATERIALIZED (SELECT vec_id, label % 3 AS g, 100.0 * (label % 3) + CAST(embedding[1] AS DOUBLE) AS x, 50.0 * (label % 3) + CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
far AS MATERIALIZED (SELECT vec_id, g, x, y, sqrt((x - cx) ** 2 + (y - cy) ** 2) AS d FROM points JOIN (SELECT g, avg(x) AS cx, avg(y) AS cy FROM points GROUP BY g) USING (g))
"""


@exact(f"WITH {GROUPED} SELECT round(avg(x), 4) AS x, round(avg(y), 4) AS y FROM points GROUP BY g")
def h1_kmeans_groups(spark, sf):
    centers = cl.centers_frame(spark, cl.model_centers(cl.kmeans_fit(grouped_points(spark, sf), 3)))
    return centers.select(*[(F.round(F.get("center", F.lit(j)), 4) + F.lit(0.0)).alias(n) for j, n in enumerate("xy")])


@exact(f"WITH {GROUPED} SELECT CAST(g AS INT) AS source_file, count(*) AS n FROM points GROUP BY g")
def h2_kmeans_default_groups(spark, sf):
    points = grouped_points(spark, sf)
    return cl.cluster_label_counts(cl.score(points, cl.kmeans_default(points, 3)), "source_file").select("source_file", "n")


@exact(f"WITH {GROUPED}, c AS (SELECT DISTINCT 'v' || vec_id AS v FROM embeddings) SELECT CAST(g AS INT) AS source_file, count(*) AS n, round(sum(sqrt((x - cx) ** 2 + 1 - 1.0 / size)), 3) AS total FROM far JOIN (SELECT g, avg(x) AS cx, count(*) AS size FROM points GROUP BY g) USING (g) GROUP BY g")
def h2_kmeans_sparse_groups(spark, sf):
    """A category of its own for each point beside one far coordinate: sparse rows."""
    rows = grouped_points(spark, sf).select("source_file", F.get("features", F.lit(0)).alias("x"), F.concat(F.lit("v"), F.col("point_id").cast("string")).alias("name"))
    rows = ft.sparse_vectors(ft.one_hot_sparse(rows, "x", ("name",), (), max_shipped=100))
    scored = cl.score(rows, cl.kmeans_fit(rows, 3))
    return scored.groupBy("source_file").agg(F.count("*").alias("n"), F.round(F.sum("distance"), 3).alias("total"))


@exact(f"""WITH {GROUPED}, t AS (SELECT min(d) AS t FROM (SELECT d FROM far ORDER BY d DESC LIMIT 100))
SELECT CAST(3 AS INT) AS k, round(avg(d), 5) AS avg_distance, round(t, 5) AS threshold, count(*) AS total, count(*) FILTER (round(d, 9) > round(t, 9)) AS anomalies FROM far, t GROUP BY t""")
def h8_sweep_groups(spark, sf):
    found = gearbox.sweep_k(grouped_points(spark, sf), (3,)).summary
    return found.select("k", q.rounded("avg_distance", 5), q.rounded("threshold", 5), "total", "anomalies")


PLANE = """
flat AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
c AS (SELECT var_samp(x) AS a, var_samp(y) AS d, covar_samp(x, y) AS b FROM flat),
l AS (SELECT *, (a + d) / 2 + sqrt(((a - d) / 2) ** 2 + b * b) AS l1, (a + d) / 2 - sqrt(((a - d) / 2) ** 2 + b * b) AS l2 FROM c),
v AS (SELECT *, b / sqrt(b * b + (l1 - a) ** 2) AS vx, (l1 - a) / sqrt(b * b + (l1 - a) ** 2) AS vy FROM l)
"""


def plane_points(spark, sf) -> DataFrame:
    e = lambda j: F.get("embedding", F.lit(j)).cast("double")
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("vec_id").alias("point_id"), F.lit(0).alias("prediction"), e(0).alias("distance"), F.array(e(0), e(1)).alias("features")
    )


@exact(f"WITH {PLANE} SELECT vec_id AS point_id, round(abs(x * vx + y * vy), 5) AS x, round(abs(y * vx - x * vy), 5) AS y, row_number() OVER (ORDER BY x DESC, vec_id) <= 25 AS is_outlier FROM flat, v")
def h17_project_plane(spark, sf):
    points = plane_points(spark, sf)
    placed, _ = ol.project_2d(points, points)
    return placed.select("point_id", *[F.round(F.abs(c), 5).alias(c) for c in ("x", "y")], "is_outlier")


@exact(f"WITH {PLANE} SELECT CAST(1 AS INT) AS component, round(l1 / (l1 + l2), 6) AS share FROM l UNION ALL SELECT CAST(2 AS INT), round(l2 / (l1 + l2), 6) FROM l")
def h20_explained_plane(spark, sf):
    points = plane_points(spark, sf)
    _, explained = ol.project_2d(points, points)
    return spark.createDataFrame(list(enumerate(explained, 1)), "component int, share double").select("component", q.rounded("share"))


# Runs made from a given table


def given_runs(spark, sf) -> DataFrame:
    rows = q.lineitem(spark, sf).groupBy("l_linenumber", "l_returnflag").agg(
        F.round(F.avg("l_discount"), 6).alias("energy"), F.round(F.sum("l_tax"), 4).alias("runtime_seconds")
    )
    return rows.select(
        F.concat_ws("_", "l_returnflag", "l_linenumber").alias("run_name"), F.col("l_returnflag").alias("tokenizer"),
        (F.col("l_linenumber") * 1000).cast("int").alias("numFreq"), F.col("l_linenumber").cast("int").alias("k"), "runtime_seconds", "energy",
    )


RUNS = """SELECT l_returnflag || '_' || l_linenumber AS run_name, l_returnflag AS tokenizer, CAST(l_linenumber * 1000 AS INT) AS "numFreq",
CAST(l_linenumber AS INT) AS k, round(sum(l_tax), 4) AS runtime_seconds, round(avg(l_discount), 6) AS energy FROM lineitem GROUP BY l_returnflag, l_linenumber"""


@exact(RUNS)
def b4_append_given_runs(spark, sf):
    path = shared_folder(spark, "runs")
    runs = given_runs(spark, sf)
    for part in ("tokenizer = 'A'", "tokenizer <> 'A'"):
        sinks.append_run(runs.where(part), path)
    return spark.read.schema(lsa.RUN_SCHEMA).option("header", True).csv(path)


@exact('SELECT k, round(runtime_seconds, 4) AS runtime_seconds FROM (SELECT k, sum(runtime_seconds) AS runtime_seconds FROM (' + RUNS + ') GROUP BY k)')
def b2_write_runtimes(spark, sf):
    path = shared_folder(spark, "runtimes")
    sinks.write_runtimes(given_runs(spark, sf).groupBy("k").agg(F.round(F.sum("runtime_seconds"), 4).alias("runtime_seconds")), path)
    return spark.read.schema("k int, runtime_seconds double").option("header", True).csv(path)


@exact(f'SELECT tokenizer, "numFreq", k, energy FROM ({RUNS}) ORDER BY energy DESC, k, "numFreq", tokenizer LIMIT 1')
def i2_pick_best_given(spark, sf):
    return lsa.pick_best(given_runs(spark, sf)).select("tokenizer", "numFreq", "k", "energy")


# Classification: the answer follows from the language, so a prediction is right


def answered(spark, sf) -> tuple[DataFrame, DataFrame]:
    rows = q.labelled_docs(spark, sf).withColumn("answer", F.when(F.col("lang") == "en", "Yes").otherwise("No"))
    return jc.hash_split(rows, "doc_id")


DRAW = o.DRAW.format(seed=42, key="doc_id")
ANSWERED = f"""WITH j AS (SELECT *, CASE WHEN lang = 'en' THEN 'Yes' ELSE 'No' END AS answer, {DRAW} AS draw FROM ({o.JOINED})),
i AS (SELECT answer, CAST(row_number() OVER (ORDER BY count(*) DESC, answer) - 1 AS DOUBLE) AS label FROM j WHERE draw < 0.8 GROUP BY answer)
SELECT doc_id, label, label AS prediction FROM j JOIN i USING (answer) WHERE draw >= 0.8"""


def pipeline(classifier):
    return jc.tree_pipeline(("lang",), ("n_chars",), "answer", classifier)


@exact(ANSWERED)
def j4_tree_pipeline_given(spark, sf):
    train, test = answered(spark, sf)
    return q.predictions(pipeline(jc.decision_tree()).fit(train), test)


def tuned(spark, sf, tune, classifier, evaluator, **grid) -> DataFrame:
    train, test = answered(spark, sf)
    found = tune(pipeline(classifier), jc.tree_grid(classifier, **grid), evaluator, parallelism=4).fit(train.persist())
    train.unpersist()
    return q.predictions(found.bestModel, test)


@exact(ANSWERED)
def j5_tune_cv_given(spark, sf):
    """The whole grid: 18 combinations on five folds."""
    return tuned(spark, sf, jc.tune_cv, jc.decision_tree(), jc.area_under_roc())


@exact(ANSWERED)
def j6_tune_tvs_given(spark, sf):
    """The whole grid: 18 combinations on one split."""
    return tuned(spark, sf, jc.tune_tvs, jc.decision_tree(), jc.area_under_roc())


@exact(ANSWERED)
def j9_gbt_one_vs_rest_given(spark, sf):
    train, test = answered(spark, sf)
    return q.predictions(pipeline(jc.gbt_one_vs_rest()).fit(train), test)


@exact(ANSWERED)
def j10_forest_cv_given(spark, sf):
    return tuned(spark, sf, jc.tune_cv, jc.random_forest(), jc.accuracy(), impurities=("gini",), depths=(6,), bins=(50,), trees=(5, 10))


# A movie search, end to end, with as many concepts as terms


def movie_search_sql() -> str:
    """Cosines of lemmatized plots and a lemmatized query; the id is a hash of the record."""
    movies = "SELECT md5(concat_ws(chr(1), 'doc ' || doc_id, lang || ', ' || source, text)) AS doc_id, 'doc ' || doc_id AS title, lang || ', ' || source AS genres, text FROM documents"
    lemmas = o.lemma_tokens("movies", "doc_id").replace("WITH words", f"WITH movies AS MATERIALIZED ({movies}), words", 1)
    terms = ", ".join(f"('{t}')" for t in ("ing", "ble", "ther", "ble"))
    query = f"SELECT term_id, sum(idf) AS q FROM (VALUES {terms}) v(term) JOIN vocab USING (term) GROUP BY term_id"
    return o.weights(o.NUM_FREQ, f"{lemmas} SELECT doc_id, features FROM lem") + f"""
SELECT n.doc_id, title, round(coalesce(s, 0) / n.size / (SELECT sqrt(sum(q * q)) FROM ({query})), 9) + 0.0 AS score, genres
FROM ({o.DOC_NORM}) n JOIN ({movies}) USING (doc_id) LEFT JOIN
  (SELECT doc_id, sum(w * q) AS s FROM a JOIN ({query}) USING (term_id) GROUP BY doc_id) USING (doc_id)
ORDER BY score DESC, n.doc_id LIMIT 10"""


@exact(movie_search_sql())
def f13_movie_search(spark, sf):
    movies = tables.read_movies(spark, q.written_movies(spark, sf))
    model = lsa.movie_lsa(movies, num_freq=o.NUM_FREQ, k=o.NUM_FREQ)
    found = lsa.movie_search(model, "the ing and bles ther ble")
    return found.select("doc_id", "title", "score", F.array_join("genres", ", ").alias("genres"))
