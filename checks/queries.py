"""One query per operator over the whole driver tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import cache, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracles as o
from lexigear.functions import text as fx
from lexigear.functions import vectors as vx
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
from lexigear.shared import CHECKPOINT_KEY, shared_folder, spread, through_table
from lexigear.sources import dumps, sinks, tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


@cache
def own_folder() -> str:
    return tempfile.mkdtemp(prefix="lexigear-checks-")


def query(fn: Query) -> Query:
    """Registers a query.  A local check session that names no shared folder gets one."""

    @wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        if spark.conf.get(CHECKPOINT_KEY, None) is None and spark.sparkContext.master.startswith("local["):
            spark.conf.set(CHECKPOINT_KEY, own_folder())
        return fn(spark, sf)

    REGISTERED[fn.__name__] = run
    return run


# Inputs


def table(spark, sf, name, *keys) -> DataFrame:
    return spread(spark.read.parquet(f"{sf}/{name}.parquet"), *keys)


def documents(spark, sf) -> DataFrame:
    title = F.concat(F.lit("doc "), F.col("doc_id").cast("string"))
    return table(spark, sf, "documents", "doc_id").withColumn("title", title)


def regex_docs(spark, sf) -> DataFrame:
    return tk.tokens_regex(documents(spark, sf)).select("doc_id", "title", "features")


def lemma_docs(spark, sf) -> DataFrame:
    return tk.tokens_lemma(documents(spark, sf)).select("doc_id", "title", "features")


def benchmark_tokens(spark, sf) -> DataFrame:
    items = table(spark, sf, "benchmark", "item_id").withColumnRenamed("item_id", "query_id")
    return tk.tokens_regex(items, key="query_id").select("query_id", "features")


def full_rank(spark, sf) -> dc.LsaModel:
    return lsa.fit(regex_docs(spark, sf), o.NUM_FREQ, o.NUM_FREQ)


def truncated(spark, sf) -> dc.LsaModel:
    return lsa.fit(regex_docs(spark, sf), o.WIDE_FREQ, 25)


def embedded(spark, sf) -> DataFrame:
    """Points with an id, a label standing in for the source file, and features."""
    return table(spark, sf, "embeddings", "vec_id").select(
        F.col("vec_id").alias("point_id"), "label", F.col("label").cast("string").alias("source_file"),
        F.col("embedding").cast("array<double>").alias("features"),
    )


def lineitem(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem")


def scaled_readings(spark, sf) -> DataFrame:
    return gearbox.prepare(lineitem(spark, sf), list(o.SENSORS))


def lloyd_scored(spark, sf, k: int = o.K) -> DataFrame:
    points = embedded(spark, sf).persist()
    centers = cl.kmeans_lloyd(points, cl.first_centers(points, k, "point_id"), o.STEPS)
    return cl.assign(points, centers)


def lloyd_sweep(spark, sf) -> DataFrame:
    """Scored points of every k, stacked."""
    parts = [lloyd_scored(spark, sf, k).withColumn("k", F.lit(k)) for k in o.KS]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


def lloyd_tops(spark, sf) -> DataFrame:
    tops = [ol.top_outliers(lloyd_scored(spark, sf, k).withColumn("k", F.lit(k))) for k in o.KS]
    stacked = tops[0]
    for part in tops[1:]:
        stacked = stacked.unionByName(part)
    return stacked.select("k", "point_id", "source_file", "prediction", "distance")


def lloyd_scores(spark, sf) -> DataFrame:
    return lloyd_sweep(spark, sf).groupBy("k").agg(F.avg("distance").alias("avg_distance"))


def labelled_docs(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id").select("doc_id", "lang", "source", "n_chars")
    return table(spark, sf, "labels", "doc_id").join(docs, "doc_id")


def token_report(df: DataFrame, key: str = "doc_id") -> DataFrame:
    return df.select(
        key, F.size("features").cast("long").alias("n_tokens"), fx.joined(F.col("features")).alias("tokens")
    )


def rounded(name: str, digits: int = 6):
    return (F.round(F.col(name), digits) + F.lit(0.0)).alias(name)


def written_dump(spark, sf) -> str:
    path = shared_folder(spark, "dump")
    docs = documents(spark, sf).select(
        "doc_id", F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string")).alias("url"),
        "title", F.col("text").alias("content"),
    )
    dumps.write_dump(docs, path, docs_per_file=200)
    return path


def written_words(spark, sf) -> str:
    """A stop word file: the words of ``benchmark``, one per line."""
    path = shared_folder(spark, "stopwords")
    words = F.explode(F.split(F.lower("text"), r"\s"))
    table(spark, sf, "benchmark", "item_id").select(words.alias("value")).write.text(path)
    return path


def month() -> Column:
    return F.date_format("l_shipdate", "MM")


# Sources


@query
def a1_read_dump(spark, sf):
    dump = dumps.read_dump(spark, written_dump(spark, sf))
    blocks = F.regexp_count("content", F.lit("(?m)^<doc "))
    return dump.agg(
        F.sum(blocks).cast("long").alias("blocks"), F.sum(F.length("content")).cast("long").alias("chars")
    )


@query
def a2_sample(spark, sf):
    return dumps.sample_rows(table(spark, sf, "documents", "doc_id").select("doc_id"), 0.3, "doc_id")


def parsed_report(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "url", "title", F.md5("content").alias("content_md5"))


@query
def a3_parse_documents(spark, sf):
    return parsed_report(dumps.parse_documents(dumps.read_dump(spark, written_dump(spark, sf))))


@query
def a3_read_documents(spark, sf):
    return parsed_report(dumps.read_documents(spark, written_dump(spark, sf)))


@query
def a4_read_stopwords(spark, sf):
    return tables.read_stopwords(spark, written_words(spark, sf))


def conversation_terms(spark, sf) -> DataFrame:
    turns = table(spark, sf, "conversations", "conv_id", "turn")
    return turns.withColumn("key", F.struct("conv_id", "turn")).withColumn("features", fx.matches("text", fx.LETTERS))


def filtered_turns(spark, sf, **options) -> DataFrame:
    words = tables.read_stopwords(spark, written_words(spark, sf))
    turns = conversation_terms(spark, sf)
    kept = tk.filter_terms(turns, min_length=4, stop_words=[], alpha_only=True)
    kept = tk.drop_words(kept, words, key="key", **options)
    return kept.select("conv_id", "turn", fx.joined(F.col("features")).alias("tokens"))


@query
def a4_stopword_join(spark, sf):
    return filtered_turns(spark, sf, max_list=0)


@query
def a5_read_sensors(spark, sf):
    path = shared_folder(spark, "sensors")
    lineitem(spark, sf).select(*o.SENSORS).write.csv(path)
    return tables.read_sensors(spark, path).drop("source_file")


@query
def a6_source_file(spark, sf):
    path = shared_folder(spark, "sensors")
    lineitem(spark, sf).select(*o.SENSORS, "l_returnflag").write.partitionBy("l_returnflag").csv(path)
    readings = tables.read_sensors(spark, f"{path}/*/")
    source = F.regexp_extract("source_file", "l_returnflag=([^/]+)", 1)
    return readings.groupBy(source.alias("source")).agg(
        F.count("*").alias("n"), F.round(F.sum("sensor_4"), 4).alias("sum_tax")
    )


@query
def a7_point_id(spark, sf):
    readings = lineitem(spark, sf).select("l_orderkey", "l_linenumber", *o.SENSORS)
    numbered = tables.with_point_id(readings)
    stable = tables.with_stable_id(readings, rows_per_task=2)
    counted = numbered.agg(F.count("*").alias("n_rows"), F.count_distinct("point_id").alias("n_ids"))
    return counted.withColumn(
        "n_stable_ids", stable.agg(F.count_distinct("point_id").alias("n")).scalar()
    ).withColumn("price", stable.agg(F.round(F.sum("l_extendedprice"), 2).alias("s")).scalar())


@query
def a8_read_labelled(spark, sf):
    path = shared_folder(spark, "labelled")
    lineitem(spark, sf).select(
        "l_quantity", "l_returnflag", "l_linestatus", month(), "l_extendedprice", "l_discount", "l_tax",
        F.concat("l_linestatus", "l_returnflag"),
    ).write.csv(path)
    return tables.read_labelled(spark, path, width=8)


def written_movies(spark, sf) -> str:
    path = shared_folder(spark, "movies")
    blank = F.lit("")
    documents(spark, sf).select(
        F.lit("1999").alias("Release Year"), F.col("title").alias("Title"), blank.alias("Origin/Ethnicity"),
        blank.alias("Director"), blank.alias("Cast"), F.concat_ws(", ", "lang", "source").alias("Genre"),
        blank.alias("Wiki Page"), F.col("text").alias("Plot"),
    ).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return path


@query
def a9_read_movies(spark, sf):
    movies = tables.read_movies(spark, written_movies(spark, sf))
    return movies.select("Title", "Genre", F.md5("Plot").alias("plot_md5"))


@query
def a10_read_survey(spark, sf):
    path = shared_folder(spark, "survey")
    yes = lambda c: F.when(c, "Yes").otherwise("No")
    given = {
        "HeartDisease": yes(F.col("toxic") == 1), "BMI": F.col("n_chars") * F.lit(0.5),
        "Smoking": yes(F.col("quality") == 1), "AgeCategory": F.col("lang"), "Race": F.col("source"),
        "SleepTime": F.col("doc_id").cast("double"),
        "GenHealth": F.when(F.col("n_chars") > o.SHORT_DOC, "Good").otherwise("Poor"),
    }
    labelled_docs(spark, sf).select(
        *[given.get(c, F.lit("0" if c in tables.SURVEY_NUMBERS else "No")).alias(c) for c in tables.SURVEY_COLUMNS]
    ).write.option("header", True).csv(path)
    return tables.read_survey(spark, path).select(*given)


# Sinks


@query
def b1_write_outliers(spark, sf):
    path = shared_folder(spark, "outliers")
    sinks.write_outliers(lloyd_tops(spark, sf), path)
    schema = "point_id long, source_file string, prediction int, distance double, k int"
    back = spark.read.schema(schema).option("header", True).csv(path)
    return back.select("k", "point_id", "source_file", "prediction", rounded("distance"))


@query
def b2_write_scores(spark, sf):
    path = shared_folder(spark, "scores")
    sinks.write_scores(lloyd_scores(spark, sf), path)
    return spark.read.schema("k int, avg_distance double").option("header", True).csv(path).select("k", rounded("avg_distance"))


@query
def b3_write_scored_sample(spark, sf):
    path = shared_folder(spark, "sample")
    sample = ol.fixed_sample(lloyd_scored(spark, sf)).select("point_id", "prediction", "distance")
    sinks.write_scored_sample(sample, path)
    schema = "point_id long, prediction int, distance double"
    return spark.read.schema(schema).option("header", True).csv(path).select("point_id", "prediction", rounded("distance"))


def grid_runs(spark, sf) -> DataFrame:
    runs = lsa.grid(documents(spark, sf), num_freqs=(500, 1000), ks=(5, 10, 25))
    return spark.createDataFrame([tuple(r.values()) for r in runs], lsa.RUN_SCHEMA)


@query
def b4_append_run(spark, sf):
    path = shared_folder(spark, "runs")
    runs = grid_runs(spark, sf)
    sinks.append_run(runs.where("tokenizer = 'regex'"), path)
    sinks.append_run(runs.where("tokenizer = 'nlp'"), path)
    return spark.read.schema(lsa.RUN_SCHEMA).option("header", True).csv(path)


@query
def b5_saved_model_search(spark, sf):
    path = shared_folder(spark, "model")
    dc.save_model(full_rank(spark, sf), path)
    return se.search(dc.load_model(spark, path), o.QUERY)


@query
def b6_dump_clusters(spark, sf):
    path = shared_folder(spark, "clusters")
    sinks.dump_clusters(lloyd_scored(spark, sf), path)
    fields = spark.read.text(path).select(F.split("value", ",").alias("f"))
    values = F.slice("f", F.lit(2), F.size("f") - 1).cast("array<double>")
    return fields.groupBy(F.col("f")[0].cast("int").alias("cluster")).agg(
        F.count("*").alias("n"), F.sum(F.size("f") - 1).cast("long").alias("n_values"),
        (F.round(F.sum(vx.total(values)), 4) + F.lit(0.0)).alias("total"),
    )


# Tokens


@query
def c1_tokens_regex(spark, sf):
    return token_report(regex_docs(spark, sf))


@query
def c2_tokens_exercise(spark, sf):
    return token_report(tk.tokens_exercise(documents(spark, sf)))


@query
def c3_tokens_lemma(spark, sf):
    return token_report(lemma_docs(spark, sf))


@query
def c4_tokens_split(spark, sf):
    return token_report(tk.tokens_split(documents(spark, sf)))


@query
def c5_filter_terms(spark, sf):
    return filtered_turns(spark, sf)


@query
def c6_with_features(spark, sf):
    docs = documents(spark, sf).withColumn("genre", F.concat_ws(", ", "lang", "source"))
    return tk.with_features(docs, "text", key="doc_id").select(
        "title", "genre", F.md5(fx.joined(F.col("features"))).alias("features_md5")
    )


@query
def c7_compare_vocabularies(spark, sf):
    found = tk.compare_vocabularies(wt.doc_freqs(regex_docs(spark, sf)), wt.doc_freqs(lemma_docs(spark, sf)))
    return found.na.fill(0)


@query
def c7_compare_concepts(spark, sf):
    left, right = (lsa.fit(docs(spark, sf), o.WIDE_FREQ, 5) for docs in (regex_docs, lemma_docs))
    shared = tk.compare_concepts(co.top_terms(left), co.top_terms(right))
    return shared.withColumn("terms", fx.joined(F.col("terms")))


# Weighting


@query
def d1_term_freqs(spark, sf):
    return wt.term_freqs(regex_docs(spark, sf))


@query
def d2_doc_length(spark, sf):
    return wt.doc_lengths(regex_docs(spark, sf))


@query
def d3_doc_freqs(spark, sf):
    return wt.doc_freqs(regex_docs(spark, sf))


@query
def d4_vocabulary(spark, sf):
    return wt.vocabulary(regex_docs(spark, sf), o.WIDE_FREQ).select("term", "df")


@query
def d5_idf(spark, sf):
    return wt.vocabulary(regex_docs(spark, sf), o.WIDE_FREQ).select("term", rounded("idf", 9))


@query
def d6_term_ids(spark, sf):
    return wt.vocabulary(regex_docs(spark, sf), o.WIDE_FREQ).select(F.col("term_id").cast("long").alias("term_id"), "term")


@query
def d7_doc_ids(spark, sf):
    return regex_docs(spark, sf).select("doc_id", "title")


@query
def d8_tfidf(spark, sf):
    docs = regex_docs(spark, sf)
    weights = wt.tfidf(docs, wt.vocabulary(docs, o.WIDE_FREQ), o.WIDE_FREQ)
    return weights.select("doc_id", F.col("term_id").cast("long").alias("term_id"), "term", rounded("weight", 9))


def wide_matrix(spark, sf) -> DataFrame:
    docs = regex_docs(spark, sf).persist()
    return wt.doc_term_matrix(docs, wt.Vocabulary.fetch(wt.vocabulary(docs, o.WIDE_FREQ)))


@query
def d9_doc_term_matrix(spark, sf):
    rows = wide_matrix(spark, sf).withColumn("total", vx.total(F.col("weights")))
    return rows.select("doc_id", F.size("ids").cast("long").alias("stored"), rounded("total", 9))


@query
def d9_doc_term_matrix_joined(spark, sf):
    docs = regex_docs(spark, sf)
    rows = wt.doc_term_matrix_joined(docs, wt.vocabulary(docs, o.WIDE_FREQ), hot_terms=100)
    return rows.withColumn("total", vx.total(F.col("weights"))).select("doc_id", F.size("ids").cast("long").alias("stored"), rounded("total", 9))


@query
def d9_matrix_entries(spark, sf):
    entries = wt.matrix_entries(wide_matrix(spark, sf))
    return entries.select("doc_id", F.col("term_id").cast("long").alias("term_id"), rounded("weight", 9))


@query
def d10_corpus_stats(spark, sf):
    return wt.corpus_stats(regex_docs(spark, sf), o.WIDE_FREQ)


# Decomposition


@query
def e1_svd_energy(spark, sf):
    return full_rank(spark, sf).concepts().agg(F.round(F.sum(F.col("sigma") ** 2), 9).alias("energy"))


@query
def e1_lsa_fit(spark, sf):
    return truncated(spark, sf).concepts()


def squared(column: str):
    return vx.total(F.transform(column, lambda x: x * x))


@query
def e2_scale_docs(spark, sf):
    rows = dc.scale_docs(full_rank(spark, sf)).withColumn("squared", squared("us"))
    return rows.select("doc_id", rounded("squared", 9))


@query
def e3_scale_terms(spark, sf):
    rows = dc.scale_terms(full_rank(spark, sf)).withColumn("squared", squared("vs"))
    return rows.select(F.col("term_id").cast("long").alias("term_id"), "term", rounded("squared", 9))


@query
def e4_normalize_rows(spark, sf):
    rows = dc.normalize_rows(dc.scale_docs(full_rank(spark, sf)), "us")
    return rows.withColumn("length", vx.norm(F.col("us"))).select("doc_id", rounded("length", 9))


# Concepts and search


@query
def f1_top_terms(spark, sf):
    return co.top_terms(truncated(spark, sf))


@query
def f2_top_docs(spark, sf):
    return co.top_docs(truncated(spark, sf))


@query
def f3_concept_table(spark, sf):
    model = truncated(spark, sf)
    return co.concept_table(co.top_terms(model), co.top_docs(model))


def genres(spark, sf) -> DataFrame:
    text = F.concat("lang", F.lit(" / "), "source", F.lit(", a,b/c,d"))
    return documents(spark, sf).select("doc_id", text.alias("genre"))


@query
def f4_genre_labels(spark, sf):
    return genres(spark, sf).select("doc_id", F.array_join(co.genre_labels(F.col("genre")), "|").alias("genres"))


@query
def f4_top_docs_with_genres(spark, sf):
    listed = co.top_docs_with_genres(co.top_docs(truncated(spark, sf)), genres(spark, sf))
    return listed.withColumn("genres", F.array_join("genres", ", "))


@query
def f5_query_terms(spark, sf):
    return token_report(benchmark_tokens(spark, sf).withColumnRenamed("query_id", "item_id"), "item_id")


@query
def f6_query_vector(spark, sf):
    vocab = wt.vocabulary(regex_docs(spark, sf), o.NUM_FREQ)
    vectors = se.query_vector(benchmark_tokens(spark, sf), vocab)
    return vectors.select("query_id", F.col("term_id").cast("long").alias("term_id"), "term", rounded("weight", 9))


@query
def f7_search(spark, sf):
    return se.search(full_rank(spark, sf), o.QUERY)


@query
def f8_search_cosine(spark, sf):
    return se.search_cosine(full_rank(spark, sf), o.QUERY)


@query
def f8_search_cosine_u(spark, sf):
    return se.search_cosine(full_rank(spark, sf), o.QUERY, docs="U")


@query
def f9_similar_docs(spark, sf):
    return se.similar_docs(full_rank(spark, sf), o.DOC)


@query
def f10_similar_terms(spark, sf):
    found = se.similar_terms(full_rank(spark, sf), o.TERM)
    return found.withColumn("term_id", F.col("term_id").cast("long"))


@query
def f11_docs_for_term(spark, sf):
    return se.docs_for_term(full_rank(spark, sf), o.TERM)


@query
def f12_batch_search(spark, sf):
    found = se.batch_search(full_rank(spark, sf), benchmark_tokens(spark, sf))
    return found.withColumn("rank", F.col("rank").cast("long"))


@query
def f12_batch_search_cosine(spark, sf):
    # Small blocks, so that several meet in the scan.
    found = se.batch_search(full_rank(spark, sf), benchmark_tokens(spark, sf), cosine=True, queries_per_block=16)
    return found.withColumn("rank", F.col("rank").cast("long"))


@query
def f13_movie_lsa(spark, sf):
    movies = tables.read_movies(spark, written_movies(spark, sf))
    docs = through_table(lsa.movie_docs(movies), "movies")
    model = lsa.fit(docs, 5000, 25)
    listed = co.top_docs_with_genres(co.top_docs(model), docs.select("doc_id", "genre"))
    return listed.withColumn("genres", F.array_join("genres", ", "))


# Features


def feature_columns(df: DataFrame, *keys: str, size: int, digits: int | None = None) -> DataFrame:
    parts = [F.get("features", F.lit(j)) for j in range(size)]
    if digits is not None:
        parts = [F.round(p, digits) + F.lit(0.0) for p in parts]
    return df.select(*keys, *[p.alias(f"f{j}") for j, p in enumerate(parts)])


LINE = ("l_orderkey", "l_linenumber")


@query
def g1_assemble(spark, sf):
    return feature_columns(ft.assemble(lineitem(spark, sf), o.SENSORS), *LINE, size=4)


@query
def g2_standardize(spark, sf):
    return feature_columns(scaled_readings(spark, sf), *LINE, size=4, digits=6)


@query
def g3_normalize_pop(spark, sf):
    scaled = ft.normalize_pop(ft.assemble(lineitem(spark, sf), o.SENSORS))
    return feature_columns(scaled, *LINE, size=4, digits=6)


def network_like(spark, sf) -> DataFrame:
    return lineitem(spark, sf).withColumn("month", month())


def encoded(spark, sf) -> DataFrame:
    return ft.one_hot(
        network_like(spark, sf), "l_quantity", ("l_returnflag", "l_linestatus", "month"), ("l_discount", "l_tax")
    )


@query
def g4_one_hot(spark, sf):
    rows = encoded(spark, sf)
    whole = F.transform(
        "features", lambda x, i: F.round(F.when(i >= F.size("features") - 2, x * 100).otherwise(x)).cast("int")
    )
    return rows.select(*LINE, "l_extendedprice", F.array_join(whole.cast("array<string>"), ",").alias("features"))


CATEGORICAL = ("l_returnflag", "l_linestatus", "l_shipdate")


@query
def g4_one_hot_sparse(spark, sf):
    """Every ship date is a category."""
    rows = ft.one_hot_sparse(lineitem(spark, sf), "l_quantity", CATEGORICAL, ("l_discount", "l_tax"), max_shipped=100)
    entries = F.zip_with("features.indices", "features.values", lambda i, v: F.concat_ws(":", i.cast("string"), F.round(v * 100).cast("int").cast("string")))
    return rows.select(*LINE, "l_extendedprice", F.array_join(entries, ",").alias("entries"), F.col("features.size").alias("size"))


@query
def g5_drop_categoricals(spark, sf):
    rows = ft.drop_categoricals(lineitem(spark, sf), "l_quantity", ("l_discount", "l_tax"))
    return feature_columns(rows, *LINE, size=3)


# Clusters


@query
def h1_kmeans_fit(spark, sf):
    data = scaled_readings(spark, sf).select("features").persist()
    return cl.centers_frame(spark, cl.model_centers(cl.kmeans_fit(data, 3)))


@query
def h2_kmeans_default(spark, sf):
    data = ft.normalize_pop(encoded(spark, sf)).select("l_linestatus", "features").persist()
    models, _ = gearbox.fit_all(data, (2, 15, 100, 150))
    found = gearbox.with_predictions(data, models)
    clusters = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"_p{k}").alias("prediction")) for k in models])
    rows = found.select("l_linestatus", F.inline(clusters)).groupBy("k", "prediction", "l_linestatus").agg(F.count("*").alias("n"))
    rows = through_table(rows, "clusters")
    data.unpersist()
    return rows


@query
def h3_lloyd(spark, sf):
    return lloyd_scored(spark, sf).select(F.col("point_id").alias("vec_id"), "prediction", rounded("distance"))


@query
def h3_lloyd_readings(spark, sf):
    data = scaled_readings(spark, sf).persist()
    starts = data.groupBy("l_returnflag").agg(
        *[F.avg(F.get("features", F.lit(j))).alias(f"m{j}") for j in range(4)]
    )
    centers = [list(r)[1:] for r in starts.orderBy("l_returnflag").collect()]
    scored = cl.assign(data, cl.kmeans_lloyd(data, centers, o.STEPS))
    return scored.select("l_orderkey", "l_partkey", "l_linenumber", "prediction", rounded("distance"))


@query
def h4_centers(spark, sf):
    points = embedded(spark, sf).persist()
    centers = cl.kmeans_lloyd(points, cl.first_centers(points, o.K, "point_id"), o.STEPS)
    frame = cl.centers_frame(spark, centers)
    return frame.select("cluster", F.posexplode("center").alias("dim", "value")).select("cluster", "dim", rounded("value"))


@query
def h5_assign(spark, sf):
    return lloyd_scored(spark, sf).select(F.col("point_id").alias("vec_id"), "prediction")


@query
def h6_distance_to_centroid(spark, sf):
    return lloyd_scored(spark, sf).select(F.col("point_id").alias("vec_id"), rounded("distance"))


@query
def h7_avg_distance(spark, sf):
    return cl.avg_distance(lloyd_scored(spark, sf)).select(rounded("avg_distance"))


@query
def h8_sweep_scores(spark, sf):
    return lloyd_scores(spark, sf).select("k", rounded("avg_distance"))


def readings_sweep(spark, sf) -> gearbox.Sweep:
    data = tables.with_point_id(scaled_readings(spark, sf)).withColumnRenamed("l_returnflag", "source_file")
    return gearbox.sweep_k(data, keep=["source_file", *o.SENSORS])


@query
def h8_sweep_k(spark, sf):
    return readings_sweep(spark, sf).summary


def labelled_features(spark, sf) -> DataFrame:
    """The label is no feature, as it would tell the clusters apart by itself."""
    rows = ft.one_hot(network_like(spark, sf), "l_quantity", ("l_returnflag", "month"), ("l_discount", "l_tax"))
    return ft.normalize_pop(rows).select(F.col("l_linestatus").alias("label"), "features")


@query
def h8_sweep_entropy(spark, sf):
    return gearbox.sweep_entropy(labelled_features(spark, sf), range(120, 161, 10))


@query
def h8_sweep_variants(spark, sf):
    """Average distance per k for raw, normalized and one-hot features."""
    rows = lineitem(spark, sf)
    raw = ft.assemble(rows, o.SENSORS).select("features")
    variants = {"raw": raw, "normalized": ft.normalize_pop(raw), "one_hot": ft.normalize_pop(encoded(spark, sf).select("features"))}
    scores = [gearbox.sweep_scores(data, (5, 10)).withColumn("variant", F.lit(name)) for name, data in variants.items()]
    return scores[0].unionByName(scores[1]).unionByName(scores[2])


@query
def h9_elbow_deltas(spark, sf):
    return cl.elbow_deltas(lloyd_scores(spark, sf)).select("k", rounded("avg_distance"), rounded("drop"), "largest_drop")


@query
def h10_label_counts(spark, sf):
    return cl.label_counts(table(spark, sf, "embeddings"))


@query
def h10_event_counts(spark, sf):
    return cl.label_counts(table(spark, sf, "events").withColumnRenamed("event_type", "label"))


@query
def h11_cluster_label_counts(spark, sf):
    return cl.cluster_label_counts(lloyd_scored(spark, sf))


@query
def h12_cluster_entropy(spark, sf):
    return cl.cluster_entropy(lloyd_scored(spark, sf)).select(rounded("entropy"))


# Outliers


@query
def h13_top_outliers(spark, sf):
    return ol.top_outliers(lloyd_scored(spark, sf)).select("point_id", "prediction", rounded("distance"))


@query
def h14_anomaly_threshold(spark, sf):
    return ol.anomaly_threshold(lloyd_scored(spark, sf)).select(rounded("threshold"))


@query
def h15_anomalies(spark, sf):
    return ol.anomalies(lloyd_scored(spark, sf)).select("point_id", rounded("distance"))


@query
def h15_anomaly_share(spark, sf):
    share = ol.anomaly_share(lloyd_scored(spark, sf))
    return share.select(rounded("threshold"), "total", "anomalies", rounded("percent"))


@query
def h16_fixed_sample(spark, sf):
    events = table(spark, sf, "events", "event_id").select("event_id", "event_type", "value")
    return ol.fixed_sample(events, key="event_id")


@query
def h17_project_2d(spark, sf):
    scored = lloyd_scored(spark, sf)
    points, _ = ol.project_2d(scored, ol.fixed_sample(scored))
    return points.select("point_id", "x", "y", "prediction", "is_outlier")


@query
def h18_outlier_sources(spark, sf):
    return ol.outlier_sources(lloyd_tops(spark, sf))


@query
def h18_outlier_overlap(spark, sf):
    return ol.outlier_overlap(lloyd_tops(spark, sf))


@query
def h19_timed_runs(spark, sf):
    return grid_runs(spark, sf).select("run_name", "runtime_seconds")


@query
def h19_timed_stages(spark, sf):
    return lsa.timed_fit(documents(spark, sf), tk.tokens_regex, o.WIDE_FREQ, 25)[1]


@query
def h20_explained_variance(spark, sf):
    scored = lloyd_scored(spark, sf)
    _, explained = ol.project_2d(scored, scored)
    return spark.createDataFrame(list(enumerate(explained, 1)), "component int, share double")


@query
def h21_relative_distance(spark, sf):
    return ol.relative_distance(lloyd_scored(spark, sf)).select("point_id", rounded("relative"))


# Grids


@query
def i1_lsa_grid(spark, sf):
    return grid_runs(spark, sf)


@query
def i2_pick_best(spark, sf):
    return lsa.pick_best(grid_runs(spark, sf)).select("tokenizer", "numFreq", "k", rounded("energy"))


# Classification


@query
def j1_clean_labels(spark, sf):
    docs = table(spark, sf, "documents", "doc_id").join(table(spark, sf, "labels", "doc_id"), "doc_id", "left")
    answer = F.when(F.col("toxic") == 1, "Yes").when(F.col("toxic") == 0, "No")
    return jc.clean_labels(docs.withColumn("answer", answer), "answer").select("doc_id", "answer")


@query
def j2_hash_split(spark, sf):
    train, test = jc.hash_split(labelled_docs(spark, sf), "doc_id")
    part = lambda df, name: df.select("doc_id", F.lit(name).alias("part"))
    return part(train, "train").unionByName(part(test, "test"))


@query
def j3_index_categories(spark, sf):
    rows = jc.index_categories(labelled_docs(spark, sf), ("lang", "source"))
    return rows.select("doc_id", F.col("lang_indexed").cast("int").alias("lang_indexed"), F.col("source_indexed").cast("int").alias("source_indexed"))


def split_docs(spark, sf) -> tuple[DataFrame, DataFrame]:
    rows = through_table(labelled_docs(spark, sf).withColumn("answer", F.col("toxic").cast("string")), "labelled")
    return jc.hash_split(rows, "doc_id")


def tree_stages(classifier, label: str = "answer"):
    return jc.tree_pipeline(("lang", "source"), ("n_chars",), label, classifier)


def predictions(model, test: DataFrame) -> DataFrame:
    return model.transform(test).select("doc_id", "label", "prediction")


@query
def j4_tree_pipeline(spark, sf):
    train, test = split_docs(spark, sf)
    return predictions(tree_stages(jc.decision_tree()).fit(train), test)


@query
def j5_tune_cv(spark, sf):
    train, test = split_docs(spark, sf)
    tree = jc.decision_tree()
    grid = jc.tree_grid(tree, impurities=("entropy", "gini"), depths=(6,), bins=(50,))
    tuned = jc.tune_cv(tree_stages(tree), grid, jc.area_under_roc(), folds=3, parallelism=4).fit(train)
    return predictions(tuned.bestModel, test)


@query
def j6_tune_tvs(spark, sf):
    train, test = split_docs(spark, sf)
    tree = jc.decision_tree()
    grid = jc.tree_grid(tree, impurities=("entropy", "gini"), depths=(6,), bins=(50,))
    tuned = jc.tune_tvs(tree_stages(tree), grid, jc.area_under_roc(), parallelism=4).fit(train)
    return predictions(tuned.bestModel, test)


@query
def j7_binary_metrics(spark, sf):
    areas = jc.binary_metrics(labelled_docs(spark, sf), "n_chars", "toxic")
    return areas.select(rounded("area_under_roc"), rounded("area_under_pr"))


def long_guess(spark, sf) -> DataFrame:
    return labelled_docs(spark, sf).withColumn("prediction", (F.col("n_chars") > o.SHORT_DOC).cast("int"))


@query
def j8_class_metrics(spark, sf):
    per_label = jc.class_metrics(long_guess(spark, sf), label="quality")
    return per_label.select("label", "support", rounded("precision"), rounded("recall"))


@query
def j9_gbt_one_vs_rest(spark, sf):
    train, test = split_docs(spark, sf)
    return predictions(tree_stages(jc.gbt_one_vs_rest(), "answer").fit(train), test)


@query
def j10_forest_cv(spark, sf):
    train, test = split_docs(spark, sf)
    forest = jc.random_forest()
    grid = jc.tree_grid(forest, impurities=("gini",), depths=(6,), bins=(50,), trees=(5, 10))
    tuned = jc.tune_cv(tree_stages(forest), grid, jc.accuracy(), folds=3, parallelism=4).fit(train)
    return predictions(tuned.bestModel, test)


@query
def j11_compare_models(spark, sf):
    by_length = jc.class_metrics(long_guess(spark, sf), label="quality")
    clean = labelled_docs(spark, sf).withColumn("prediction", 1 - F.col("toxic"))
    by_toxicity = jc.class_metrics(clean, label="quality")
    table_ = jc.compare_models({"by_length": jc.overall_metrics(by_length), "by_toxicity": jc.overall_metrics(by_toxicity)})
    return table_.select("metric", rounded("by_length"), rounded("by_toxicity"))
