"""Whole LSA jobs: fit, parameter grid, movie plots."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigear.functions import text as fx
from lexigear.functions import vectors as vx
from lexigear.operators import concepts as co
from lexigear.operators import search as se
from lexigear.operators import tokens as tk
from lexigear.operators import weighting as wt
from lexigear.operators.decomposition import LsaModel, factorize, lsa_fit, project
from lexigear.shared import is_table, through_table

# The default parameter grid.
GRID_NUM_FREQ = (5000, 10000, 20000)
GRID_K = (25, 100, 250)


TOKENIZERS = {"regex": tk.tokens_regex, "exercise": tk.tokens_exercise, "nlp": tk.tokens_lemma}


def fit(
    docs: DataFrame, num_freq: int, k: int, keep: bool = False, tokenizer: str = "regex",
    lexicon: DataFrame | None = None, **options,
) -> LsaModel:
    """Decompose documents with token arrays (``doc_id, title, features``).

    The documents are tokenized once: their tokens are persisted until the weighted rows
    are, unless they are read from a table as they are, and the rows while the solver runs.
    Both go to disk: in memory they would fill the heap of any executor, and each pass
    reads them once from the first row to the last.  With ``keep`` the document factors are written
    to the shared folder, so that any number of searches read them instead of projecting
    the documents anew, and nothing stays persisted.  ``tokenizer`` and ``lexicon`` are
    kept for queries; ``options`` go to the solver.
    """
    computed = not is_table(docs)
    tokens = docs.persist(StorageLevel.DISK_ONLY) if computed else docs
    vocab = wt.Vocabulary.fetch(wt.vocabulary(tokens, num_freq))
    matrix = wt.doc_term_matrix(tokens, vocab).drop("features").persist(StorageLevel.DISK_ONLY)
    matrix.count()
    if computed:
        tokens.unpersist()
    model = replace(lsa_fit(matrix, vocab, k, **options), tokenizer=tokenizer, lexicon=lexicon)
    if keep:
        model = replace(model, documents=through_table(model.documents, "factors"))
        matrix.unpersist()
    return model


def query_terms(model: LsaModel, text: str) -> list[str]:
    """The terms of a query text, made the way the model's documents were tokenized.

    Its words are lemmatized against the documents' lexicon, so "wolves" finds documents
    about a wolf although they never say "wolves".
    """
    row = model.spark.createDataFrame([(0, text)], "doc_id int, text string")
    return query_tokens(model, row).head().features


def query_tokens(model: LsaModel, queries: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``features`` of many query texts at once, as ``query_terms``."""
    if model.tokenizer == "nlp":
        return tk.tokens_lemma(queries, text, lexicon=model.lexicon, key=key)
    return TOKENIZERS[model.tokenizer](queries, text, key=key)


def timed_fit(
    docs: DataFrame, tokenize: Callable[[DataFrame], DataFrame], num_freq: int, k: int
) -> tuple[LsaModel, DataFrame]:
    """Fit with every stage run to its end, and the seconds each stage took."""
    times = []

    def timed(stage: str, action):
        start = time.perf_counter()
        result = action()
        times.append((stage, time.perf_counter() - start))
        return result

    tokens = tokenize(docs).select("doc_id", "title", "features").persist(StorageLevel.MEMORY_AND_DISK)
    timed("tokens", tokens.count)
    vocab = timed("vocabulary", lambda: wt.Vocabulary.fetch(wt.vocabulary(tokens, num_freq)))
    matrix = wt.doc_term_matrix(tokens, vocab).drop("features").persist(StorageLevel.MEMORY_AND_DISK)
    timed("matrix", matrix.count)
    sigma, v = timed("decomposition", lambda: factorize(matrix, len(vocab), k))
    factors = timed("document factors", lambda: through_table(project(matrix, sigma, v), "factors"))
    matrix.unpersist()
    tokens.unpersist()
    stages = docs.sparkSession.createDataFrame(times, "stage string, seconds double")
    return LsaModel(vocab, sigma, v, factors), stages


def grid(
    docs: DataFrame,
    tokenizers: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
    num_freqs: Sequence[int] = GRID_NUM_FREQ,
    ks: Sequence[int] = GRID_K,
    shared: bool = False,
    folder: str | None = None,
) -> list[dict]:
    """Every combination of tokenizer, vocabulary size and k, with runtimes.

    Documents are tokenized once per tokenizer and document frequencies counted once:
    a smaller vocabulary is the head of a larger one.  Each k has a decomposition of its
    own, so that ``runtime_seconds`` is what the run would take alone: tokens, weights
    and its decomposition.  With ``shared`` one decomposition at the largest k serves all
    ks of a vocabulary, and they report its time.  ``energy`` is the part of the squared
    weights the k concepts keep.

    With a ``folder``, of its own for these documents, finished runs are appended to a table
    in it, and the run at work saves its state after each pass.  Called again after a
    failure, the grid takes the finished runs from there and goes on within the broken one,
    whose time then counts from the start of the call.
    """
    if tokenizers is None:
        tokenizers = {"regex": tk.tokens_regex, "nlp": tk.tokens_lemma}
    spark = docs.sparkSession
    done = {r["run_name"]: r for r in _finished(spark, folder)} if folder else {}
    runs = []
    for name, tokenize in tokenizers.items():
        wanted = [(num_freq, k, f"{name}_{num_freq}_{k}") for num_freq in num_freqs for k in ks]
        if all(run in done for *_, run in wanted):
            runs.extend(done[run] for *_, run in wanted)
            continue
        start = time.perf_counter()
        tokens = tokenize(docs).select("doc_id", "features").persist(StorageLevel.MEMORY_AND_DISK)
        largest = wt.Vocabulary.fetch(wt.vocabulary(tokens, max(num_freqs)))
        token_seconds = time.perf_counter() - start
        for num_freq in num_freqs:
            start = time.perf_counter()
            vocab = largest.head(num_freq)
            matrix = wt.doc_term_matrix(tokens, vocab).select("ids", "weights").persist()
            total = matrix.agg(F.sum(vx.dot(F.col("weights"), F.col("weights")))).head()[0] or 0.0
            weight_seconds = token_seconds + time.perf_counter() - start
            sigma = None
            for k in ks:
                run = f"{name}_{num_freq}_{k}"
                if run in done:
                    runs.append(done[run])
                    continue
                if not shared or sigma is None:
                    start = time.perf_counter()
                    at = max(ks) if shared else k
                    progress = f"{folder}/progress/{name}_{num_freq}_{at}" if folder else None
                    sigma, _ = factorize(matrix, len(vocab), at, progress=progress)
                    seconds = weight_seconds + time.perf_counter() - start
                energy = float((sigma[:k] ** 2).sum() / total) if total else 0.0
                runs.append({"run_name": run, "tokenizer": name, "numFreq": num_freq, "k": k, "runtime_seconds": seconds, "energy": energy})
                if folder:
                    row = spark.createDataFrame([tuple(runs[-1].values())], RUN_SCHEMA)
                    row.coalesce(1).write.mode("append").parquet(f"{folder}/runs")
            matrix.unpersist()
        tokens.unpersist()
    return runs


def _finished(spark: SparkSession, folder: str) -> list[dict]:
    """The runs of a grid that its folder holds."""
    try:
        return [r.asDict() for r in spark.read.schema(RUN_SCHEMA).parquet(f"{folder}/runs").collect()]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


RUN_SCHEMA = (
    "run_name string, tokenizer string, numFreq int, k int, runtime_seconds double, energy double"
)


def pick_best(runs: DataFrame) -> DataFrame:
    """The run that keeps most energy; ties go to the cheaper parameters."""
    return runs.orderBy(F.desc(F.round("energy", 9)), "k", "numFreq", "tokenizer").limit(1)


def movie_docs(movies: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """Movies (``Title, Genre, Plot``) as documents with ``features``.

    Titles are not unique (remakes), so the id is a hash of the whole record.
    """
    record = F.md5(F.concat_ws("\u0001", "Title", "Genre", "Plot"))
    docs = movies.select(
        record.alias("doc_id"), F.col("Title").alias("title"), F.col("Genre").alias("genre"),
        F.col("Plot").alias("text"),
    )
    return tk.with_features(docs, "text", lexicon=lexicon).drop("text")


def movie_lsa(movies: DataFrame, num_freq: int = 5000, k: int = 25, **options) -> LsaModel:
    """A model of lemmatized plots that lemmatizes its queries alike.

    Its documents keep ``genre``; rank concepts with ``top_terms`` and ``top_docs``, and
    search it with ``movie_search``.
    """
    words = movies.select(fx.matches("Plot", fx.LETTERS).alias(tk.FEATURES))
    lexicon = tk.lexicon_of(words)
    return fit(movie_docs(movies, lexicon), num_freq, k, tokenizer="nlp", lexicon=lexicon, **options)


def movie_search(model: LsaModel, text: str, n: int = 10) -> DataFrame:
    """``doc_id, title, score, genres`` of the movies closest to a keyword query."""
    found = se.search_cosine(model, query_terms(model, text), n)
    return co.top_docs_with_genres(found, model.documents.select("doc_id", "genre"))
