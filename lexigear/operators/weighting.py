"""Term counts, document frequencies, vocabulary and TF-IDF weights.

Input is always a frame with ``doc_id`` and a token array ``features``, one row per
document.  Counting within a document never shuffles; only document frequencies do,
after partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexigear.functions.text import run_lengths
from lexigear.functions.vectors import literal
from lexigear.shared import through_table

# A vocabulary beyond this size is joined by shuffle instead of being broadcast, to the
# same result.
MAX_BROADCAST_TERMS = 1_000_000
# The most frequent terms of a larger one are shipped nevertheless.
HOT_TERMS = 10_000


def term_freqs(docs: DataFrame) -> DataFrame:
    """``doc_id, term, tf, doc_len``; ``doc_len`` counts all tokens of the document."""
    # The runs are computed inside the generator.  As a column of their own they would get
    # a not-empty filter, pushed down to where it computes tokens and runs once more.
    return docs.select(
        "doc_id", F.size("features").cast("long").alias("doc_len"),
        F.inline(run_lengths(F.col("features"))),
    ).select("doc_id", "term", "tf", "doc_len")


def doc_lengths(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.size("features").cast("long").alias("doc_len"))


def doc_freqs(docs: DataFrame) -> DataFrame:
    """``term, df``: in how many documents each term occurs."""
    return (
        docs.select(F.explode(F.array_distinct("features")).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )


def vocabulary(docs: DataFrame, num_freq: int) -> DataFrame:
    """``term_id, term, df, idf`` of the ``num_freq`` terms found in most documents.

    Ids count from 0 in order of df descending, then term.  ``idf = ln(N / df)`` with N
    the number of documents, tokens or none.
    """
    top = doc_freqs(docs).orderBy(F.desc("df"), "term").limit(num_freq)
    total = docs.select(F.count("*").alias("n")).scalar()
    # The one-partition window sees ``num_freq`` rows, never more.
    rank = F.row_number().over(W.orderBy(F.desc("df"), "term")) - 1
    return top.select(rank.alias("term_id"), "term", "df", F.log(total / F.col("df")).alias("idf"))


def with_vocabulary(freqs: DataFrame, vocab: DataFrame, num_freq: int) -> DataFrame:
    """Keep the counts of vocabulary terms and attach id and idf."""
    known = vocab.select("term", "term_id", "idf")
    return freqs.join(F.broadcast(known) if num_freq <= MAX_BROADCAST_TERMS else known, "term")


def tfidf(docs: DataFrame, vocab: DataFrame, num_freq: int) -> DataFrame:
    """``doc_id, term_id, term, weight`` with ``weight = idf * tf / doc_len``."""
    weight = F.col("idf") * F.col("tf") / F.col("doc_len")
    return with_vocabulary(term_freqs(docs), vocab, num_freq).select(
        "doc_id", "term_id", "term", weight.alias("weight")
    )


@dataclass(frozen=True)
class Vocabulary:
    """A vocabulary on the driver: ``num_freq`` entries, in term id order."""

    terms: Sequence[str]
    df: Sequence[int]
    idf: Sequence[float]

    @classmethod
    def fetch(cls, vocab: DataFrame) -> Vocabulary:
        rows = sorted(vocab.select("term_id", "term", "df", "idf").collect())
        return cls([r.term for r in rows], [r.df for r in rows], [r.idf for r in rows])

    def head(self, n: int) -> Vocabulary:
        """A smaller vocabulary of the same documents."""
        return Vocabulary(self.terms[:n], self.df[:n], self.idf[:n])

    def frame(self, spark) -> DataFrame:
        rows = [(i, t, n, w) for i, (t, n, w) in enumerate(zip(self.terms, self.df, self.idf))]
        return spark.createDataFrame(rows, "term_id int, term string, df long, idf double")

    def __len__(self) -> int:
        return len(self.terms)


def doc_term_matrix(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """The input plus the document's TF-IDF row as two arrays, ``ids`` and ``weights``.

    ``CountVectorizerModel`` counts the vocabulary terms of a document where it lies, so
    the whole step needs no shuffle.  A document without vocabulary terms, or with null
    in place of tokens, has empty arrays: a zero row.
    """
    docs = docs.withColumn("features", F.coalesce("features", F.array().cast("array<string>")))
    if not len(vocab):
        return docs.select("*", F.array().cast("array<int>").alias("ids"), F.array().cast("array<double>").alias("weights"))
    counter = CountVectorizerModel.from_vocabulary(
        list(vocab.terms), inputCol="features", outputCol="_vector"
    )
    length, idf = F.size("features"), literal(vocab.idf)
    counted = counter.transform(docs).select(*docs.columns, F.unwrap_udt("_vector").alias("_raw"))
    ids, counts = F.col("_raw.indices"), F.col("_raw.values")
    weights = F.zip_with(ids, counts, lambda i, tf: F.get(idf, i) * tf / length)
    return counted.select(*docs.columns, ids.alias("ids"), weights.alias("weights"))


def doc_term_matrix_joined(docs: DataFrame, vocab: DataFrame, hot_terms: int = HOT_TERMS) -> DataFrame:
    """``doc_term_matrix`` for vocabularies (``term_id, term, idf``) too large to ship.

    Ids follow document frequency, so the ``hot_terms`` lowest are the most frequent terms.
    These are shipped; any other term has at most one part in ``hot_terms`` of all entries,
    and those meet the rest of the vocabulary in a shuffle without hot keys.  Rows of one id
    are rows of their own.
    """
    docs = docs.withColumn("features", F.coalesce("features", F.array().cast("array<string>")))
    numbered = through_table(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    known = vocab.select(F.col("term").alias("_term"), F.col("term_id").cast("int").alias("_id"), F.col("idf").alias("_idf"))
    # As in ``term_freqs``, the runs are computed inside the generator.
    counted = numbered.select("_row", F.size("features").alias("_len"), F.inline(run_lengths(F.col("features"))))
    hot = F.broadcast(known.where(F.col("_id") < hot_terms))
    counted = counted.join(hot, F.col("term") == F.col("_term"), "left").drop("_term")
    # A shipped term finds no other partner; its entries go to keys of their own.
    key = F.when(F.col("_id").isNull(), F.col("term")).otherwise(F.concat(F.lit("\u0000"), F.col("_row").cast("string")))
    rest = known.where(F.col("_id") >= hot_terms).withColumnsRenamed({"_id": "_far_id", "_idf": "_far_idf"})
    found = counted.withColumn("_key", key).join(rest, F.col("_key") == F.col("_term"), "left")
    entry = F.struct(F.coalesce("_id", "_far_id").alias("i"), (F.coalesce("_idf", "_far_idf") * F.col("tf") / F.col("_len")).alias("w"))
    rows = found.where("coalesce(_id, _far_id) IS NOT NULL").groupBy("_row").agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
    joined = numbered.join(rows, "_row", "left")
    none = F.array()
    return joined.select(
        *docs.columns,
        F.coalesce(F.col("_entries.i"), none.cast("array<int>")).alias("ids"),
        F.coalesce(F.col("_entries.w"), none.cast("array<double>")).alias("weights"),
    )


def matrix_entries(matrix: DataFrame) -> DataFrame:
    """``doc_id, term_id, weight`` of the stored entries of ``doc_term_matrix``."""
    zipped = F.arrays_zip(F.col("ids").alias("term_id"), F.col("weights").alias("weight"))
    return matrix.select("doc_id", F.inline(zipped))


def corpus_stats(
    docs: DataFrame, num_freq: int, files: DataFrame | None = None, stop_words: DataFrame | None = None
) -> DataFrame:
    """One row of counts: documents, tokens, distinct terms, vocabulary, matrix size, and,
    where they are given, input files (one row each) and stop words."""
    per_doc = docs.select(F.size("features").alias("n"))
    totals = per_doc.agg(
        F.count("*").alias("num_docs"),
        F.sum("n").alias("num_tokens"),
        F.sum((F.col("n") == 0).cast("long")).alias("empty_docs"),
    )
    terms = doc_freqs(docs).agg(F.count("*").alias("n")).scalar()
    for name, given in (("num_files", files), ("num_stop_words", stop_words)):
        if given is not None:
            totals = totals.withColumn(name, given.distinct().agg(F.count("*").alias("n")).scalar())
    return (
        totals.withColumn("num_terms", terms)
        .withColumn("vocabulary_size", F.least("num_terms", F.lit(num_freq).cast("long")))
        .withColumn("matrix_rows", F.col("num_docs"))
        .withColumn("matrix_cols", F.col("vocabulary_size"))
    )
