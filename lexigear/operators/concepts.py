"""What a concept is about: its strongest terms and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexigear.operators.decomposition import LsaModel


def _top(rows: DataFrame, vector: str, key: str, num_concepts: int, n: int) -> DataFrame:
    """Largest ``n`` weights of each of the first concepts, signed, ties by key.

    All concepts are ranked in one pass.  Spark keeps ``n`` rows per concept in every
    task before it shuffles, so a concept's window never sees all documents.
    """
    each = rows.select(
        "*", F.posexplode(F.slice(vector, 1, num_concepts)).alias("concept", "weight")
    ).drop(vector)
    order = W.partitionBy("concept").orderBy(F.desc("weight"), key)
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def top_terms(model: LsaModel, num_concepts: int = 25, num_terms: int = 25) -> DataFrame:
    """``concept, rank, term_id, term, weight``."""
    top = _top(model.terms(), "v", "term_id", num_concepts, num_terms)
    return top.select("concept", "rank", "term_id", "term", "weight")


def top_docs(model: LsaModel, num_concepts: int = 25, num_docs: int = 25) -> DataFrame:
    """``concept, rank, doc_id, title, weight``."""
    docs = model.documents.select("doc_id", "title", "u")
    top = _top(docs, "u", "doc_id", num_concepts, num_docs)
    return top.select("concept", "rank", "doc_id", "title", "weight")


def concept_table(terms: DataFrame, docs: DataFrame) -> DataFrame:
    """One row per concept: its top terms and top documents as text, best first."""

    def listed(top: DataFrame, label: str, name: str) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("rank", label)))
        return top.groupBy("concept").agg(F.array_join(ordered[label], ", ").alias(name))

    return listed(terms, "term", "terms").join(listed(docs, "title", "titles"), "concept")


def genre_labels(genre, n: int = 5):
    """The first ``n`` labels of a genre field, all if there are fewer."""
    labels = F.filter(F.split(genre, r"\s*[,/]\s*"), lambda g: g != "")
    return F.slice(F.transform(labels, lambda g: F.trim(g)), 1, n)


def top_docs_with_genres(
    top: DataFrame, genres: DataFrame, key: str = "doc_id", genre: str = "genre"
) -> DataFrame:
    """Attach genre labels to ``top_docs`` output.

    The short list of top documents is the small side, bounded by concepts x documents
    per concept, so it is the one to broadcast.
    """
    labels = genres.select(key, genre_labels(F.col(genre)).alias("genres"))
    return labels.join(F.broadcast(top), key)
