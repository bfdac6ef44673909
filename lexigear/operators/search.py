"""Searching in concept space.

A query is small (terms of one line of text) and becomes an array literal; the
documents are scored where they lie and only the best ``n`` leave their tasks.
Scores are compared after rounding to nine digits, so that exact copies of a document
tie and are listed by id.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigear.functions import vectors as vx
from lexigear.operators.decomposition import LsaModel
from lexigear.shared import numbered_rows, through_table

DIGITS = 9
# Queries multiplied together, and bytes of query factors shipped for one scan.
QUERIES_PER_BLOCK = 1_000
MAX_SHIPPED_BYTES = 256 * 1024 * 1024
# Scores a task holds at a time.
SCORES_PER_STEP = 500_000


def query_vector(queries: DataFrame, vocab: DataFrame, key: str = "query_id") -> DataFrame:
    """``key, term_id, term, weight``: idf per known term, repeated terms add up.

    ``queries`` has a token array ``features`` made by the tokenizer of the documents.
    """
    terms = queries.select(key, F.explode("features").alias("term"))
    known = terms.join(vocab.select("term", "term_id", "idf"), "term")
    return known.groupBy(key, "term_id", "term").agg(F.sum("idf").alias("weight"))


def concept_query(model: LsaModel, terms: Sequence[str]) -> np.ndarray:
    """``V' q`` for the query of the given terms; unknown terms count nothing."""
    ids = {t: i for i, t in enumerate(model.vocab.terms)}
    q = np.zeros(model.k)
    for term in terms:
        if term in ids:
            q += model.vocab.idf[ids[term]] * model.v[ids[term]]
    return q


def _score(score: Column) -> Column:
    # Adding zero turns a negative zero into a plain one.
    return F.round(score, DIGITS) + F.lit(0.0)


def _best(df: DataFrame, score: Column, n: int, *keys: str) -> DataFrame:
    scored = df.select(*keys, _score(score).alias("score")).where(
        F.col("score").isNotNull() & ~F.isnan("score")
    )
    return scored.orderBy(F.desc("score"), keys[0]).limit(n)


def search(model: LsaModel, terms: Sequence[str], n: int = 10) -> DataFrame:
    """``doc_id, title, score``: largest products of ``U S`` with the query."""
    weights = vx.literal(concept_query(model, terms) * model.sigma)
    return _best(model.documents, vx.dot(F.col("u"), weights), n, "doc_id", "title")


def _cosine(rows: Column, direction: np.ndarray) -> Column:
    length = float(np.linalg.norm(direction))
    if length == 0.0:
        return F.lit(None).cast("double")
    own = vx.norm(rows)
    return F.when(own > 0, vx.dot(rows, vx.literal(direction / length)) / own)


def search_cosine(model: LsaModel, terms: Sequence[str], n: int = 10, docs: str = "US") -> DataFrame:
    """Cosine between query and document.

    ``docs='US'`` compares ``V' q`` with rows of ``U S``.  ``docs='U'`` compares the sum
    of the scaled term rows ``V S`` with rows of ``U``.
    """
    if docs == "US":
        rows, query = vx.scale(F.col("u"), model.sigma), concept_query(model, terms)
    elif docs == "U":
        ids = {t: i for i, t in enumerate(model.vocab.terms)}
        known = [model.v[ids[t]] * model.sigma for t in terms if t in ids]
        rows, query = F.col("u"), np.sum(known, axis=0) if known else np.zeros(model.k)
    else:
        raise ValueError("docs must be 'US' or 'U'")
    return _best(model.documents, _cosine(rows, query), n, "doc_id", "title")


def similar_docs(model: LsaModel, doc_id, n: int = 10) -> DataFrame:
    """Documents by cosine of ``U S`` rows; the document itself is among them."""
    found = model.documents.where(F.col("doc_id") == F.lit(doc_id)).select("u").head()
    if found is None:
        raise KeyError(f"no document {doc_id!r}")
    direction = np.array(found.u) * model.sigma
    rows = vx.scale(F.col("u"), model.sigma)
    return _best(model.documents, _cosine(rows, direction), n, "doc_id", "title")


def _term_row(model: LsaModel, term: str) -> np.ndarray:
    try:
        return model.v[list(model.vocab.terms).index(term)]
    except ValueError:
        raise KeyError(f"{term!r} is not in the vocabulary") from None


def similar_terms(model: LsaModel, term: str, n: int = 10) -> DataFrame:
    """``term_id, term, score``: terms by cosine of ``V S`` rows, itself included."""
    direction = _term_row(model, term) * model.sigma
    rows = vx.scale(F.col("v"), model.sigma)
    return _best(model.terms(), _cosine(rows, direction), n, "term_id", "term")


def docs_for_term(model: LsaModel, term: str, n: int = 10, normalized: bool = True) -> DataFrame:
    """Documents by the product of ``U S`` (rows of unit length if ``normalized``) with
    the term's row of ``V``."""
    row = _term_row(model, term)
    rows = vx.scale(F.col("u"), model.sigma)
    score = vx.dot(rows, vx.literal(row))
    if normalized:
        own = vx.norm(rows)
        score = F.when(own > 0, score / own)
    return _best(model.documents, score, n, "doc_id", "title")


def batch_search(
    model: LsaModel, queries: DataFrame, n: int = 10, cosine: bool = False,
    queries_per_block: int = QUERIES_PER_BLOCK, shipped_bytes: int = MAX_SHIPPED_BYTES,
) -> DataFrame:
    """``query_id, rank, doc_id, title, score`` of the best documents per query.

    ``queries`` is ``query_id, features``.  One scan of the documents serves all queries
    whose factors stay below ``shipped_bytes``, over a hundred thousand of them: they are
    shipped in blocks, every task multiplies its batches with each block and keeps the best
    ``n`` per query, so what is shuffled is ``n`` rows per query and task.  A query without
    any known term has no result.
    """
    # Written out, the queries are tokenized once.
    vectors = through_table(query_vector(queries, model.vocab.frame(model.spark)), "queries")
    numbers = through_table(numbered_rows(vectors.select("query_id").distinct(), "query_id", name="query_no"), "queries")
    found, shipped = [], []
    for blocks in _groups(_query_blocks(vectors.join(numbers, "query_id"), model, cosine, queries_per_block), shipped_bytes):
        sent = [(no, model.spark.sparkContext.broadcast(block)) for no, block in blocks]
        shipped.extend(block for _, block in sent)
        found.append(scan_once(model, sent, n, cosine))
    results = reduce(DataFrame.unionByName, found or [scan_once(model, [], n, cosine)])
    order = W.partitionBy("query_no").orderBy(F.desc("score"), "doc_id")
    ranked = results.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    out = through_table(ranked.join(numbers, "query_no").select("query_id", "rank", "doc_id", "title", "score"), "found")
    for block in shipped:
        block.destroy()
    return out


def _query_blocks(vectors: DataFrame, model: LsaModel, cosine: bool, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Query numbers and their rows of ``Q V``, a block of ``size`` numbers at a time.

    Rows come to the driver in order, a partition at a time.  With ``cosine`` rows have
    length one, and those without a direction are left out.
    """
    rows = vectors.select("query_no", "term_id", "weight").orderBy("query_no").toLocalIterator()
    for number, own in groupby(rows, key=lambda r: r.query_no // size):
        block = np.zeros((size, model.k))
        there = np.zeros(size, dtype=bool)
        for r in own:
            block[r.query_no - number * size] += r.weight * model.v[r.term_id]
            there[r.query_no - number * size] = True
        at = np.flatnonzero(there)
        block = block[at]
        if cosine:
            length = np.linalg.norm(block, axis=1)
            at, block = at[length > 0], block[length > 0] / length[length > 0, None]
        yield at + number * size, block


def _groups(blocks: Iterator, limit: int) -> Iterator[list]:
    """Blocks that may be shipped together."""
    held, size = [], 0
    for numbers, block in blocks:
        if held and size + block.nbytes > limit:
            yield held
            held, size = [], 0
        held.append((numbers, block))
        size += block.nbytes
    if held:
        yield held


def scan_once(model: LsaModel, blocks: list, n: int, cosine: bool) -> DataFrame:
    """``doc_id, title, query_no, score``: the best ``n`` of every task for every query of
    the shipped ``blocks``, from one scan of the documents."""
    sigma = model.sigma
    docs = model.documents.select("doc_id", "title", "u")
    schema = T.StructType(docs.select("doc_id", "title").schema.fields)
    schema.add("query_no", T.LongType()).add("score", T.DoubleType())

    def best(batches):
        kept: list = [None] * len(blocks)
        rows = max(n, SCORES_PER_STEP // max((len(numbers) for numbers, _ in blocks), default=1), 1)
        for pdf in (batch.iloc[i : i + rows] for batch in batches for i in range(0, len(batch), rows)):
            us = np.array(pdf.u.tolist()).reshape(len(pdf), len(sigma)) * sigma
            if cosine:
                own = np.linalg.norm(us, axis=1)
                pdf, us = pdf[own > 0], us[own > 0] / own[own > 0, None]
            by_id = np.argsort(pdf.doc_id.to_numpy(), kind="stable")
            names, us = pdf[["doc_id", "title"]].iloc[by_id], us[by_id]
            for i, (numbers, block) in enumerate(blocks):
                scores = np.round(us @ block.value.T, DIGITS) + 0.0
                # Largest first; a stable sort leaves equal scores in order of id.
                first = np.argsort(-scores, axis=0, kind="stable")[:n]
                found = names.iloc[first.ravel()].assign(
                    query_no=np.tile(numbers, len(first)),
                    score=np.take_along_axis(scores, first, axis=0).ravel(),
                )
                both = found if kept[i] is None else pd.concat([kept[i], found])
                both = both.sort_values(["query_no", "score", "doc_id"], ascending=[True, False, True])
                kept[i] = both.groupby("query_no", sort=False).head(n)
        yield from (k for k in kept if k is not None)

    return docs.mapInPandas(best, schema)
