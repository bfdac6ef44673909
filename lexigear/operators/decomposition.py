"""Truncated singular value decomposition of the document-term matrix."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigear.functions import vectors as vx
from lexigear.operators.blocks import PIECE, SLICES, SUMMED, LocalBlocks, Progress, TableBlocks, summands, summed
from lexigear.operators.weighting import Vocabulary

# Largest piece of the term factors shipped to the executors at once.
MAX_SHIPPED_BYTES = 256 * 1024 * 1024
# Doubles held by one array operation inside a task.
DOUBLES_PER_STEP = 250_000
# Doubles of the dense rows that a task multiplies at a time.
DENSE_DOUBLES = 1_000_000
# Up to this many terms ``A'A`` itself takes one pass.  More terms iterate, to the same
# result.
SMALL = 1024
# Blocks of directions kept, and up to how many bytes with their images on the driver.
MAX_BLOCKS = 12
LOCAL_BYTES = 512 * 1024 * 1024
# A singular value below this part of the largest counts as zero: the default of Spark's
# ``computeSVD``.
R_COND = 1e-9
# Roots of eigenvalues of A'A carry errors of about 1e-8.  Values below this part of the
# largest are measured again as lengths of A v, whose errors are those of a double.
DOUBTFUL = 1e-6


@dataclass(frozen=True)
class LsaModel:
    """Factors of ``A = U S V'``.

    ``sigma`` (k values) and ``v`` (terms x k) are local, as the decomposition itself
    delivers them.  ``documents`` holds one row ``u`` per document and stays a
    DataFrame; it is never collected.  ``tokenizer`` names how the documents were
    tokenized, and ``lexicon`` (``lemma``) is what their words were lemmatized with, so
    that queries are treated alike.
    """

    vocab: Vocabulary
    sigma: np.ndarray
    v: np.ndarray
    documents: DataFrame
    tokenizer: str = "regex"
    lexicon: DataFrame | None = None

    @property
    def k(self) -> int:
        return len(self.sigma)

    @property
    def spark(self) -> SparkSession:
        return self.documents.sparkSession

    def concepts(self) -> DataFrame:
        rows = [(i, float(s)) for i, s in enumerate(self.sigma)]
        return self.spark.createDataFrame(rows, "concept int, sigma double")

    def terms(self) -> DataFrame:
        """``term_id, term, v``."""
        n, k = self.v.shape
        rows = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(self.v.ravel()))
        table = pa.table({"term_id": pa.array(np.arange(n, dtype=np.int32)), "term": pa.array(list(self.vocab.terms), pa.string()), "v": rows})
        return self.spark.createDataFrame(table, "term_id int, term string, v array<double>")

    def truncate(self, k: int) -> LsaModel:
        """The model of the ``k`` strongest concepts.  Needs no new decomposition."""
        documents = self.documents.withColumn("u", F.slice("u", 1, k))
        return replace(self, sigma=self.sigma[:k], v=self.v[:, :k], documents=documents)


def gram_times(matrix: DataFrame, x: np.ndarray) -> np.ndarray:
    """``A' (A X)`` for a local block ``x`` (terms x b).

    A block that is too large to ship goes in slices of columns, one pass each.
    """
    columns = max(1, MAX_SHIPPED_BYTES // (8 * PIECE * max(1, len(x)))) * PIECE
    if x.shape[1] > columns:
        return np.hstack([gram_times(matrix, x[:, i : i + columns]) for i in range(0, x.shape[1], columns)])
    shipped = matrix.sparkSession.sparkContext.broadcast(x)
    out = gram_times_shipped(matrix, shipped, *x.shape)
    shipped.destroy()
    return out


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sizes, ids and weights of the rows of each batch that have entries."""
    for batch in batches:
        sizes = pc.list_value_length(batch.column("ids")).to_numpy(zero_copy_only=False)
        yield sizes[sizes > 0], batch.column("ids").flatten().to_numpy(), batch.column("weights").flatten().to_numpy()


def _dense(sizes: np.ndarray, ids: np.ndarray, weights: np.ndarray, columns: int) -> np.ndarray:
    """Sparse rows as a matrix; entries of one place add up."""
    at = np.repeat(np.arange(len(sizes)) * columns, sizes) + ids
    return np.bincount(at, weights, len(sizes) * columns).reshape(len(sizes), columns)


def gram_times_shipped(matrix: DataFrame, shipped, rows: int, width: int, slices: int = 1) -> np.ndarray:
    """``A' (A X)`` for a block that the tasks have.

    Every task adds up its share; Spark sums the shares.  There are no more tasks than
    cores, since each has a share to send.  A few documents at a time are a dense matrix of
    the terms they use, which two products of matrices multiply.
    """
    step = max(1, DOUBLES_PER_STEP // max(1, width))

    def shares(batches):
        block = shipped.value
        share = np.zeros(block.shape)
        known, place = np.zeros(len(block), dtype=bool), np.zeros(len(block), dtype=np.int64)
        for sizes, ids, weights in _entries(batches):
            ends = sizes.cumsum()
            first = 0
            while first < len(sizes):
                # As many documents as fit the step, but at least one.
                begin = ends[first] - sizes[first]
                last = max(first + 1, int(np.searchsorted(ends, begin + step, "right")))
                part = slice(begin, ends[last - 1])
                known[ids[part]] = True
                used = np.flatnonzero(known)
                known[used] = False
                place[used] = np.arange(len(used))
                docs = _dense(sizes[first:last], place[ids[part]], weights[part], len(used))
                share[used] += docs.T @ (docs @ block[used])
                first = last
        yield summands(share)

    cores = matrix.sparkSession.sparkContext.defaultParallelism
    parts = matrix.select("ids", "weights").coalesce(cores).mapInArrow(shares, SUMMED)
    return summed(parts, rows, width, slices)


def gram(matrix: DataFrame, num_terms: int) -> np.ndarray:
    """``A'A`` whole, in one pass over the rows as dense matrices of all terms."""
    step = max(1, DENSE_DOUBLES // num_terms)

    def shares(batches):
        share = np.zeros((num_terms, num_terms))
        for sizes, ids, weights in _entries(batches):
            ends = np.r_[0, sizes.cumsum()]
            for first in range(0, len(sizes), step):
                last = min(first + step, len(sizes))
                part = slice(ends[first], ends[last])
                docs = _dense(sizes[first:last], ids[part], weights[part], num_terms)
                share += docs.T @ docs
        yield summands(share)

    cores = matrix.sparkSession.sparkContext.defaultParallelism
    parts = matrix.select("ids", "weights").coalesce(cores).mapInArrow(shares, SUMMED)
    return summed(parts, num_terms, num_terms)


def _lengths(matrix: DataFrame, v: np.ndarray) -> np.ndarray:
    """``|A v|`` of each column: one pass that adds up squares."""
    times = _times(matrix.sparkSession, v)
    rows = matrix.select(F.posexplode(times("ids", "weights")).alias("i", "x"))
    found = np.zeros(v.shape[1])
    for i, total in rows.groupBy("i").agg(F.sum(F.col("x") * F.col("x"))).collect():
        found[i] = np.sqrt(total)
    return found


def factorize(
    matrix: DataFrame, num_terms: int, k: int, tol: float = 1e-9, max_passes: int = 60,
    r_cond: float = R_COND, block: int | None = None, local_bytes: int = LOCAL_BYTES, progress: str | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest singular values and right singular vectors (terms x k).

    ``matrix`` has the arrays ``ids`` and ``weights``; persist it, every step is a pass
    over it.  A pass multiplies a whole block of directions (somewhat more than ``k``
    unless ``block`` gives another width), and the next block is what the directions
    found so far leave unexplained.  That takes about a dozen passes, where multiplying
    one direction at a time takes hundreds.  Up to ``SMALL`` terms a single pass gives
    ``A'A`` itself.

    Directions and their images stay on the driver up to ``local_bytes``; more are kept as a
    table by ranges of terms, and the driver holds less than three blocks at any time.  With
    ``progress``, a folder of its own for this matrix and these arguments, the state is saved
    after each pass, and a run that was broken off goes on from the last one.

    It ends when all ``k`` residuals are below ``tol``, relative to the largest
    eigenvalue of ``A'A``.  If that takes more than ``max_passes``, what has been found is
    returned with a warning that names the residual.  Values below ``r_cond`` times the
    largest count as zero, so fewer than ``k`` come back if the rank is lower, and none
    if all weights are zero or there are no terms.  The sign of a concept is arbitrary;
    here its entry of largest magnitude is positive.
    """
    k = min(k, num_terms)
    if not k:
        return np.empty(0), np.empty((num_terms, 0))
    spark = matrix.sparkSession
    width = min(num_terms, block or PIECE * -(-(k + max(10, k // 4)) // PIECE))
    if block is None and num_terms <= max(SMALL, 2 * width):
        width = num_terms
    held = max(MAX_BLOCKS * width, 2 * k + width)
    if 2 * 8 * num_terms * min(held, num_terms) <= local_bytes:
        # As many directions as terms are the unit vectors, so that the product is A'A.
        blocks = LocalBlocks(lambda x: gram(matrix, num_terms) if width == num_terms else gram_times(matrix, x), num_terms)
    else:
        # One block is shipped whole; products of all directions take a quarter of a block.
        width = min(width, max(PIECE, MAX_SHIPPED_BYTES // (8 * num_terms)))
        held = max(2 * k + width, min(held, int(sqrt(num_terms * width / 4))))
        blocks = TableBlocks(lambda x, b: gram_times_shipped(matrix, x, num_terms, b, SLICES), num_terms, spark, width, held)
    saved = Progress(spark, progress) if progress else None
    last = saved.last() if saved else None
    if last is None:
        blocks.start(width)
    else:
        saved.load(last, blocks)
    for number in range(0 if last is None else last + 1, max_passes):
        small = blocks.extend()
        values, mix = np.linalg.eigh((small + small.T) / 2)
        values, mix = values[::-1], mix[:, ::-1]
        among = min(max(k, width), len(values))
        residual = blocks.residuals(mix[:, :among], values[:among])
        open_ = np.flatnonzero(residual[:k] > tol * max(values[0], 0.0))
        if blocks.columns >= num_terms or blocks.columns >= k and not len(open_):
            break
        if number + 1 == max_passes:
            continue
        # The first directions that are not settled yet, and after them the next best.
        order = np.concatenate((open_, np.setdiff1d(np.arange(among), open_)))[:width]
        blocks.advance(order, width, number + 1)
        if blocks.columns + width > held:
            blocks.restart(mix[:, : held // 2])
        if saved:
            saved.save(number, blocks)
    else:
        warnings.warn(f"{len(open_)} of {k} concepts have not settled after {max_passes} passes; largest residual {residual[:k].max():.3g}", stacklevel=2)
    sigma = np.sqrt(np.maximum(values[:k], 0.0))
    v = blocks.vectors(mix[:, :k])
    if sigma[0] > 0 and (doubtful := sigma < DOUBTFUL * sigma[0]).any():
        sigma[doubtful] = _lengths(matrix, v[:, doubtful])
    real = sigma > r_cond * sigma[0]
    sigma, v = sigma[real], v[:, real]
    order = np.argsort(-sigma, kind="stable")
    sigma, v = sigma[order], v[:, order]
    if not v.size:
        return sigma, v
    largest = v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])]
    return sigma, v * np.where(largest < 0, -1.0, 1.0)


def _times(spark: SparkSession, right: np.ndarray):
    """A function of the arrays of a sparse row that multiplies it by ``right``."""
    shipped = spark.sparkContext.broadcast(np.ascontiguousarray(right))
    step = max(1, DOUBLES_PER_STEP // max(1, right.shape[1]))

    @F.pandas_udf("array<double>")
    def multiply(ids: pd.Series, weights: pd.Series) -> pd.Series:
        factors = shipped.value
        out = np.zeros((len(ids), factors.shape[1]))
        sizes = ids.map(len).to_numpy()
        filled = np.flatnonzero(sizes)
        ends = sizes[filled].cumsum()
        first = 0
        while first < len(filled):
            begin = ends[first] - sizes[filled[first]]
            last = max(first + 1, int(np.searchsorted(ends, begin + step, "right")))
            docs = filled[first:last]
            i = np.concatenate(ids.iloc[docs].to_list())
            w = np.concatenate(weights.iloc[docs].to_list())
            starts = ends[first:last] - sizes[docs] - begin
            out[docs] = np.add.reduceat(factors[i] * w[:, None], starts, axis=0)
            first = last
        return pd.Series(list(out))

    return multiply


def project(matrix: DataFrame, sigma: np.ndarray, v: np.ndarray) -> DataFrame:
    """Replace ``ids`` and ``weights`` by ``u``, the document's row of ``U = A V / S``.

    Each document is multiplied where it lies.  The term factors go to the executors in
    blocks of concepts, so that one block stays below a fixed size.
    """
    if not len(sigma):
        return matrix.withColumn("u", F.array().cast("array<double>")).drop("ids", "weights")
    scaled = v / sigma
    width = max(1, MAX_SHIPPED_BYTES // max(1, scaled.shape[0] * 8))
    blocks = [
        _times(matrix.sparkSession, scaled[:, i : i + width])("ids", "weights")
        for i in range(0, scaled.shape[1], width)
    ]
    return matrix.withColumn("u", F.concat(*blocks) if len(blocks) > 1 else blocks[0]).drop("ids", "weights")


def lsa_fit(matrix: DataFrame, vocab: Vocabulary, k: int, **options) -> LsaModel:
    """Decompose ``doc_term_matrix`` output.  Other columns of a document stay with it.

    ``options`` go to ``factorize``.
    """
    sigma, v = factorize(matrix, len(vocab), k, **options)
    return LsaModel(vocab, sigma, v, project(matrix.drop("features"), sigma, v))


def scale_docs(model: LsaModel) -> DataFrame:
    """Documents with ``us``, their rows of ``U S``."""
    return model.documents.withColumn("us", vx.scale(F.col("u"), model.sigma)).drop("u")


def scale_terms(model: LsaModel) -> DataFrame:
    """Terms with ``vs``, their rows of ``V S``."""
    return model.terms().withColumn("vs", vx.scale(F.col("v"), model.sigma)).drop("v")


def normalize_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows divided by their length.  Zero rows have no direction and are dropped."""
    return df.withColumn(column, vx.unit(F.col(column))).where(F.col(column).isNotNull())


def save_model(model: LsaModel, path: str) -> None:
    """Keep a model for later searches: parquet tables below ``path``."""
    model.documents.write.mode("overwrite").parquet(f"{path}/documents")
    model.concepts().write.mode("overwrite").parquet(f"{path}/concepts")
    model.terms().write.mode("overwrite").parquet(f"{path}/terms")
    model.vocab.frame(model.spark).write.mode("overwrite").parquet(f"{path}/vocabulary")
    kind = model.spark.createDataFrame([(model.tokenizer, model.lexicon is not None)], "tokenizer string, has_lexicon boolean")
    kind.write.mode("overwrite").parquet(f"{path}/tokenizer")
    if model.lexicon is not None:
        model.lexicon.write.mode("overwrite").parquet(f"{path}/lexicon")


def load_model(spark: SparkSession, path: str) -> LsaModel:
    vocab = Vocabulary.fetch(spark.read.parquet(f"{path}/vocabulary"))
    sigma = spark.read.parquet(f"{path}/concepts").orderBy("concept").toArrow().column("sigma").to_numpy()
    terms = spark.read.parquet(f"{path}/terms").orderBy("term_id").toArrow().column("v")
    v = terms.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(terms), len(sigma))
    kind = spark.read.parquet(f"{path}/tokenizer").head()
    lexicon = spark.read.parquet(f"{path}/lexicon") if kind.has_lexicon else None
    return LsaModel(vocab, sigma, v, spark.read.parquet(f"{path}/documents"), kind.tokenizer, lexicon)
