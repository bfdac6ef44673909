"""Centroid clustering of integer vectors by bit planes and popcounts.

A vector of 64 integers is stored as its bit planes in two's complement: plane p is one
unsigned 64-bit word that holds bit p of all components.  With the planes A of a vector and
C of a centroid, ``a.c`` is the sum over all p and q of ``w(p) w(q) popcount(A[p] & C[q])``,
where w(p) is 2**p, and negative for the last plane, that of the sign.  So dot products and
squared distances are exact integers.

Vectors are packed once and written out.  A round is one pass over the packed table: every
task gives the count and component sums of its vectors for each centroid, Spark adds them
up, and the driver holds the centroids, k x 64 integers, and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigear.llm.common import few, materialize

COMPONENTS = 64
K = 40
ROUNDS = 5
SCALE = 256
MOST_PLANES = 28  # 64 squared differences of 28-bit integers fit into 63 bits
ROWS_AT_ONCE = 2_048


# ---------------------------------------------------------------- planes


def planes_of(values: np.ndarray, planes: int) -> np.ndarray:
    """(n, planes) words of the bit planes of (n, 64) integers; bit j is component j."""
    shifts = np.arange(planes, dtype=np.int64)[None, :, None]
    bits = ((values[:, None, :] >> shifts) & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little").view("<u8")[..., 0].astype(np.uint64)


def values_of(words: np.ndarray) -> np.ndarray:
    """The (n, 64) integers of (n, planes) words."""
    octets = np.ascontiguousarray(words.astype("<u8")).view(np.uint8).reshape(*words.shape, 8)
    bits = np.unpackbits(octets, axis=2, bitorder="little")
    out = np.zeros((len(words), COMPONENTS), dtype=np.int64)
    for p, w in enumerate(weights(words.shape[1])):
        out += w * bits[:, p].astype(np.int64)
    return out


def weights(planes: int) -> list[int]:
    """2**p for plane p, negative for the sign."""
    return [*(1 << p for p in range(planes - 1)), -(1 << planes - 1)]


def dots(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """(n, k) dot products of the vectors and centroids with these planes."""
    out = np.zeros((len(a), len(c)), dtype=np.int64)
    for p, wp in enumerate(weights(a.shape[1])):
        part = np.zeros_like(out)
        for q, wq in enumerate(weights(c.shape[1])):
            part += np.int64(wq) * np.bitwise_count(a[:, p, None] & c[None, :, q])
        out += np.int64(wp) * part
    return out


def nearest(a: np.ndarray, squares: np.ndarray, c: np.ndarray, c_squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest centroid; of equally near ones the first."""
    distance = squares[:, None] + c_squares[None, :] - 2 * dots(a, c)
    at = distance.argmin(axis=1)
    return at, distance[np.arange(len(at)), at]


# ---------------------------------------------------------------- packing


def _kept(column: Column) -> Column:
    """64 components, none of them null, NaN or infinite."""
    x = column.cast("array<double>")
    return (F.size(x) == COMPONENTS) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def packed(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, planes, square) of the usable vectors, written to the shared folder."""
    x = F.col(f"`{vector_col}`")
    kept = vectors.where(F.coalesce(_kept(x), F.lit(False))).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.cast("array<double>").alias("x"))
    low, high = kept.agg(F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
    planes = 1 if low is None else max(_bits(low * scale), _bits(high * scale))
    if planes > MOST_PLANES:
        raise ValueError(f"components from {low} to {high} need {planes} bit planes; squared distances are exact up to {MOST_PLANES}")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches, ROWS_AT_ONCE):
            x = batch.column(1).flatten().to_numpy().reshape(-1, COMPONENTS)
            values = np.floor(scale * x).astype(np.int64)
            words = planes_of(values, planes).view(np.int64)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(words.ravel()), planes).cast(pa.list_(pa.int64()))
            square = (values * values).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(square)], names=["vec_id", "planes", "square"])

    return materialize(kept.mapInArrow(pack, "vec_id long, planes array<long>, square long"), "planes")


def _bits(x: float) -> int:
    """Bits of floor(x) in two's complement."""
    n = int(np.floor(x))
    return (n if n >= 0 else ~n).bit_length() + 1


def _words(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("planes").flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1)


def first_centroids(table: DataFrame, k: int) -> np.ndarray:
    """The vectors whose ids hash lowest: (k or fewer, 64).

    Rows without an id are none of them; rows that repeat one are taken by their planes.
    """
    key = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = table.where("vec_id IS NOT NULL").select(key.alias("key"), "planes").orderBy("key", "planes").limit(k).collect()
    if not rows:
        return np.empty((0, COMPONENTS), dtype=np.int64)
    return values_of(np.array([r.planes for r in rows], dtype=np.int64).view(np.uint64))


# ---------------------------------------------------------------- rounds


def sums(table: DataFrame, centroids: np.ndarray) -> list[tuple[int, int, list[int]]]:
    """(centroid, count, component sums) of the vectors nearest to each centroid."""
    near = _searcher(centroids)
    k = len(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, COMPONENTS), dtype=np.int64)
        for batch in few(batches, ROWS_AT_ONCE):
            at, _ = near(batch)
            order = np.argsort(at, kind="stable")
            found, starts = np.unique(at[order], return_index=True)
            total[found] += np.add.reduceat(values_of(_words(batch))[order], starts, axis=0)
            count += np.bincount(at, minlength=k)
        there = np.flatnonzero(count)
        lists = pa.array(total[there].tolist(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(count[there]), lists], names=["cluster", "n", "total"])

    shares = table.select("planes", "square").mapInArrow(add, "cluster int, n long, total array<long>")
    added = shares.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[j]).alias(f"c{j}") for j in range(COMPONENTS)])
    return [(r[0], r[1], list(r[2:])) for r in added.collect()]


def _searcher(centroids: np.ndarray):
    """A function from a batch to its nearest centroids and distances."""

    def near(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        a = _words(batch)
        c = planes_of(centroids, a.shape[1])
        return nearest(a, batch.column("square").to_numpy(), c, (centroids * centroids).sum(axis=1))

    return near


def fit(table: DataFrame, k: int = K, rounds: int = ROUNDS) -> np.ndarray:
    """The centroids after ``rounds`` rounds; one that has lost all vectors stays where it is."""
    now = first_centroids(table, k)
    for _ in range(rounds if len(now) else 0):
        moved = now.copy()
        for at, n, total in sums(table, now):
            moved[at] = [t // n for t in total]
        now = moved
    return now


def assign(table: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance): the nearest centroid, the first of equally near ones."""
    near = _searcher(centroids)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches, ROWS_AT_ONCE):
            at, distance = near(batch)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(at.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return table.mapInArrow(find, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256).

    One row per usable vector: 64 components, none null or non-finite; all others are left
    out.  Components become ``floor(scale * x)``.  Fewer than ``k`` usable vectors with an
    id give as many centroids; none at all, an empty result.  A row without an id is
    clustered but starts no centroid; rows that repeat an id each count.  Components that
    need more than 28 bits raise ValueError, as squared distances would leave long.
    """
    spark = vectors.sparkSession
    table = packed(vectors, id_col, vector_col, scale)
    centroids = fit(table, k, rounds)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], schema)
    found = materialize(assign(table, centroids), "assigned")
    parts = {r.cluster: r.part for r in found.groupBy("cluster").agg(F.sum("distance").alias("part")).collect()}
    whole = sum(parts.values())
    facts = []
    for at, part in sorted(parts.items()):
        centre = centroids[at].tolist()
        facts.append((at, part, whole, centre, hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest()))
    known = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string")
    names = [c.split()[0] for c in schema.split(", ")]
    return found.join(F.broadcast(known), "cluster").select(*names)  # at most k rows
