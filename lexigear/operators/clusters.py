"""K-Means: fitting, assignment, scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexigear.functions.vectors import literal, matrix, squared_distance, with_nearest
from lexigear.operators import leaves as lv
from lexigear.operators.blocks import SUMMED, summands, summed
from lexigear.operators.features import FEATURES, as_matrix
from lexigear.operators.xorshift import XorShift

Centers = Sequence[Sequence[float]]

# Library defaults of ``KMeans``.
MAX_ITER, TOL = 20, 1e-4
# Distances held by one array operation inside a task.
DISTANCES_PER_STEP = 250_000


def kmeans_fit(
    df: DataFrame, k: int, seed: int | None = 42, max_iter: int = 50, column: str = FEATURES
) -> KMeansModel:
    """``seed=None`` leaves the seed to the library, as a plain ``KMeans(k)`` does."""
    options = {"k": k, "maxIter": max_iter, "featuresCol": "_vector"}
    if seed is not None:
        options["seed"] = seed
    return KMeans(**options).fit(_vectors(df, column))


def _vectors(df: DataFrame, column: str) -> DataFrame:
    """The features as vectors, which they may be already.  Unpersisted on purpose: K-Means
    then keeps the vectors with their norms itself, for as long as it iterates."""
    return df.select(_vector(df, column).alias("_vector"))


def with_vectors(df: DataFrame, column: str = FEATURES) -> DataFrame:
    """The features alone, as vectors of Spark ML."""
    return df.select(_vector(df, column).alias(column))


def _vector(df: DataFrame, column: str) -> Column:
    return F.col(column) if isinstance(df.schema[column].dataType, VectorUDT) else array_to_vector(F.col(column))


def kmeans_default(df: DataFrame, k: int, column: str = FEATURES) -> KMeansModel:
    """Library defaults for everything but ``k``."""
    return KMeans(k=k, featuresCol="_vector").fit(_vectors(df, column))


def kmeans_start(df: DataFrame, k: int, seed: int | None = None, column: str = FEATURES) -> np.ndarray:
    """The centers that a fit begins with, which the library's parallel k-means++ finds.

    It reads the points several times, so persist ``df`` with vectors: arrays would be
    turned into vectors in each pass, which takes longer than the pass itself.
    ``library_starts`` finds those of several ks in shared scans.
    """
    return np.asarray(kmeans_fit(df, k, seed, 0, column).clusterCenters(), dtype=float)


def pack(df: DataFrame, column: str = FEATURES, label: str | None = None) -> DataFrame:
    """The points as the scans of a sweep read them; persist it."""
    return lv.pack(df, column, label)


def _steps(column: pa.ListArray, width: int, centers: int) -> Iterator[np.ndarray]:
    """The points of a batch, as many at a time as the step allows."""
    points = lv.checked(column, width)
    size = max(1, DISTANCES_PER_STEP // centers)
    for first in range(0, len(points), size):
        yield points[first : first + size]


def _factors(centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a point is multiplied by and what is added, to rank the centers by distance."""
    return np.ascontiguousarray(-2.0 * centers.T), (centers * centers).sum(axis=1)


def _nearest(points: np.ndarray, factors: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    ranks = points @ factors[0]
    ranks += factors[1]
    return ranks.argmin(axis=1)


def _ends(centers: Sequence[np.ndarray]) -> np.ndarray:
    return np.cumsum([0, *map(len, centers)])


def _costs(points: np.ndarray, factors: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Squared distance to the nearest center; zero where it is no more than rounding."""
    ranks = points @ factors[0]
    ranks += factors[1]
    squares = (points * points).sum(axis=1)
    costs = squares + ranks.min(axis=1)
    return np.where(costs > 1e-12 * squares, costs, 0.0)


def kmeans_starts(packed: DataFrame, ks: Sequence[int], seed: int = 0, steps: int = 2) -> dict[int, np.ndarray]:
    """Starting centers of every k by parallel k-means++, each scan shared by all ks.

    As in the library, a random point is followed by ``steps`` rounds, in each of which a
    point becomes a candidate with a probability of ``2 k`` times its part of all squared
    distances to the candidates so far; the candidates, weighted by the points nearest to
    them, are reduced to ``k`` by k-means++ and up to 30 steps.  Fewer than ``k`` come back
    if there are no more different candidates.  Some ``5 k`` candidates reach the driver.
    Draws follow the order of the rows, not that of the leaves.
    """

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw, best = None, None
        for row, leaves in lv.unpacked(batches):
            draw = draw or np.random.default_rng((seed, 0, row.column("part")[0].as_py()))
            draws = draw.random(len(leaves.points))[lv.places(row)]
            at = int(draws.argmin())
            if best is None or draws[at] < best[0]:
                best = (draws[at], leaves.points[at].tolist())
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array([best[0]]), pa.array([best[1]], pa.list_(pa.float64()))], names=["draw", "point"])

    first = packed.select("part", "places", *lv.SCANNED).mapInArrow(one, "draw double, point array<double>").orderBy("draw").head()
    if first is None:
        raise ValueError("K-Means needs points, and features of finite numbers")
    found = {k: np.array([first.point]) for k in ks}

    for step in range(1, steps + 1):
        sums = _cost_sums(packed, list(found.values()))
        odds = [2.0 * k / s if s > 0 else 0.0 for k, s in zip(found, sums)]
        size = max(1, DISTANCES_PER_STEP // max(map(len, found.values())))

        def draws(row: pa.RecordBatch, held: dict) -> np.ndarray:
            if "draw" not in held:
                held["draw"] = np.random.default_rng((seed, step, row.column("part")[0].as_py()))
            parts = [min(size, n - at) for n in row.column("sizes")[0].as_py() for at in range(0, n, size)]
            return np.hstack([held["draw"].random((len(odds), n)) for n in parts])

        more = _chosen(packed, list(found.values()), draws, odds)
        for (k, centers), new in zip(found.items(), more):
            found[k] = np.unique(np.vstack([centers, new]), axis=0)

    weights, ends = _shares(packed, list(found.values()))[:, -1], _ends(list(found.values()))
    return {k: _reduced(c, weights[a:b], k, seed) for (k, c), a, b in zip(found.items(), ends, ends[1:])}


def _each_cost(leaves: lv.Leaves, centers: Sequence[np.ndarray]) -> Iterator[np.ndarray]:
    """The costs for each set of centers; those of the same set are found once."""
    known, costs = None, None
    for own in centers:
        if known is None or known.shape != own.shape or (known != own).any():
            known, costs = own, leaves.costs(own)
        yield costs


def _cost_sums(packed: DataFrame, centers: Sequence[np.ndarray]) -> np.ndarray:
    """The sum of all squared distances to the nearest center, of several sets."""
    shipped = packed.sparkSession.sparkContext.broadcast(list(centers))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(shipped.value), 1))
        for _, leaves in lv.unpacked(batches):
            sums[:, 0] += [costs.sum() for costs in _each_cost(leaves, shipped.value)]
        yield summands(sums)

    sums = summed(packed.select(*lv.SCANNED).mapInArrow(total, SUMMED), len(centers), 1)[:, 0]
    shipped.destroy()
    return sums


def _chosen(packed: DataFrame, centers: Sequence[np.ndarray], draws: Callable, odds: Sequence[float]) -> list[np.ndarray]:
    """For each set of centers the points, in order, whose draw is below odds times cost.

    ``draws(row, held)`` gives the draws of a chunk, for each set or for all, in the order of
    its rows; ``held`` is kept from one chunk of a partition to the next.
    """
    shipped = packed.sparkSession.sparkContext.broadcast(list(centers))
    width = centers[0].shape[1]

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for row, leaves in lv.unpacked(batches):
            places, drawn = lv.places(row), draws(row, held)
            for i, (costs, odd) in enumerate(zip(_each_cost(leaves, shipped.value), odds)):
                own = np.flatnonzero(drawn[min(i, len(drawn) - 1)][places] < odd * costs)
                own = own[places[own].argsort()]
                part, chunk = (pa.array(np.full(len(own), row.column(name)[0].as_py(), np.int32)) for name in ("part", "chunk"))
                points = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * width), pa.array(leaves.points[own].ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), i, np.int32)), part, chunk, pa.array(places[own]), points], names=["i", "part", "chunk", "at", "point"])

    found = packed.select("part", "chunk", "places", *lv.SCANNED).mapInArrow(chosen, "i int, part int, chunk int, at int, point array<double>")
    rows = sorted(found.collect(), key=lambda r: r[:4])
    shipped.destroy()
    return [np.array([r.point for r in rows if r.i == i], dtype=float).reshape(-1, width) for i in range(len(centers))]


def library_starts(packed: DataFrame, ks: Sequence[int], seed: int, steps: int = 2) -> dict[int, np.ndarray]:
    """``kmeans_start`` of every k with the same seed, each scan shared by all ks.

    The same first point, the same draws for the same rows, and the library's own reduction
    of the candidates.  One generator for each partition serves all ks, as the library seeds
    it by step and partition alone.
    """
    spark = packed.sparkSession
    number = XorShift(seed).int32()
    size = F.aggregate("sizes", F.lit(0), lambda a, n: a + n)
    places = packed.select("part", "chunk", F.explode(F.sequence(F.lit(0), size - 1)).alias("at"))
    sample = list(places._jdf.javaRDD().takeSample(False, 1, number))
    if not sample:
        raise ValueError("K-Means needs points, and features of finite numbers")
    part, chunk, at = (sample[0].getInt(i) for i in range(3))
    row, leaves = next(lv.unpacked(packed.where((F.col("part") == part) & (F.col("chunk") == chunk)).toArrow().to_batches()))
    first = leaves.points[lv.places(row) == at]
    found = {k: first for k in ks}

    for step in range(steps):
        sums = _cost_sums(packed, list(found.values()))
        odds = [2.0 * k / s if s > 0 else 0.0 for k, s in zip(found, sums)]

        def draws(row: pa.RecordBatch, held: dict) -> list[np.ndarray]:
            if "draw" not in held:
                held["draw"] = XorShift(number ^ (step << 16) ^ row.column("part")[0].as_py())
            return [held["draw"].random(sum(row.column("sizes")[0].as_py()))]

        more = _chosen(packed, list(found.values()), draws, odds)
        found = {k: np.vstack([c, new]) for (k, c), new in zip(found.items(), more)}

    for k, c in found.items():
        found[k] = c[np.sort(np.unique(c, axis=0, return_index=True)[1])]
    weights, ends = _shares(packed, list(found.values()))[:, -1], _ends(list(found.values()))
    return {k: c if len(c) <= k else _library_reduced(spark, c, weights[a:b], k) for (k, c), a, b in zip(found.items(), ends, ends[1:])}


def _library_reduced(spark: SparkSession, candidates: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """``k`` centers of weighted candidates, by the library's local k-means++."""
    context = spark.sparkContext
    mllib = context._jvm.org.apache.spark.mllib
    points = context._gateway.new_array(mllib.clustering.VectorWithNorm, len(candidates))
    counts = context._gateway.new_array(context._jvm.double, len(candidates))
    for i, (c, n) in enumerate(zip(candidates.tolist(), weights.tolist())):
        points[i] = mllib.clustering.VectorWithNorm(mllib.linalg.Vectors.parse(str(c)))
        counts[i] = n
    found = mllib.clustering.LocalKMeans.kMeansPlusPlus(0, points, counts, k, 30)
    return np.array([list(c.vector().toArray()) for c in found], dtype=float)


def _reduced(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` centers of weighted candidates, which are few."""
    if len(candidates) <= k:
        return candidates
    draw = np.random.default_rng((seed, k))
    weights = np.maximum(weights, 1e-300)
    centers = candidates[[draw.choice(len(candidates), p=weights / weights.sum())]]
    while len(centers) < k:
        costs = weights * _costs(candidates, _factors(centers))
        if not costs.sum() > 0:
            break
        centers = np.vstack([centers, candidates[draw.choice(len(candidates), p=costs / costs.sum())]])
    for _ in range(30):
        own = _nearest(candidates, _factors(centers))
        moved = np.array([np.average(candidates[own == c], axis=0, weights=weights[own == c]) if (own == c).any() else centers[c] for c in range(len(centers))])
        if (moved == centers).all():
            break
        centers = moved
    return centers


def _shares(packed: DataFrame, centers: Sequence[np.ndarray]) -> np.ndarray:
    """Sums and counts of the points nearest to each center of several sets, from one scan."""
    width, ends = centers[0].shape[1], _ends(centers)
    shipped = packed.sparkSession.sparkContext.broadcast(list(centers))

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((ends[-1], width + 1))
        for _, leaves in lv.unpacked(batches):
            for own, first, last in zip(shipped.value, ends, ends[1:]):
                total[first:last] += leaves.shares(own)
        yield summands(total)

    out = summed(packed.select(*lv.SCANNED).mapInArrow(share, SUMMED), int(ends[-1]), width + 1)
    shipped.destroy()
    return out


def kmeans_step(packed: DataFrame, centers: Mapping[int, np.ndarray]) -> tuple[dict, set]:
    """One assign-and-average step of every k, in one scan of the points; and the ks whose
    centers have all moved by ``TOL`` at most, which are settled.

    The step and the end are those of the library's ``KMeans``: a center without points
    stays where it is, and a null or a number that is not finite is an error.  A task
    sends one sum per center.
    """
    found, settled, first = {}, set(), 0
    shares = _shares(packed, list(centers.values()))
    for k, old in centers.items():
        own = shares[first : first + len(old)]
        first += len(old)
        new, there = old.copy(), own[:, -1] > 0
        new[there] = own[there, :-1] / own[there, -1:]
        found[k] = new
        if (((new - old) ** 2).sum(axis=1) <= TOL * TOL).all():
            settled.add(k)
    return found, settled


# Below all buckets of distances: that of points which are their center.
NO_DISTANCE = -(1 << 20)


def _buckets(distances: np.ndarray) -> np.ndarray:
    """Sixteen buckets for each doubling of a distance."""
    out, there = np.full(len(distances), NO_DISTANCE, np.int64), distances > 0
    out[there] = np.floor(np.log2(distances[there]) * 16)
    return out


def distance_sums(packed: DataFrame, models: Mapping[int, np.ndarray]) -> DataFrame:
    """``k, bucket, n, total``: number and sum of the distances of each size, from one scan."""
    shipped = packed.sparkSession.sparkContext.broadcast({k: np.asarray(c, dtype=float) for k, c in models.items()})

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for _, leaves in lv.unpacked(batches):
            for k, centers in shipped.value.items():
                own = leaves.clusters(centers)
                for first in range(0, len(own), DISTANCES_PER_STEP):
                    part = slice(first, first + DISTANCES_PER_STEP)
                    far = np.sqrt(((leaves.points[part] - centers[own[part]]) ** 2).sum(axis=1))
                    buckets, at = np.unique(_buckets(far), return_inverse=True)
                    for bucket, n, total in zip(buckets.tolist(), np.bincount(at).tolist(), np.bincount(at, far).tolist()):
                        n_before, before = found.get((k, bucket), (0, 0.0))
                        found[k, bucket] = (n_before + n, before + total)
        rows = [(*key, *value) for key, value in found.items()]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["k", "bucket", "n", "total"])

    parts = packed.select(*lv.SCANNED).mapInArrow(sums, "k int, bucket int, n long, total double")
    return parts.groupBy("k", "bucket").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def far_of_all(df: DataFrame, models: Mapping[int, np.ndarray], near: Mapping[int, int], column: str = FEATURES) -> Column:
    """An array of ``k, prediction, distance`` of the models for which a row is far: in the
    bucket ``near`` has for the k, or above."""
    known = []
    for k, found in models.items():
        centers = np.asarray(found, dtype=float)
        # Somewhat less, as rounding must not drop a row of the bucket.
        known.append((k, centers, _factors(centers), 0.0 if near[k] == NO_DISTANCE else 2.0 ** (near[k] / 16) * (1 - 1e-9)))
    shipped = df.sparkSession.sparkContext.broadcast(known)
    width, most = known[0][1].shape[1], max(len(c) for _, c, *_ in known)

    @F.arrow_udf("array<struct<k:int,prediction:int,distance:double>>")
    def far(features: pa.Array) -> pa.Array:
        rows, entries, first = [], [], 0
        for points in _steps(features, width, most):
            for k, centers, factors, least in shipped.value:
                own = _nearest(points, factors)
                distance = np.sqrt(((points - centers[own]) ** 2).sum(axis=1))
                at = np.flatnonzero(distance >= least)
                rows.append(at + first)
                entries.append((np.full(len(at), k), own[at], distance[at]))
            first += len(points)
        rows = np.concatenate(rows) if rows else np.empty(0, np.int64)
        by = rows.argsort(kind="stable")
        k, own, distance = (np.concatenate(x)[by] for x in zip(*entries)) if entries else np.empty((3, 0))
        parts = [pa.array(k.astype(np.int32)), pa.array(own.astype(np.int32)), pa.array(distance)]
        ends = np.searchsorted(rows[by], np.arange(len(features) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(parts, names=["k", "prediction", "distance"]))

    # Else the test for empty arrays, pushed down, computes them twice.
    return far.asNondeterministic()(F.col(column).cast("array<double>"))


def clusters_by_label(packed: DataFrame, models: Mapping[int, np.ndarray], label: str = "label") -> DataFrame:
    """``k, prediction``, the label and ``n``, the number of points, of every model from one
    scan of points packed with labels."""
    shipped = packed.sparkSession.sparkContext.broadcast({k: np.asarray(c, dtype=float) for k, c in models.items()})
    kind = packed.schema["labels"].dataType.elementType

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, leaves in lv.unpacked(batches):
            labels = row.column("labels").flatten()
            codes = np.frombuffer(row.column("codes")[0].as_buffer(), np.int32)
            for k, centers in shipped.value.items():
                pairs, n = np.unique(leaves.clusters(centers) * len(labels) + codes, return_counts=True)
                own, at = np.divmod(pairs, len(labels))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), k, np.int32)), pa.array(own.astype(np.int32)), labels.take(pa.array(at)), pa.array(n)], names=["k", "prediction", "label", "n"])

    found = packed.select("labels", "codes", *lv.SCANNED).mapInArrow(counts, f"k int, prediction int, label {kind.simpleString()}, n long")
    return found.groupBy("k", "prediction", F.col("label").alias(label)).agg(F.sum("n").alias("n"))


def nearest_of_all(df: DataFrame, models: Sequence, column: str = FEATURES) -> Column:
    """``prediction`` and ``distance``, arrays with the nearest center of each model, for one
    scan; null without features."""
    centers = [np.asarray(model_centers(m)) for m in models]
    shipped = df.sparkSession.sparkContext.broadcast([(c, _factors(c)) for c in centers])
    width, most = centers[0].shape[1], max(map(len, centers))

    def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.FixedSizeListArray.from_arrays(pa.array(values.ravel(), kind), len(centers)).cast(pa.list_(kind))

    @F.arrow_udf("prediction array<int>, distance array<double>")
    def nearest(features: pa.Array) -> pa.Array:
        there = features.is_valid()
        known = features.filter(there) if features.null_count else features
        own, far = np.empty((len(known), len(centers)), np.int32), np.empty((len(known), len(centers)))
        first = 0
        for points in _steps(known, width, most):
            part = slice(first, first + len(points))
            for i, (center, factors) in enumerate(shipped.value):
                own[part, i] = at = _nearest(points, factors)
                far[part, i] = np.sqrt(((points - center[at]) ** 2).sum(axis=1))
            first = part.stop
        rows = pa.StructArray.from_arrays([lists(own, pa.int32()), lists(far, pa.float64())], names=["prediction", "distance"])
        if not features.null_count:
            return rows
        at = np.cumsum(there.to_numpy(zero_copy_only=False)) - 1
        return rows.take(pa.array(at, mask=~there.to_numpy(zero_copy_only=False)))

    return nearest(F.col(column).cast("array<double>"))


def model_centers(model: KMeansModel | Centers) -> Centers:
    return as_matrix(model.clusterCenters() if isinstance(model, KMeansModel) else model)


def centers_frame(spark: SparkSession, centers: Centers) -> DataFrame:
    """``cluster, center``."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centers)]
    return spark.createDataFrame(rows, "cluster int, center array<double>")


def assign(df: DataFrame, centers: Centers, column: str = FEATURES) -> DataFrame:
    """Add ``prediction`` and ``distance``; no Python, no join, no shuffle."""
    return with_nearest(df, column, centers)


def score(df: DataFrame, model: KMeansModel, column: str = FEATURES) -> DataFrame:
    """Add ``prediction`` and ``distance`` of a fitted model.

    The model finds the cluster; only the distance to that one center is computed here.
    Rows may be vectors, sparse ones among them, of any width.
    """
    found = model.transform(df.withColumn("_vector", _vector(df, column)))
    if isinstance(df.schema[column].dataType, VectorUDT):
        return found.withColumn("distance", _vector_distance(df.sparkSession, model)(F.unwrap_udt("_vector"), "prediction")).drop("_vector")
    return found.drop("_vector").withColumn("distance", distance_to_own(model, F.col(column), F.col("prediction")))


def distance_to_own(model: KMeansModel | Centers, features: Column, prediction: Column) -> Column:
    centers = model_centers(model)
    return F.sqrt(squared_distance(features, F.get(matrix(centers), prediction), len(centers[0])))


def _vector_distance(spark: SparkSession, model: KMeansModel):
    """A function of a vector's parts and its cluster: the distance to that center.

    Only the entries of a sparse row are visited: what it lacks adds the center's squares.
    """
    centers = np.asarray(model.clusterCenters(), dtype=float)
    shipped = spark.sparkContext.broadcast((centers, (centers * centers).sum(axis=1)))

    @F.pandas_udf("double")
    def distance(vectors: pd.DataFrame, clusters: pd.Series) -> pd.Series:
        centers, squares = shipped.value
        there = np.flatnonzero((vectors["values"].notna() & clusters.notna()).to_numpy())
        out = np.full(len(vectors), None, dtype=object)
        if len(there):
            values = [np.asarray(v, dtype=float) for v in vectors["values"].iloc[there]]
            ids = [np.arange(len(v)) if i is None else i for i, v in zip(vectors["indices"].iloc[there], values)]
            sizes = np.array([len(v) for v in values])
            own = clusters.iloc[there].to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(there)), sizes)
            x, c = np.concatenate(values), centers[own[row], np.concatenate(ids).astype(np.int64)]
            near = np.bincount(row, (x - c) ** 2, len(there))
            rest = squares[own] - np.bincount(row, c * c, len(there))
            out[there] = np.sqrt(near + np.maximum(rest, 0.0))
        return pd.Series(out, dtype="object")

    return distance


def kmeans_lloyd(df: DataFrame, centers: Centers, iterations: int, column: str = FEATURES) -> Centers:
    """Assign-and-average steps from given centers.

    Each step is one aggregation of whole vectors, combined before its shuffle; one mean
    per center reaches the driver.  A center without points stays where it is.  Points
    without features, or with a null among them, count nowhere.  Persist ``df``.
    """
    centers = as_matrix(centers)
    for _ in range(iterations):
        own = F.when(F.col("prediction").isNotNull(), F.col(column)).otherwise(literal([0.0] * len(centers[0])))
        points = assign(df, centers, column).select("prediction", array_to_vector(own).alias("_vector"))
        means = points.groupBy("prediction").agg(Summarizer.mean(F.col("_vector")).alias("mean"))
        for r in means.where("prediction IS NOT NULL").collect():
            centers[r.prediction] = r["mean"].toArray().tolist()
    return centers


def first_centers(df: DataFrame, k: int, key: str, column: str = FEATURES) -> Centers:
    """The features of the ``k`` lowest ids."""
    return [list(r[0]) for r in df.orderBy(key).limit(k).select(column).collect()]


def avg_distance(scored: DataFrame) -> DataFrame:
    """Mean distance to the own center, the score of a clustering."""
    return scored.agg(F.avg("distance").alias("avg_distance"))


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label)


def cluster_label_counts(scored: DataFrame, label: str = "label") -> DataFrame:
    return scored.groupBy("prediction", label).agg(F.count("*").alias("n")).orderBy("prediction", label)


def cluster_entropy(scored: DataFrame, label: str = "label") -> DataFrame:
    """Mean label entropy of the clusters, weighted by their size; natural logarithm."""
    return entropy_by(scored, [], label)


def entropy_by(scored: DataFrame, keys: list[str], label: str = "label") -> DataFrame:
    """``cluster_entropy`` of each group of ``keys``, such as several models' rows."""
    return entropy_of(scored.groupBy(*keys, "prediction", label).agg(F.count("*").alias("n")), keys)


def entropy_of(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """``entropy_by`` of numbers ``n`` by keys, ``prediction`` and label."""
    # sum(-p ln p) over one cluster is ln N - sum(n ln n) / N.
    clusters = pairs.groupBy(*keys, "prediction").agg(
        F.sum("n").alias("size"), F.sum(F.col("n") * F.log("n")).alias("n_log_n")
    )
    weighted = F.col("size") * F.log("size") - F.col("n_log_n")
    return clusters.groupBy(*keys).agg((F.sum(weighted) / F.sum("size")).alias("entropy"))


def elbow_deltas(scores: DataFrame) -> DataFrame:
    """``k, avg_distance`` plus the drop from the k before and whether it is the largest.

    One row per k, so the single window partition is a report of a few rows.
    """
    by_k = W.orderBy("k")
    drops = scores.select("k", "avg_distance", (F.lag("avg_distance").over(by_k) - F.col("avg_distance")).alias("drop"))
    largest = drops.select(F.max_by("k", "drop").alias("k")).scalar()
    return drops.withColumn("largest_drop", F.col("k") == largest)
