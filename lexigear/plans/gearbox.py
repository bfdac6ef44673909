"""The K-Means sweep over k with its per-k report."""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexigear.operators import clusters as cl
from lexigear.operators import outliers as ol
from lexigear.operators.features import FEATURES, assemble, standardize

# Scans read what is kept from the first row to the last; in memory it would fill the heap of
# any executor, and be read from disk beyond that anyway.
KEPT = StorageLevel.DISK_ONLY

SUMMARY_SCHEMA = (
    "k int, avg_distance double, threshold double, total long, anomalies long, "
    "percent double, runtime_seconds double"
)


@dataclass(frozen=True)
class Sweep:
    """``summary`` has one row per k, ``outliers`` the top rows of every k."""

    summary: DataFrame
    outliers: DataFrame
    centers: dict


def prepare(readings: DataFrame, sensors: list[str]) -> DataFrame:
    """Readings with standardized ``features``; the scaling is fitted once."""
    return standardize(assemble(readings, sensors))


def with_predictions(data: DataFrame, models: dict) -> DataFrame:
    """Each model's cluster, and the distance to its center, in columns of their own."""
    found = data.withColumn("_near", cl.nearest_of_all(data, list(models.values())))
    each = {f"_{name[0]}{k}": F.get(F.col(f"_near.{name}"), F.lit(i)) for i, k in enumerate(models) for name in ("prediction", "distance")}
    return found.withColumns(each).drop("_near")


def fit_all(
    data: DataFrame, ks: Iterable[int], seed: int | None = None, max_iter: int = cl.MAX_ITER, packed: DataFrame | None = None,
) -> tuple[dict, dict]:
    """The centers of all ks, and the seconds each fit took.

    With a ``seed`` every k begins as the library's ``KMeans`` with that seed, and takes the
    same steps to the same end.  The scans for the starts are shared, with a seed or without,
    and the steps of all ks that are not settled share a scan.  Its seconds count for each k
    by its number of centers.  Scans read ``packed`` points (``clusters.pack``), which are
    made of ``data`` unless they are given.
    """
    ks, models, seconds = list(ks), {}, {}
    if not ks:
        return models, seconds
    points = cl.pack(data).persist(KEPT) if packed is None else packed
    start = time.perf_counter()
    models = cl.kmeans_starts(points, ks) if seed is None else cl.library_starts(points, ks, seed)
    spent = (time.perf_counter() - start) / sum(ks)
    seconds = {k: k * spent for k in ks}
    open_ = dict(models)
    for _ in range(max_iter):
        if not open_:
            break
        start = time.perf_counter()
        moved, settled = cl.kmeans_step(points, open_)
        spent = (time.perf_counter() - start) / sum(open_)
        for k in open_:
            seconds[k] += k * spent
        models |= moved
        open_ = {k: c for k, c in moved.items() if k not in settled}
    if packed is None:
        points.unpersist()
    return models, seconds


def sweep_k(
    data: DataFrame, ks: Iterable[int] = range(2, 13), seed: int = 42, max_iter: int = 50,
    top_n: int = ol.REPORT, threshold_rank: int = ol.THRESHOLD_RANK,
    keep: list[str] | None = None, key: str = "point_id",
) -> Sweep:
    """Fit every k over one persisted frame, and score all of them in two scans.

    The first scan, of packed points, sums the distances of each k by size.  From the counts follows how far
    the largest distances reach down; the second scan keeps the rows above that alone, and
    ranks them.  They yield the report, the threshold and the number of rows above it.
    ``runtime_seconds`` is a fit, with its share of the scans of all fits, and its even share
    of the scoring.
    """
    spark = data.sparkSession
    kept = keep if keep is not None else [c for c in data.columns if c not in (FEATURES, key)]
    data = data.select(key, *kept, FEATURES).persist(KEPT)
    packed = cl.pack(data).persist(KEPT)
    models, seconds = fit_all(data, ks, seed, max_iter, packed)
    if not models:
        data.unpersist()
        raise ValueError("a sweep needs at least one k")
    start = time.perf_counter()
    largest_n = max(top_n, threshold_rank)
    sums = cl.distance_sums(packed, models).collect()
    packed.unpersist()
    near = {}
    for k in models:
        above = 0
        for bucket, n in sorted(((r.bucket, r.n) for r in sums if r.k == k), reverse=True):
            near[k], above = bucket, above + n
            if above >= largest_n:
                break
    far = data.withColumn("_far", cl.far_of_all(data, models, near)).select(key, *kept, F.inline("_far"))
    order = W.partitionBy("k").orderBy(F.desc("distance"), key)
    report = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= largest_n)
    ranked: dict[int, list] = {k: [] for k in models}
    columns = ["k", key, "prediction", "distance", *kept]
    for r in report.orderBy("k", "rank").select(*columns).collect():
        ranked[r.k].append(r)
    share = (time.perf_counter() - start) / len(models)
    summary, tops = [], []
    for k, rows in ranked.items():
        counted = [r for r in sums if r.k == k]
        total = sum(r.n for r in counted)
        mean = sum(r.total for r in counted) / total
        threshold = rows[:threshold_rank][-1].distance if rows else None
        above = sum(r.distance > threshold for r in rows[:threshold_rank])
        percent = 100.0 * above / total if total else 0.0
        tops.extend(rows[:top_n])
        summary.append((k, mean, threshold, total, above, percent, seconds[k] + share))
    data.unpersist()
    schema = report.select(*columns).schema
    return Sweep(
        spark.createDataFrame(summary, SUMMARY_SCHEMA), spark.createDataFrame(tops, schema),
        {k: cl.model_centers(m) for k, m in models.items()},
    )


def sweep_entropy(data: DataFrame, ks: Iterable[int], label: str = "label") -> DataFrame:
    """``k, entropy`` of fits with library defaults, scored in one scan."""
    packed = cl.pack(data, label=label).persist(KEPT)
    models, _ = fit_all(data, ks, packed=packed)
    rows = cl.entropy_of(cl.clusters_by_label(packed, models, label), ["k"]).collect()
    packed.unpersist()
    return data.sparkSession.createDataFrame(rows, "k int, entropy double")


def sweep_scores(data: DataFrame, ks: Iterable[int]) -> DataFrame:
    """``k, avg_distance`` of fits with library defaults, scored in one scan."""
    packed = cl.pack(data).persist(KEPT)
    models, _ = fit_all(data, ks, packed=packed)
    sums = cl.distance_sums(packed, models)
    rows = sums.groupBy("k").agg((F.sum("total") / F.sum("n")).alias("avg_distance")).collect()
    packed.unpersist()
    return data.sparkSession.createDataFrame(rows, "k int, avg_distance double")
