"""Outliers: the readings farthest from the center of their own cluster."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigear.functions.text import hash_order

REPORT = 25
THRESHOLD_RANK = 100


def top_outliers(scored: DataFrame, n: int = REPORT, key: str = "point_id") -> DataFrame:
    """The ``n`` largest distances over all clusters; equal ones in order of id.

    Nulls sort last and are dropped after the cut: a filter before it would be pushed
    below the scoring and compute every distance twice.
    """
    return scored.orderBy(F.desc("distance"), key).limit(n).where(F.col("distance").isNotNull())


def anomaly_threshold(scored: DataFrame, n: int = THRESHOLD_RANK) -> DataFrame:
    """One row: the ``n``-th largest distance, or the smallest if there are fewer rows."""
    largest = scored.select("distance").orderBy(F.desc("distance")).limit(n)
    return largest.agg(F.min("distance").alias("threshold"))


def anomalies(scored: DataFrame, threshold: float | None = None, n: int = THRESHOLD_RANK) -> DataFrame:
    """Rows farther than ``threshold``, by default the ``n``-th largest distance."""
    limit = anomaly_threshold(scored, n).scalar() if threshold is None else F.lit(threshold)
    return scored.where(F.col("distance") > limit)


def anomaly_share(scored: DataFrame, n: int = THRESHOLD_RANK) -> DataFrame:
    """One row: rows, rows above the threshold, and their percentage.

    Whatever lies above the ``n``-th largest distance is among the ``n`` largest, so no
    second pass over all rows is needed to count them.
    """
    largest = scored.select("distance").orderBy(F.desc("distance")).limit(n)
    total = scored.select(F.count("*")).scalar()
    lowest = largest.agg(
        F.min("distance").alias("threshold"), F.collect_list("distance").alias("all")
    )
    above = F.size(F.filter("all", lambda d: d > F.col("threshold"))).cast("long")
    return lowest.select("threshold", total.alias("total"), above.alias("anomalies")).withColumn(
        "percent", F.when(F.col("total") > 0, F.col("anomalies") / F.col("total") * 100.0).otherwise(0.0)
    )


def fixed_sample(df: DataFrame, n: int = 5000, seed: int = 42, key: str = "point_id") -> DataFrame:
    """Exactly ``n`` rows (all if fewer), the same ones in every run."""
    return df.orderBy(hash_order(F.col(key), seed), key).limit(n)


def project_2d(
    scored: DataFrame, sample: DataFrame, n: int = REPORT, column: str = "features", key: str = "point_id"
) -> tuple[DataFrame, list[float]]:
    """Two principal components for the sampled rows, and the variance they explain.

    The components come from all of ``scored``; ``is_outlier`` marks the ``n`` sampled
    rows of largest distance.
    """
    vector = array_to_vector(F.col(column))
    model = PCA(k=2, inputCol="_vector", outputCol="_pc").fit(scored.select(vector.alias("_vector")))
    placed = model.transform(sample.withColumn("_vector", vector)).withColumn("_xy", vector_to_array("_pc"))
    # The cut is the n-th row of the sample in (distance, id) order.
    cut = (
        sample.orderBy(F.desc("distance"), key).limit(n)
        .agg(F.max(F.struct((-F.col("distance")).alias("d"), F.col(key).alias("id"))).alias("last"))
        .scalar()
    )
    rank = F.struct((-F.col("distance")).alias("d"), F.col(key).alias("id"))
    points = placed.withColumn("x", F.col("_xy")[0]).withColumn("y", F.col("_xy")[1])
    points = points.withColumn("is_outlier", rank <= cut).drop("_vector", "_pc", "_xy")
    return points, [float(x) for x in model.explainedVariance]


def outlier_sources(outliers: DataFrame) -> DataFrame:
    """How many of each k's outliers come from which file."""
    return outliers.groupBy("k", "source_file").agg(F.count("*").alias("n"))


def outlier_overlap(outliers: DataFrame, key: str = "point_id") -> DataFrame:
    """``k, other_k, shared``: outliers two ks have in common.

    The input is the report of ``n`` rows per k, and a point is listed once per k.
    """
    other = outliers.select(key, F.col("k").alias("other_k"))
    pairs = outliers.select(key, "k").join(other, key).where("k < other_k")
    return pairs.groupBy("k", "other_k").agg(F.count("*").alias("shared"))


def cluster_spread(scored: DataFrame) -> DataFrame:
    """``prediction, spread``: root mean square distance of each cluster."""
    return scored.groupBy("prediction").agg(
        F.sqrt(F.avg(F.col("distance") * F.col("distance"))).alias("spread")
    )


def relative_distance(scored: DataFrame) -> DataFrame:
    """Add ``relative``, the distance divided by the spread of the own cluster.

    The spreads are one row per cluster and are broadcast; a window per cluster would
    send every reading through as many tasks as there are clusters.
    """
    spread = F.broadcast(cluster_spread(scored))
    ratio = F.when(F.col("spread") > 0, F.col("distance") / F.col("spread"))
    return scored.join(spread, "prediction", "left").withColumn("relative", ratio)
