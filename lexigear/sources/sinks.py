"""Outputs.  Spark writes them all; no result rows pass through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_outliers(outliers: DataFrame, path: str) -> None:
    """Outliers of every k, one folder of header CSV per k."""
    outliers.write.mode("overwrite").partitionBy("k").option("header", True).csv(path)


def write_report(rows: DataFrame, path: str) -> None:
    """A small per-k report (runtimes, scores) as header CSV."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_runtimes(summary: DataFrame, path: str) -> None:
    write_report(summary.select("k", "runtime_seconds"), path)


def write_scores(summary: DataFrame, path: str) -> None:
    write_report(summary.select("k", "avg_distance"), path)


def write_scored_sample(sample: DataFrame, path: str) -> None:
    write_report(sample, path)


def append_run(run: DataFrame, path: str) -> None:
    """Add the row of one grid run to the table of runs."""
    run.write.mode("append").option("header", True).csv(path)


def dump_clusters(scored: DataFrame, path: str, features: str = "features") -> None:
    """Text lines ``cluster,v1,v2,...``."""
    scored.select(cluster_line(features).alias("value")).write.mode("overwrite").text(path)


def cluster_line(features: str = "features"):
    return F.concat_ws(",", F.col("prediction").cast("string"), F.col(features).cast("array<string>"))
