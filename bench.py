"""Times the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each job runs once on its own inputs; no job reuses another one's cached frames.  Before
the clock starts, every job runs once on the smallest tables next to $BENCH_SF_DIR, so
that starting the JVM and compiling code is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks import queries as q  # noqa: E402
from lexigear.operators import classify as jc  # noqa: E402
from lexigear.operators import concepts as co  # noqa: E402
from lexigear.operators import search as se  # noqa: E402
from lexigear.operators import tokens as tk  # noqa: E402
from lexigear.operators import weighting as wt  # noqa: E402
from lexigear.plans import gearbox, lsa  # noqa: E402
from lexigear.sources.tables import with_point_id  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("lexigear-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lexigear-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def lsa_job(spark, sf: str, num_freq: int, k: int) -> None:
    """Tokens to concepts and one search, as one run of the whole job."""
    docs = q.regex_docs(spark, sf).persist()
    model = lsa.fit(docs, num_freq, k, keep=True)
    run(co.top_terms(model))
    run(co.top_docs(model))
    se.search(model, list(model.vocab.terms[1:4])).collect()


def sweep_job(spark, sf: str, ks) -> None:
    data = q.scaled_readings(spark, sf).withColumnRenamed("l_orderkey", "point_id")
    gearbox.sweep_k(data, ks, keep=["l_partkey"]).outliers.count()


def copies(spark, sf: str, table: str, times: int):
    """``times`` copies of a table, written out, as input of the size that was published."""
    path = f"{spark.conf.get('spark.checkpoint.dir')}/{table}-{times}"
    rows = spark.read.parquet(f"{sf}/{table}.parquet")
    rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(times))).alias("copy")).write.parquet(path)
    return spark.read.parquet(path)


def large_sweep(spark, sf: str, ks, seconds: dict) -> None:
    """Fit and scoring alone, as the published times: 14.4 million three-sensor readings."""
    rows = copies(spark, sf, "lineitem", 24).select("l_quantity", "l_discount", "l_tax")
    data = gearbox.prepare(rows, ["l_quantity", "l_discount", "l_tax"])
    data = with_point_id(data).select("point_id", "features").persist()
    data.count()
    for k in ks:
        summary = gearbox.sweep_k(data, (k,), keep=[]).summary
        seconds[f"large_kmeans_k{k}"] = round(summary.head().runtime_seconds, 3)
    data.unpersist()


def large_lsa(spark, sf: str, num_freq: int, k: int, times: int = 5) -> None:
    docs = copies(spark, sf, "documents", times)
    name = F.concat_ws("-", "doc_id", "copy")
    lsa_run(tk.tokens_regex(docs.select(name.alias("doc_id"), name.alias("title"), "text")).select("doc_id", "title", "features"), num_freq, k)


def lsa_run(docs, num_freq: int, k: int) -> None:
    model = lsa.fit(docs, num_freq, k, keep=True)
    run(co.top_terms(model))
    run(co.top_docs(model))


def full_jobs(spark, sf: str) -> dict:
    """Whole grids and published sizes; only with BENCH_FULL=1."""
    from checks import exact

    docs = lambda: q.documents(spark, sf)
    return {
        "lsa_20000_250": lambda: lsa_run(q.regex_docs(spark, sf), 20000, 250),
        "lsa_grid_regex": lambda: lsa.grid(docs(), {"regex": tk.tokens_regex}),
        "lsa_grid_nlp": lambda: lsa.grid(docs(), {"nlp": tk.tokens_lemma}),
        "large_lsa_5000_25": lambda: large_lsa(spark, sf, 5000, 25),
        "tune_cv_18": lambda: run(exact.tuned(spark, sf, jc.tune_cv, jc.decision_tree(), jc.area_under_roc())),
        "tune_tvs_18": lambda: run(exact.tuned(spark, sf, jc.tune_tvs, jc.decision_tree(), jc.area_under_roc())),
        "forest_cv_54": lambda: run(exact.tuned(spark, sf, jc.tune_cv, jc.random_forest(), jc.accuracy(), trees=jc.TREES)),
        "kmeans_default_2_150": lambda: run(q.h2_kmeans_default(spark, sf)),
        "sweep_scores_30_160": lambda: gearbox.sweep_scores(q.labelled_features(spark, sf), [*range(30, 61, 10), *range(70, 121, 10), *range(130, 161, 10)]),
        "one_hot_sparse": lambda: run(q.g4_one_hot_sparse(spark, sf)),
        "sweep_entropy_120_160": lambda: gearbox.sweep_entropy(q.labelled_features(spark, sf), range(120, 161, 10)),
    }


def jobs(spark, sf: str) -> dict:
    docs = lambda: q.documents(spark, sf)
    return {
        "tokens_regex": lambda: run(tk.tokens_regex(docs())),
        "tokens_lemma": lambda: run(tk.tokens_lemma(docs())),
        "term_freqs": lambda: run(wt.term_freqs(q.regex_docs(spark, sf))),
        "vocabulary_5000": lambda: run(wt.vocabulary(q.regex_docs(spark, sf), 5000)),
        "lsa_5000_25": lambda: lsa_job(spark, sf, 5000, 25),
        "lsa_5000_100": lambda: lsa_job(spark, sf, 5000, 100),
        "lsa_10000_25": lambda: lsa_job(spark, sf, 10000, 25),
        "batch_search": lambda: run(q.f12_batch_search(spark, sf)),
        "standardize": lambda: run(q.g2_standardize(spark, sf)),
        "one_hot": lambda: run(q.g4_one_hot(spark, sf)),
        "kmeans_k2": lambda: sweep_job(spark, sf, (2,)),
        "kmeans_k7": lambda: sweep_job(spark, sf, (7,)),
        "kmeans_k12": lambda: sweep_job(spark, sf, (12,)),
    }


def main() -> None:
    spark = session()
    small = Path(SF_DIR).parent / "sf0.001"
    if small.exists():
        for job in jobs(spark, str(small)).values():
            job()
            spark.catalog.clearCache()
    seconds = {}
    for name, job in jobs(spark, SF_DIR).items():
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    if os.environ.get("BENCH_FULL"):
        for name, job in full_jobs(spark, SF_DIR).items():
            start = time.perf_counter()
            job()
            seconds[name] = round(time.perf_counter() - start, 3)
            spark.catalog.clearCache()
        large_sweep(spark, SF_DIR, (2, 7, 12), seconds)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": SF_DIR.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
