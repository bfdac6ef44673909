"""Where intermediate tables go, how source scans are spread over the cores, and row numbers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
# Bytes of files for one task.  Decoded, and as tokens, features or Arrow batches, they are
# many times as much, so this bounds what a task reads and holds, however large the table.
BYTES_PER_TASK = 8 * 1024 * 1024


def shared_folder(spark: SparkSession, name: str = "table") -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``."""
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if base is None:
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder all executors reach")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def through_table(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a table that outlives lost executors, and lets later
    passes read only the columns they need.  Its compression is that which takes least disk.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_table(df: DataFrame) -> bool:
    """Whether ``df`` reads files and computes nothing, so that a copy would save no work."""
    return df._jdf.queryExecution().optimizedPlan().getClass().getSimpleName() == "LogicalRelation"


def scan_bytes(scan: DataFrame) -> int:
    """The size that the optimizer expects of a scan: that of its files."""
    return int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Deal out a scan, so that all cores have work and no task has much.

    Files are cut by bytes, but a Parquet file is read by row groups: a table is often few
    row groups, and so few tasks, in several splits; and a split may be 128 MB, which are
    gigabytes once they are decoded and persisted.  There are as many tasks as cores for a
    small table, and one for every ``BYTES_PER_TASK`` of a large one.  A small table of as
    many files as cores passes unchanged.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-scan_bytes(scan) // BYTES_PER_TASK))
    if tasks == cores and len(scan.inputFiles()) >= cores:
        return scan
    return scan.repartition(tasks, *keys)


def numbered_rows(rows: DataFrame, *keys: str, name: str = "no") -> DataFrame:
    """``rows`` with their number in the order of ``keys``, from 0 on.

    Rows are dealt out by ranges of the keys and numbered where they lie; what meets in one
    task is a count for each range.  Rows of equal keys are numbered in any order.
    """
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = placed.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    placed = through_table(placed, "placed")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(starts), "_part").withColumn(name, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before", "_n")
