"""Helpers the corpus operators share: tables that cut lineage, sized broadcasts, batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
BROADCAST_ROWS = 200_000  # narrow rows: some 10 MB, whatever the corpus


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the session names in ``spark.checkpoint.dir``."""
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if base is None:
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder all executors reach")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: later steps neither recompute
    it nor depend on executors that may be lost."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it was counted to be small; else unchanged, and the
    join shuffles.  ``df`` should be a written table, since counting runs it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def texts(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Strings of an Arrow column; null counts as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def few(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a task turns few texts at a time into
    Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def runs(batches: Iterator[pa.RecordBatch], key: list[str], rows: int = 50_000) -> Iterator[pa.Table]:
    """Regroups sorted batches into tables that never cut a run of equal ``key`` values."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            last = run_starts(table, key)[-1]
            if last:
                yield table.slice(0, last)
                held = table.slice(last).to_batches()
            else:
                held = table.to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def run_starts(table: pa.Table, key: list[str]) -> np.ndarray:
    """Row numbers at which a new run of ``key`` values begins; 0 is always the first."""
    new = np.zeros(table.num_rows, dtype=bool)
    if not table.num_rows:
        return np.flatnonzero(new)
    new[0] = True
    for name in key:
        values = table.column(name).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)
