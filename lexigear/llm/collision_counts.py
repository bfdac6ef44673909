"""Near-duplicate vectors by collision counting over one-dimensional projections.

Vectors are scaled to length one and projected on random directions.  Around each query
every projection has a window; a pair's count is the number of projections in which the
partner lies in the query's window.  Pairs that reach a count calibrated for recall at the
threshold are verified by their cosine in double precision.

The first projection, with a wider window, also deals the work: a label's vectors are cut
into cells as wide as that window, a query meets the candidates of its own cell and the
next, and a cell with many vectors is dealt over a square of keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigear.llm.common import materialize, runs
from lexigear.llm.components import connected_components
from lexigear.llm.simhash_cover import forest

COSINE = 0.93
PROJECTIONS = 24
WINDOW = 2.0  # half width of a window, in distances of two vectors at the threshold
FIRST_WINDOW = 2.8  # the same of the projection that deals the work
RECALL = 0.99  # of pairs at the threshold, by the count; closer pairs are found more often
CELL = 4_096  # rows of a cell beyond which its pairs are dealt over several keys
SEED = 20_011


def chance(window: float) -> float:
    """That a pair at the threshold falls into a window of so many distances."""
    return erf(window / sqrt(2))


@cache
def least_count(projections: int = PROJECTIONS, window: float = WINDOW, recall: float = RECALL) -> int:
    """The largest count that pairs at the threshold reach with chance ``recall``.

    The difference of two vectors, projected on a random normal direction, is normal with
    their distance as its deviation, and directions are independent.
    """
    p, total = chance(window), 0.0
    for count in range(projections, -1, -1):
        total += comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if total >= recall:
            return count
    return 0


@cache
def directions(size: int, projections: int) -> np.ndarray:
    return np.random.default_rng(SEED + size).standard_normal((size, projections + 1))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, by way of their largest component."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of an Arrow list column whose lists are of one length."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(values), -1)


def usable(vector):
    """Whether a vector may link: not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


HOME, OTHER = 1, 2


def placed(classes: DataFrame, cosine: float) -> DataFrame:
    """Classes with the cell of their first projection."""
    width = FIRST_WINDOW * sqrt(2 - 2 * cosine)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros(batch.num_rows, dtype=np.int64)
            size = np.array([len(x) for x in batch.column(2)])
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                first = (unit(matrix(batch.column(2).take(pa.array(at)))) @ directions(int(n), PROJECTIONS))[:, 0]
                cells[at] = np.floor(first / width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells), pa.array(size.astype(np.int32))], names=[*batch.schema.names, "cell", "size"])

    return classes.select("label", "rep", "vector", "n").mapInArrow(project, "label string, rep long, vector array<double>, n long, cell long, size int")


def meetings(cells: DataFrame, most: int) -> DataFrame:
    """Rows at every key at which they meet others, with their role there."""
    seen = cells.select("label", "size", "cell").unionByName(cells.select("label", "size", (F.col("cell") - 1).alias("cell")))
    hot = seen.groupBy("label", "size", "cell").count().where(F.col("count") > most)
    hot = hot.select("label", "size", "cell", F.ceil(F.col("count") / most).cast("int").alias("parts"))
    at = F.explode(F.array(F.struct("cell", F.lit(HOME + OTHER).alias("role")), F.struct((F.col("cell") - 1).alias("cell"), F.lit(OTHER).alias("role"))))
    rows = cells.select("label", "size", "rep", "vector", "n", at.alias("at")).select("label", "size", "at.cell", "at.role", "rep", "vector", "n")
    rows = rows.join(hot, ["label", "size", "cell"], "left").withColumn("own", F.pmod(F.xxhash64("rep"), F.coalesce("parts", F.lit(1))).cast("int"))
    whole = F.array(F.struct(F.lit(0).alias("row"), F.lit(0).alias("col"), F.col("role").alias("role")))
    steps = F.sequence(F.lit(0), F.col("parts") - 1)
    as_home = F.transform(steps, lambda i: F.struct(F.col("own").alias("row"), i.alias("col"), F.lit(HOME).alias("role")))
    as_other = F.transform(steps, lambda i: F.struct(i.alias("row"), F.col("own").alias("col"), F.lit(OTHER).alias("role")))
    own_cell = F.col("role") == HOME + OTHER
    places = F.when(F.col("parts").isNull(), whole).when(own_cell, F.concat(as_home, as_other)).otherwise(as_other)
    # rows of the own cell meet once: the one of the smaller id is the query
    return rows.select("label", "size", "cell", own_cell.alias("same"), F.explode(places).alias("to"), "rep", "vector", "n").select("label", "size", "cell", "to.row", "to.col", "to.role", "same", "rep", "vector", "n")


def counted(points: np.ndarray, query: np.ndarray, others: np.ndarray, window: float, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """(query, its partners by count): each projection is sorted once, and a query's window
    is the run of it between two binary searches."""
    order = [others[np.argsort(points[others, j], kind="stable")] for j in range(points.shape[1])]
    low = [np.searchsorted(points[o, j], points[query, j] - window, side="left") for j, o in enumerate(order)]
    high = [np.searchsorted(points[o, j], points[query, j] + window, side="right") for j, o in enumerate(order)]
    for k, q in enumerate(query):
        inside = np.concatenate([o[a[k] : b[k]] for o, a, b in zip(order, low, high)])
        yield q, np.flatnonzero(np.bincount(inside) >= least)


def links(classes: DataFrame, cosine: float = COSINE, most: int = CELL) -> DataFrame:
    """(node, root, links): what each task has found out about a class, namely how many
    vectors its partners there stand for, and the smallest class it reaches there."""
    least = least_count()
    width = sqrt(2 - 2 * cosine)
    key = ["label", "size", "cell", "row", "col"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, key, 20_000):
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            columns = {c: table.column(c).to_numpy(zero_copy_only=False) for c in [*key, "role", "same", "rep", "n"]}
            new = np.zeros(table.num_rows, dtype=bool)
            new[0] = True
            for c in key:
                new[1:] |= columns[c][1:] != columns[c][:-1]
            edges = np.append(np.flatnonzero(new), table.num_rows)
            for a, b in zip(edges, edges[1:]):
                role, same, rep, n = (columns[c][a:b] for c in ("role", "same", "rep", "n"))
                query, others = np.flatnonzero(role & HOME), np.flatnonzero(role & OTHER)
                if not len(query) or not len(others):
                    continue
                vectors = unit(matrix(table.column("vector").slice(a, b - a)))
                points = vectors @ directions(vectors.shape[1], PROJECTIONS)
                pairs: list[tuple[np.ndarray, np.ndarray]] = []
                for q, found in counted(points[:, 1:], query, others, WINDOW * width, least):
                    found = found[~same[found] | (rep[found] > rep[q])]
                    found = found[np.abs(points[found, 0] - points[q, 0]) <= FIRST_WINDOW * width]
                    found = found[vectors[found] @ vectors[q] >= cosine]
                    if len(found):
                        pairs.append((np.full(len(found), q), found))
                if pairs:
                    x, y = (np.concatenate(p) for p in zip(*pairs))
                    total = np.bincount(x, n[y], minlength=b - a) + np.bincount(y, n[x], minlength=b - a)
                    root = {int(v): int(u) for u, v in zip(*forest(rep[x], rep[y]))}
                    hit = np.flatnonzero(total)
                    out.append((rep[hit], np.array([root.get(int(r), int(r)) for r in rep[hit]]), total[hit].astype(np.int64)))
            if out:
                node, root, total = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root), pa.array(total)], names=["node", "root", "links"])

    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = meetings(placed(classes, cosine), most).repartition(n, *key).sortWithinPartitions(*key)
    return dealt.mapInArrow(compare, "node long, root long, links long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``vectors``.

    Vectors of one label (null labels: none) and one size link if the search finds them
    and their cosine is at least ``cosine``.  Equal vectors are one class in the search and
    link with one another.  Null, zero or non-finite vectors and rows without an id link
    with nothing; a row without an id has no component and is not kept.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).cast("string").alias("label"))
    can = usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    good = rows.where(can)
    classes = materialize(good.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "vectors")
    found = materialize(links(classes, cosine), "links")
    total = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = materialize(connected_components(found.select(F.col("root").alias("u"), F.col("node").alias("v"))), "components")
    known = classes.join(total, F.col("rep") == total["node"], "left").join(roots, F.col("rep") == roots["node"], "left")
    known = known.select("label", "vector", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    with_class = good.join(known, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(can, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return with_class.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
