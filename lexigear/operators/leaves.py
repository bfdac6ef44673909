"""Points packed for many scans, as leaves of near ones with a box around each.

A K-Means sweep scans its points dozens of times.  Rows of numbers cost most of such a scan
on their way to Python, and then every point meets every center.  So one scan packs the
points of a task: they are split, along the longest side of their box, until at most
``LEAF`` are left, and kept as bytes with the box and the sum of each leaf.  Later scans
first rule out, by the box, the centers that are nearest to none of a leaf's points.  Where
one center remains, the sum of the leaf stands for its points; otherwise the points are
compared with the centers that remain.  This drops no point and moves none: a center is ruled
out only if it is farther than another one from all of the box.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Points of a leaf at most.
LEAF = 64
# Doubles that are packed together.
CHUNK = 4_000_000
# Distances held by one array operation inside a task.
DISTANCES_PER_STEP = 250_000
# Up to so many centers the points of a leaf are summed by a product with flags.
FEW = 16
# Rounding of distances, as a part of the squared lengths: a center is ruled out by more.
ROUNDING = 1e-11

PACKED = "part int, chunk int, sizes array<int>, width int, places binary, ends binary, points binary, boxes binary"
#: What the steps of a fit read.
SCANNED = ("sizes", "width", "ends", "points", "boxes")
CODEC = "lz4_raw"


def checked(column: pa.ListArray, width: int) -> np.ndarray:
    """The points of a batch as a matrix."""
    points = column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    if column.null_count or len(points) != width * len(column) or not np.isfinite(points).all():
        raise ValueError(f"features must be {width} finite numbers")
    return points.reshape(-1, width)


def leaf_order(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """An order in which points of a leaf are neighbours, and where each leaf ends.

    A part is split where its widest dimension changes its value next to the middle, so that
    equal values, such as flags, stay together; parts of up to two leaves in the middle.
    """
    columns, order, ends = np.ascontiguousarray(points.T), np.arange(len(points)), []
    # Widths are those of the part above until a dimension's turn comes.
    parts = [(0, len(points), np.ptp(columns, axis=1) if len(points) else np.zeros(len(columns)))]
    while parts:
        first, last, widths = parts.pop()
        n = last - first
        if n <= leaf:
            ends.append(last)
            continue
        own, half = order[first:last], n // 2
        while True:
            j = int(widths.argmax())
            x = columns[j][own]
            true = x.max() - x.min()
            if true >= widths[j]:
                break
            widths[j] = true
        if not true > 0:
            # Equal points, which share a box however they are split.
            ends.extend([*range(first + leaf, last, leaf), last])
            continue
        by = x.argpartition(half)
        cut = half
        if n > 2 * leaf:
            less, most = x < x[by[half]], x <= x[by[half]]
            below, upto = np.count_nonzero(less), np.count_nonzero(most)
            below, upto, low = (below, upto, less) if below and (upto == n or half - below <= upto - half) else (upto, upto, most)
            cut, by = below, np.concatenate([np.flatnonzero(low), np.flatnonzero(~low)])
        order[first:last] = own[by]
        parts += [(first + cut, last, widths.copy()), (first, first + cut, widths)]
    return order, np.array(ends, dtype=np.int64)


def pack(df: DataFrame, column: str, label: str | None = None) -> DataFrame:
    """The points of ``df`` in leaves; persist it.  A task's rows stay in their partition.

    With ``label`` the labels come along, as places in a list of the different ones.
    A null, a number that is not finite or an array of another size is an error.
    """
    kind = None if label is None else df.schema[label].dataType.simpleString()
    schema = PACKED if kind is None else f"{PACKED}, labels array<{kind}>, codes binary"
    # Another name than that of the features, which may be the label as well.
    rows = df.select(column) if label is None else df.select(F.col(column).alias("_features"), F.col(label).alias("_label"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, labels, size, number, width = [], [], 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            found = batch.column(0)
            width = (len(found[0]) if found[0].is_valid else 0) if width is None else width
            held.append(checked(found, width))
            size += held[-1].size
            if label is not None:
                labels.append(batch.column(1))
            if size >= CHUNK:
                yield one(held, labels, number, width)
                held, labels, size, number = [], [], 0, number + 1
        if held:
            yield one(held, labels, number, width)

    def one(held: list[np.ndarray], labels: list[pa.Array], number: int, width: int) -> pa.RecordBatch:
        points = np.concatenate(held)
        order, ends = leaf_order(points)
        points = points[order]
        first = np.r_[0, ends[:-1]]
        boxes = np.stack([np.minimum.reduceat(points, first), np.maximum.reduceat(points, first), np.add.reduceat(points, first)])
        row = {
            "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "chunk": pa.array([number], pa.int32()),
            "sizes": pa.array([[len(x) for x in held]], pa.list_(pa.int32())), "width": pa.array([width], pa.int32()),
            "places": pa.array([order.astype(np.int32).tobytes()], pa.binary()), "ends": pa.array([ends.astype(np.int32).tobytes()], pa.binary()),
            "points": pa.array([pa.compress(points.tobytes(), CODEC, asbytes=True)], pa.binary()), "boxes": pa.array([boxes.tobytes()], pa.binary()),
        }
        if labels:
            known = pa.chunked_array(labels).combine_chunks().dictionary_encode(null_encoding="encode")
            known = known.combine_chunks() if isinstance(known, pa.ChunkedArray) else known
            values = known.dictionary
            row["labels"] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            row["codes"] = pa.array([known.indices.to_numpy(zero_copy_only=False)[order].astype(np.int32).tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays(list(row.values()), names=list(row))

    return rows.mapInArrow(packed, schema)


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Leaves]]:
    """Each chunk with the other columns of its row."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            binary = {name: row.column(name)[0].as_buffer() for name in ("ends", "points", "boxes")}
            width, n = row.column("width")[0].as_py(), sum(row.column("sizes")[0].as_py())
            points = np.frombuffer(pa.decompress(binary["points"], 8 * n * width, CODEC)).reshape(n, width)
            ends = np.frombuffer(binary["ends"], np.int32).astype(np.int64)
            yield row, Leaves(points, ends, *np.frombuffer(binary["boxes"]).reshape(3, len(ends), width))


def places(row: pa.RecordBatch) -> np.ndarray:
    """Where each point of the leaves stood among the rows of its chunk."""
    return np.frombuffer(row.column("places")[0].as_buffer(), np.int32)


@dataclass(frozen=True)
class Near:
    """Points of some leaves, or each of them as a leaf, and the centers that may be nearest.

    ``at`` (leaves x points) are the places of the points, the last one repeated in a leaf
    that is not full; ``real`` tells which are no repeats.  ``centers`` (leaves x centers)
    has numbers of centers, ``own`` (leaves x points) which of these is nearest, and
    ``ranks`` (leaves x points) the squared distance to it without the point's own square.
    """

    at: np.ndarray
    real: np.ndarray
    points: np.ndarray
    centers: np.ndarray
    own: np.ndarray
    ranks: np.ndarray


@dataclass(frozen=True)
class Leaves:
    """A chunk: points in the order of the leaves, and a box and a sum for each of these."""

    points: np.ndarray
    ends: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)

    def candidates(self, centers: np.ndarray) -> np.ndarray:
        """leaves x centers: which centers may be nearest to a point in the box.

        How much closer than the center nearest to the middle another one can be is a linear
        function of the point, so it is largest in a corner of the box.
        """
        middle, half = (self.low + self.high) / 2, (self.high - self.low) / 2
        squares = (centers * centers).sum(axis=1)
        near = middle @ (2 * centers.T) - squares
        best = near.argmax(axis=1)
        least = near[np.arange(len(near)), best]
        least -= ROUNDING * ((np.maximum(np.abs(self.low), np.abs(self.high)) ** 2).sum(axis=1) + squares.max(initial=0.0))
        by = best.argsort(kind="stable")
        ends = np.searchsorted(best[by], np.arange(len(centers) + 1))
        for c, (a, b) in enumerate(zip(ends, ends[1:])):
            if b > a:
                near[by[a:b]] += half[by[a:b]] @ (2 * np.abs(centers - centers[c])).T
        return near >= least[:, None]

    def near(self, centers: np.ndarray, kept: np.ndarray, which: np.ndarray) -> Iterator[Near]:
        """The points of the leaves ``which``, each compared with the centers ``kept`` for it;
        equal distances go to the lowest number."""
        squares, found = (centers * centers).sum(axis=1), kept[which].sum(axis=1)
        starts, factors = self.ends - self.counts, np.ascontiguousarray(-2.0 * centers.T)
        # Where most centers remain, all of them are one product, with each point for itself.
        most = (4 * found > len(centers)) & (found > FEW)
        every = np.isin(np.arange(len(self.ends)), which[most])
        single = np.flatnonzero(np.repeat(every, self.counts))
        size = max(1, DISTANCES_PER_STEP // max(len(centers), self.points.shape[1]))
        for first in range(0, len(single), size):
            place = single[first : first + size, None]
            points = self.points[place[:, 0]]
            ranks = points @ factors
            ranks += squares
            own = ranks.argmin(axis=1)[:, None]
            listed = np.broadcast_to(np.arange(len(centers)), ranks.shape)
            yield Near(place, np.ones(place.shape, bool), points[:, None, :], listed, own, np.take_along_axis(ranks, own, 1))
        which, found = which[~most], found[~most]
        for m in np.unique(found):
            leaves = which[found == m]
            size = max(1, DISTANCES_PER_STEP // (LEAF * max(int(m), self.points.shape[1])))
            for first in range(0, len(leaves), size):
                some = leaves[first : first + size]
                listed = np.nonzero(kept[some])[1].reshape(-1, m)
                place = starts[some, None] + np.arange(LEAF)
                real = place < self.ends[some, None]
                place = np.minimum(place, self.ends[some, None] - 1)
                points = self.points[place]
                ranks = points @ (-2.0 * centers[listed]).transpose(0, 2, 1)
                ranks += squares[listed][:, None, :]
                own = ranks.argmin(axis=2)
                yield Near(place, real, points, listed, own, np.take_along_axis(ranks, own[:, :, None], 2)[:, :, 0])

    def shares(self, centers: np.ndarray) -> np.ndarray:
        """Sums and counts of the points nearest to each center."""
        kept = self.candidates(centers)
        n, width = len(centers), self.points.shape[1]
        out = np.zeros((n, width + 1))

        def add(at: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
            for j in range(width):
                out[:, j] += np.bincount(at, sums[:, j], n)
            out[:, width] += np.bincount(at, counts, n)

        settled = kept.sum(axis=1) == 1
        add(kept[settled].argmax(axis=1), self.sums[settled], self.counts[settled])
        for part in self.near(centers, kept, np.flatnonzero(~settled)):
            if part.centers.shape[1] > FEW:
                at = np.take_along_axis(part.centers, part.own, 1)[part.real]
                add(at, part.points[part.real], np.ones(len(at)))
                continue
            own = ((part.own[:, :, None] == np.arange(part.centers.shape[1])) & part.real[:, :, None]).astype(float)
            add(part.centers.ravel(), (own.transpose(0, 2, 1) @ part.points).reshape(-1, width), own.sum(axis=1).ravel())
        return out

    def costs(self, centers: np.ndarray) -> np.ndarray:
        """Squared distance to the nearest center; zero where it is no more than rounding."""
        out = np.empty(len(self.points))
        for part in self.near(centers, self.candidates(centers), np.arange(len(self.ends))):
            squares = (part.points * part.points).sum(axis=2)
            costs = squares + part.ranks
            out[part.at] = np.where(costs > 1e-12 * squares, costs, 0.0)
        return out

    def clusters(self, centers: np.ndarray) -> np.ndarray:
        """The nearest center of each point."""
        kept = self.candidates(centers)
        settled = kept.sum(axis=1) == 1
        out = np.repeat(kept.argmax(axis=1), self.counts)
        for part in self.near(centers, kept, np.flatnonzero(~settled)):
            out[part.at] = np.take_along_axis(part.centers, part.own, 1)
        return out
