"""The directions a decomposition has found, and their images, kept locally or by rows.

``factorize`` needs a basis of directions (terms x columns), orthonormal, and the image of
each under ``A'A``.  While both are small they are arrays on the driver.  Beyond that they
are a table with one row for each range of terms: tasks multiply and orthonormalize the
ranges where they lie, and the driver holds one block of new directions at a time.

Rows of the table are orthonormalized by a tree of small QR decompositions: every range has
one of its own, the triangles are stacked and decomposed until one is left, and the factors
are handed down again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigear.shared import through_table

# Columns of one row of a summed block.
PIECE = 32
# Bytes of one range of the basis.
RANGE_BYTES = 8 * 1024 * 1024
# Triangles are stacked on the driver up to this size, before that by tasks.
TOP_BYTES = 32 * 1024 * 1024
# Triangles a task stacks, and parts in which a block comes to the driver.
FAN, SLICES = 8, 4

#: Multiplies a block, or a shipped block of a number of columns, by ``A'A``.
Gram = Callable[..., np.ndarray]


def orthonormal(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = np.linalg.qr(x - basis @ (basis.T @ x))[0]
    return x


def random_block(rows: int, columns: int, seed: int, first: int = 0) -> np.ndarray:
    return np.random.default_rng((seed, first) if first else seed).standard_normal((rows, columns))


class LocalBlocks:
    """Basis and images as arrays."""

    def __init__(self, gram: Gram, n: int):
        self.gram, self.n = gram, n
        self.basis = self.image = np.empty((n, 0))
        self.new = self.rest = np.empty((n, 0))

    @property
    def columns(self) -> int:
        return self.basis.shape[1]

    def start(self, width: int) -> None:
        self.new = np.eye(self.n) if width == self.n else orthonormal(random_block(self.n, width, 0), self.basis)

    def extend(self) -> np.ndarray:
        """Take the new directions in; the products of all directions with all images."""
        self.basis = np.hstack([self.basis, self.new])
        self.image = np.hstack([self.image, self.gram(self.new)])
        return self.basis.T @ self.image

    def residuals(self, mix: np.ndarray, values: np.ndarray) -> np.ndarray:
        """How far each mixture of directions is from an eigenvector."""
        self.rest = self.image @ mix - self.basis @ (mix * values)
        return np.linalg.norm(self.rest, axis=0)

    def advance(self, order: np.ndarray, width: int, seed: int) -> None:
        """New directions: what is left of the mixtures in ``order``, and random ones."""
        rest = self.rest[:, order]
        if rest.shape[1] < width or not np.abs(rest).max() > 0:
            rest = rest if np.abs(rest).max(initial=0) > 0 else rest[:, :0]
            rest = np.hstack([rest, random_block(self.n, width, seed)])[:, :width]
        self.new = orthonormal(rest, self.basis)[:, : self.n - self.columns]

    def restart(self, kept: np.ndarray) -> None:
        """Keep these mixtures only; their images need no new pass."""
        self.basis, self.image = self.basis @ kept, self.image @ kept

    def vectors(self, mix: np.ndarray) -> np.ndarray:
        return self.basis @ mix


SUMMED = "piece long, " + ", ".join(f"c{i} double" for i in range(PIECE))


def summands(share: np.ndarray) -> pa.RecordBatch:
    """A task's matrix as rows for ``summed``: pieces of ``PIECE`` columns.

    The width of a piece is fixed, so that the plan and its generated code are the same for
    every matrix; pieces of zeros are left out.
    """
    padded = np.pad(share, ((0, 0), (0, -share.shape[1] % PIECE))) if share.shape[1] % PIECE else share
    pieces = np.ascontiguousarray(padded).reshape(-1, PIECE)
    used = np.flatnonzero(pieces.any(axis=1))
    columns = [pa.array(c) for c in np.ascontiguousarray(pieces[used].T)]
    return pa.RecordBatch.from_arrays([pa.array(used), *columns], names=["piece", *[f"c{i}" for i in range(PIECE)]])


def summed(parts: DataFrame, rows: int, columns: int, slices: int = 1) -> np.ndarray:
    """The sum of the matrices that tasks give as ``summands``, on the driver, which takes
    it in ``slices``."""
    names = [f"c{i}" for i in range(PIECE)]
    sums = parts.groupBy("piece").sum(*names)
    if slices > 1:
        sums = through_table(sums, "sums")
    out = np.zeros((rows, -(-columns // PIECE) * PIECE))
    flat = out.reshape(-1, PIECE)
    for i in range(slices):
        found = (sums.where(F.col("piece") % slices == i) if slices > 1 else sums).toArrow()
        at = found.column("piece").to_numpy()
        for j in range(PIECE):
            flat[at, j] = found.column(j + 1).to_numpy()
    return out[:, :columns]


STATE = "part int, basis binary, image binary"
BLOCK = "part int, x binary"


def _matrix(binary: pa.BinaryScalar, rows: int, columns: int) -> np.ndarray:
    return np.frombuffer(binary.as_buffer()).reshape(rows, columns) if columns else np.empty((rows, 0))


def _block_rows(rows: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array([x.tobytes() for _, x in rows], pa.binary())], names=["part", "x"])


class TableBlocks:
    """Basis and images as a table (part, basis, image) of ranges of rows.

    The driver holds the products of directions and one block; blocks are shipped to the
    tasks one at a time.  Every step reads a written table, so a lost executor costs the
    ranges it was working on.
    """

    def __init__(self, gram: Gram, n: int, spark: SparkSession, width: int, held: int):
        self.gram, self.n, self.spark = gram, n, spark
        self.columns, self.width = 0, width
        self.size = min(n, max(width, RANGE_BYTES // (8 * held)))
        parts = spark.range(-(-n // self.size)).select(F.col("id").cast("int").alias("part"))
        self.state = parts.selectExpr("part", "X'' AS basis", "X'' AS image")
        self.small = np.empty((0, 0))
        self.new: np.ndarray | None = None
        self.mixed: tuple[np.ndarray, np.ndarray, np.ndarray]

    # Work on the ranges

    def _map(self, work: Callable, schema: str, shipped: tuple = ()) -> DataFrame:
        """``work(part, rows, basis, image, *shipped)`` on each range, a batch each."""
        columns, size, n = self.columns, self.size, self.n

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            values = [s.value for s in shipped]
            for batch in batches:
                for part, basis, image in zip(batch.column("part").to_pylist(), batch.column("basis"), batch.column("image")):
                    rows = slice(part * size, min(n, (part + 1) * size))
                    yield from work(part, rows, _matrix(basis, rows.stop - rows.start, columns), _matrix(image, rows.stop - rows.start, columns), *values)

        return self.state.mapInArrow(each, schema)

    def _ship(self, *arrays: np.ndarray) -> tuple:
        return tuple(self.spark.sparkContext.broadcast(a) for a in arrays)

    @staticmethod
    def _drop(shipped: tuple) -> None:
        for s in shipped:
            s.destroy()

    def _fetch(self, block: DataFrame, columns: int) -> np.ndarray:
        """A written block on the driver, which takes it in parts."""
        out = np.empty((self.n, columns))
        for i in range(SLICES):
            found = block.where(F.col("part") % SLICES == i).toArrow()
            for part, x in zip(found.column("part").to_pylist(), found.column("x")):
                rows = slice(part * self.size, min(self.n, (part + 1) * self.size))
                out[rows] = _matrix(x, rows.stop - rows.start, columns)
        return out

    def _products(self, block: tuple, width: int) -> np.ndarray:
        """``basis' x`` for a shipped block."""
        columns, size, n = self.columns, self.size, self.n

        def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            x, total = block[0].value, np.zeros((columns, width))
            for batch in batches:
                for part, basis in zip(batch.column("part").to_pylist(), batch.column("basis")):
                    rows = slice(part * size, min(n, (part + 1) * size))
                    total += _matrix(basis, rows.stop - rows.start, columns).T @ x[rows]
            yield summands(total)

        return summed(self.state.select("part", "basis").mapInArrow(share, SUMMED), columns, width)

    # The steps of the solver

    def start(self, width: int) -> None:
        self.new = np.eye(self.n) if width == self.n else self._orthonormal(lambda rows, *_: random_block(rows.stop - rows.start, width, 0, rows.start), (), width)

    def extend(self) -> np.ndarray:
        new, self.new = self.new, None
        width = new.shape[1]
        x = self._ship(new)
        del new
        y = self._ship(self.gram(x[0], width))

        def append(part: int, rows: slice, basis: np.ndarray, image: np.ndarray, x: np.ndarray, y: np.ndarray) -> Iterator[pa.RecordBatch]:
            grown = [np.hstack([a, b[rows]]).tobytes() for a, b in ((basis, x), (image, y))]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *[pa.array([g], pa.binary()) for g in grown]], names=["part", "basis", "image"])

        self.state = through_table(self._map(append, STATE, x + y), "basis")
        before, self.columns = self.columns, self.columns + width
        self._drop(x)
        columns = self._products(y, width)
        self._drop(y)
        grown = np.zeros((self.columns, self.columns))
        grown[:before, :before] = self.small
        grown[:, before:], grown[before:, :before] = columns, columns[:before].T
        self.small = grown
        return grown

    def residuals(self, mix: np.ndarray, values: np.ndarray) -> np.ndarray:
        shipped = self._ship(mix, mix * values)
        width = mix.shape[1]

        def squares(part: int, rows: slice, basis: np.ndarray, image: np.ndarray, m: np.ndarray, mv: np.ndarray) -> Iterator[pa.RecordBatch]:
            rest = image @ m - basis @ mv
            yield summands((rest * rest).sum(axis=0)[None])

        found = np.sqrt(summed(self._map(squares, SUMMED, shipped), 1, width)[0])
        self._drop(shipped)
        self.mixed = (mix, values, found)
        return found

    def advance(self, order: np.ndarray, width: int, seed: int) -> None:
        mix, values, norms = self.mixed
        order = order if norms[order].any() else order[:0]
        mix, values = mix[:, order], values[order]
        shipped = self._ship(mix, mix * values)

        def rest(rows: slice, basis: np.ndarray, image: np.ndarray, m: np.ndarray, mv: np.ndarray) -> np.ndarray:
            found = image @ m - basis @ mv
            more = width - found.shape[1]
            return np.hstack([found, random_block(len(found), more, seed, rows.start + 1)]) if more else found

        self.new = self._orthonormal(rest, shipped, width)[:, : self.n - self.columns]
        self._drop(shipped)

    def _orthonormal(self, first: Callable, shipped: tuple, width: int) -> np.ndarray:
        """The block that ``first`` gives range by range, made orthonormal to the basis and in
        itself, twice, since once is not exact."""
        block = self._from_tasks(lambda part, rows, basis, image, *s: iter([_block_rows([(part, first(rows, basis, image, *s))])]), shipped, width)
        for _ in range(2):
            x = self._ship(block)
            del block
            if self.columns:
                x += self._ship(self._products(x, width))
            block = self._tree(x, width)
            self._drop(x)
        return block

    def _from_tasks(self, work: Callable, shipped: tuple, width: int) -> np.ndarray:
        return self._fetch(through_table(self._map(work, BLOCK, shipped), "block"), width)

    def _tree(self, x: tuple, width: int) -> np.ndarray:
        """``x``, less its part in the basis, orthonormalized by a tree of QRs."""

        def leaf(part: int, rows: slice, basis: np.ndarray, image: np.ndarray, x: np.ndarray, inside: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
            own = x[rows] if inside is None else x[rows] - basis @ inside
            q, r = np.linalg.qr(own)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([q.tobytes()], pa.binary()), pa.array([r.tobytes()], pa.binary())], names=["node", "q", "r"])

        leaves = through_table(self._map(leaf, "node int, q binary, r binary", x), "leaves")
        turns = tree_factors(leaves.select("node", "r"), -(-self.n // self.size), width)

        def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                done = []
                for part, q, t in zip(batch.column("node").to_pylist(), batch.column("q"), batch.column("t")):
                    t = _matrix(t, -1, width)
                    done.append((part, _matrix(q, -1, len(t)) @ t))
                yield _block_rows(done)

        # written, since the driver takes the block in several parts
        block = through_table(leaves.select("node", "q").join(turns, "node").mapInArrow(turn, BLOCK), "block")
        return self._fetch(block, width)

    def restart(self, kept: np.ndarray) -> None:
        shipped = self._ship(kept)

        def keep(part: int, rows: slice, basis: np.ndarray, image: np.ndarray, m: np.ndarray) -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *[pa.array([(a @ m).tobytes()], pa.binary()) for a in (basis, image)]], names=["part", "basis", "image"])

        self.state = through_table(self._map(keep, STATE, shipped), "basis")
        self._drop(shipped)
        self.small = kept.T @ self.small @ kept
        self.columns = kept.shape[1]

    def vectors(self, mix: np.ndarray) -> np.ndarray:
        shipped = self._ship(mix)
        found = self._from_tasks(lambda part, rows, basis, image, m: iter([_block_rows([(part, basis @ m)])]), shipped, mix.shape[1])
        self._drop(shipped)
        return found


def tree_factors(triangles: DataFrame, count: int, width: int) -> DataFrame:
    """``node, t``: what the rows of each node's own factor are to be multiplied by.

    ``triangles`` (node, r) come from QRs of the nodes' rows.  While they are many, tasks
    decompose ``FAN`` of them stacked, which leaves fewer; the rest is stacked on the driver.
    """
    spark = triangles.sparkSession
    if count <= FAN or 8 * count * width * width <= TOP_BYTES:
        rows = sorted((r.node, np.frombuffer(r.r).reshape(-1, width)) for r in triangles.collect())
        q = np.linalg.qr(np.vstack([r for _, r in rows]))[0]
        ends = np.cumsum([0, *[len(r) for _, r in rows]])
        return spark.createDataFrame([(n, bytearray(np.ascontiguousarray(q[a:b]).tobytes())) for (n, _), a, b in zip(rows, ends, ends[1:])], "node int, t binary")
    above = F.expr(f"node div {FAN}").cast("int").alias("above")
    grouped = triangles.groupBy(above).agg(F.array_sort(F.collect_list(F.struct("node", "r"))).alias("own"))

    def stack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for above, own in zip(batch.column("above").to_pylist(), batch.column("own").to_pylist()):
                rows = [np.frombuffer(o["r"]).reshape(-1, width) for o in own]
                q, r = np.linalg.qr(np.vstack(rows))
                ends = np.cumsum([0, *map(len, rows)])
                parts = [np.ascontiguousarray(q[a:b]).tobytes() for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([above], pa.int32()), pa.array([r.tobytes()], pa.binary()), pa.array([[{"node": o["node"], "q": p} for o, p in zip(own, parts)]], pa.list_(pa.struct([("node", pa.int32()), ("q", pa.binary())])))], names=["node", "r", "own"])

    level = through_table(grouped.mapInArrow(stack, "node int, r binary, own array<struct<node:int,q:binary>>"), "triangles")
    higher = tree_factors(level.select("node", "r"), -(-count // FAN), width)

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, t in zip(batch.column("own").to_pylist(), batch.column("t").to_pylist()):
                t = np.frombuffer(t).reshape(-1, width)
                parts = [(np.frombuffer(o["q"]).reshape(-1, len(t)) @ t).tobytes() for o in own]
                yield pa.RecordBatch.from_arrays([pa.array([o["node"] for o in own], pa.int32()), pa.array(parts, pa.binary())], names=["node", "t"])

    return through_table(level.select("node", "own").join(higher, "node").mapInArrow(down, "node int, t binary"), "factors")


# Progress of a run


class Progress:
    """The state of an iteration below ``path``, saved after each pass.

    A pass counts once its row stands in ``done``, which is written last; what a broken run
    has written beyond that is not read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def last(self) -> int | None:
        """The last pass that has been saved."""
        try:
            return self.spark.read.schema("pass int").parquet(f"{self.path}/done").agg(F.max("pass")).head()[0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def save(self, number: int, blocks: LocalBlocks | TableBlocks) -> None:
        """What the next pass starts from."""
        at, spark = f"{self.path}/pass-{number}", self.spark
        if isinstance(blocks, TableBlocks):
            blocks.state.write.mode("overwrite").parquet(f"{at}/state")
        else:
            _ranges(spark, blocks.basis, "basis").join(_ranges(spark, blocks.image, "image"), "part").write.mode("overwrite").parquet(f"{at}/state")
        _ranges(spark, blocks.new, "x").write.mode("overwrite").parquet(f"{at}/new")
        small = blocks.small if isinstance(blocks, TableBlocks) else np.empty((0, 0))
        spark.createDataFrame([(blocks.columns, blocks.new.shape[1], bytearray(np.ascontiguousarray(small).tobytes()))], "columns int, width int, small binary").write.mode("overwrite").parquet(f"{at}/small")
        spark.createDataFrame([(number,)], "pass int").coalesce(1).write.mode("append").parquet(f"{self.path}/done")

    def load(self, number: int, blocks: LocalBlocks | TableBlocks) -> None:
        at, spark = f"{self.path}/pass-{number}", self.spark
        kept = spark.read.parquet(f"{at}/small").head()
        state = spark.read.parquet(f"{at}/state")
        new = _from_ranges(spark.read.parquet(f"{at}/new"), "x", blocks.n, kept.width)
        if isinstance(blocks, TableBlocks):
            blocks.state, blocks.columns = state, kept["columns"]
            blocks.small = np.frombuffer(bytes(kept.small)).reshape(kept["columns"], -1) if kept["columns"] else np.empty((0, 0))
        else:
            blocks.basis, blocks.image = (_from_ranges(state, c, blocks.n, kept["columns"]) for c in ("basis", "image"))
        blocks.new = new


def _ranges(spark: SparkSession, x: np.ndarray, name: str) -> DataFrame:
    size = max(1, RANGE_BYTES // max(1, 8 * x.shape[1]))
    rows = [(p, bytearray(np.ascontiguousarray(x[a : a + size]).tobytes())) for p, a in enumerate(range(0, len(x), size))]
    return spark.createDataFrame(rows, f"part int, {name} binary")


def _from_ranges(rows: DataFrame, name: str, n: int, columns: int) -> np.ndarray:
    found = sorted((r[0], r[1]) for r in rows.select("part", name).collect())
    return np.concatenate([np.frombuffer(bytes(x)) for _, x in found]).reshape(n, columns)
