"""Merkle manifest of a dataset, with leaf coordinates from bitmap ranks.

Each group (a language) has a bitmap of its ids, merged by Spark from the bitmaps of its
tasks: words of 64 ids, of which only those that hold an id are kept.  Above the words stand
directories of popcounts, a node of each counting the ids of up to 32 or 2,048 nodes below.
The rank of an id, the number of ids before it, is what its directories say about the nodes
to its left, plus a popcount in its word.  So every leaf learns its place in its group by a
join with one word; rows are never sorted.

Places key the slots of the tree: 512 leaves share a key, each task puts their digests into
an array of slots and reduces it by three levels at once, and the digests that are left are
dealt the same way until each group has one.  Proofs go down again by the same keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigear.llm.common import materialize, run_starts, runs, small

FAN = 8
SLOTS = 512  # leaves of a key, three levels of the tree
WORD = 6  # bits of an id within a word
STEPS = (5, 11)  # bits of a place within the lowest directory, and within each one above
TIES = 4_096  # keys over which equal leaves of one id are dealt
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# ---------------------------------------------------------------- leaves


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]).cast("binary"), 256)


def lowered(text: Column) -> Column:
    """A-Z lowered, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(rows: DataFrame, fields: list[str], id_col: str, group_col: str, changed: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """(id, grp, leaf, other): ``other`` is the leaf of the row as ``changed``, where it is."""
    now = [F.col(f"`{f}`") for f in fields]
    other = digest([(changed or {}).get(f, c) for f, c in zip(fields, now)]) if changed else F.lit(None).cast("string")
    other = F.when(where, other) if where is not None else other
    return rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{group_col}`").cast("string").alias("grp"), F.unhex(digest(now)).alias("leaf"), F.unhex(other).alias("other"))


# ---------------------------------------------------------------- ranks

BIT = f"cast(id & {(1 << WORD) - 1} as int)"


def _same(left: str, right: str, keys: list[str]) -> Column:
    """Equality of the keys of two aliased tables, nulls being equal."""
    found = F.lit(True)
    for key in keys:
        found &= F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return found


def words(table: DataFrame) -> DataFrame:
    """(grp, word, bits, more, n): the bitmaps of each group's ids.

    ``n`` counts the rows of a word; ids that several rows share stand in ``more`` with the
    number of their further rows.
    """
    ids = table.where("id IS NOT NULL").select("grp", F.shiftright("id", WORD).alias("word"), "id")
    bits = F.bit_or(F.expr(f"shiftleft(1L, {BIT})")).alias("bits")
    found = materialize(ids.groupBy("grp", "word").agg(bits, F.count("*").alias("n")), "bitmap")
    repeated = materialize(found.where(F.bit_count("bits") < F.col("n")).select("grp", "word"), "repeated")
    if repeated.isEmpty():
        return found.withColumn("more", F.lit(None).cast("array<struct<at:int,n:bigint>>"))
    apart = ids.alias("a").join(small(repeated).alias("b"), _same("a", "b", ["grp", "word"]), "left_semi")
    # written out, so that the grouping can't keep the join from splitting an id of many rows
    counted = materialize(apart, "repeated").groupBy("grp", "word", "id").agg(F.count("*").alias("n")).where("n > 1")
    entry = F.struct(F.expr(BIT).alias("at"), (F.col("n") - 1).alias("n"))
    more = counted.groupBy("grp", "word").agg(F.collect_list(entry).alias("more"))  # 64 ids at most
    out = found.alias("a").join(small(materialize(more, "repeated")).alias("b"), _same("a", "b", ["grp", "word"]), "left")
    return materialize(out.select("a.grp", "a.word", "bits", "n", "more"), "bitmap")


def ranked(bitmap: DataFrame) -> DataFrame:
    """The bitmap with ``before``, the rows of their group in lower words, by directories."""
    low, high = bitmap.agg(F.min("word"), F.max("word")).first()
    levels, steps = [bitmap.select("grp", F.col("word").alias("at"), "n")], []
    while low is not None and (not steps or high - low >= 1 << STEPS[1]):
        steps.append(STEPS[1] if steps else STEPS[0])
        low, high = low >> steps[-1], high >> steps[-1]
        up = levels[-1].groupBy("grp", F.shiftright("at", steps[-1]).alias("at")).agg(F.sum("n").alias("n"))
        levels.append(materialize(up, "directory"))
    # rows to the left of a node: within its parent a running sum, else those left of the parent
    ahead = F.sum("n").over(Window.partitionBy("grp", "parent").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    above = None
    for level, step in reversed([*zip(levels, [*steps, None])]):
        parent = F.lit(0).cast("long") if step is None else F.shiftright("at", step)
        now = level.withColumn("parent", parent).withColumn("ahead", F.coalesce(ahead, F.lit(0)))
        if above is not None:
            up = small(above.select("grp", F.col("at").alias("parent"), "before"))
            now = now.alias("a").join(up.alias("b"), _same("a", "b", ["grp", "parent"])).select("a.grp", "at", (F.col("ahead") + F.col("before")).alias("ahead"))
        above = materialize(now.select("grp", "at", F.col("ahead").alias("before")), "directory")
    out = bitmap.alias("a").join(above.select("grp", F.col("at").alias("word"), "before").alias("b"), _same("a", "b", ["grp", "word"]))
    return materialize(out.select("a.grp", "a.word", "bits", "more", "before"), "ranks")


def rank() -> Column:
    """The rows with an id below ``id``, from ``bits``, ``more`` and ``before`` of its word."""
    left = F.expr(f"cast(bit_count(bits & ~shiftleft(-1L, {BIT})) as long)")
    more = F.expr(f"coalesce(aggregate(filter(more, x -> x.at < {BIT}), 0L, (s, x) -> s + x.n), 0L)")
    return F.col("before") + left + more


def tie_places(tied: DataFrame) -> DataFrame:
    """(row, place): places of the rows of each (grp, id), by leaf, counted from 0.

    Leaves are dealt by their first digits and equal ones over ``TIES`` keys, so one id, or
    no id, may hold any share of the rows.
    """
    key = ["grp", "id", "head"]
    rows = tied.select("row", "grp", "id", F.substring("leaf", 1, 2).alias("head"), "leaf", F.pmod(F.xxhash64("row"), F.lit(TIES)).alias("salt"))
    counts = materialize(rows.groupBy(*key, "leaf", "salt").agg(F.count("*").alias("n")), "ties")

    def ahead(by: list[str], order: list[str]) -> Column:
        return F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    heads = counts.groupBy(*key).agg(F.sum("n").alias("n"))  # 65,536 of an id at most
    heads = materialize(heads.select(*key, ahead(["grp", "id"], ["head"]).alias("base")), "ties")
    starts = counts.select(*key, "leaf", "salt", ahead(key, ["leaf", "salt"]).alias("start"))
    starts = starts.alias("a").join(small(heads).alias("b"), _same("a", "b", key)).select("a.grp", "a.id", "leaf", "salt", (F.col("start") + F.col("base")).alias("start"))
    number = F.row_number().over(Window.partitionBy("grp", "id", "leaf", "salt").orderBy("row")) - 1
    numbered = materialize(rows.select("row", "grp", "id", "leaf", "salt", number.alias("number")), "ties")
    both = numbered.alias("a").join(materialize(starts, "ties").alias("b"), _same("a", "b", ["grp", "id", "leaf", "salt"]))
    return materialize(both.select("row", (F.col("start") + F.col("number")).alias("place")), "ties")


def placed(table: DataFrame, ranks: DataFrame) -> DataFrame:
    """``table`` with ``at``, the place of each row in its group, and ``size`` of the group.

    Rows without an id come first; rows that share an id follow one another by leaf.
    """
    sizes = table.groupBy("grp").agg(F.count("*").alias("size"), F.count_if(F.col("id").isNull()).alias("nulls"))
    side = ranks.withColumnRenamed("grp", "g")
    joined = table.join(side, F.col("grp").eqNullSafe(F.col("g")) & (F.shiftright("id", WORD) == F.col("word")), "left").alias("a")
    joined = joined.join(small(materialize(sizes, "sizes")).alias("b"), _same("a", "b", ["grp"]))
    at = F.when(F.col("id").isNull(), F.lit(0).cast("long")).otherwise(F.col("nulls") + rank())
    shares = F.col("id").isNull() | F.expr(f"coalesce(exists(more, x -> x.at = {BIT}), false)")
    base = materialize(joined.select("row", "id", "a.grp", "leaf", "other", at.alias("at"), "size", shares.alias("shares")), "placed")
    tied = base.where("shares")
    if tied.isEmpty():
        return base.drop("shares")
    ties = tie_places(tied).withColumnRenamed("row", "r")
    whole = base.join(ties, F.col("row") == F.col("r"), "left")
    return materialize(whole.select("row", "id", "grp", "leaf", "other", (F.col("at") + F.coalesce("place", F.lit(0))).alias("at"), "size"), "placed")


# ---------------------------------------------------------------- the tree

Steps = list[tuple[bytes, bytes]]  # of each level up: the siblings before and those after, joined
STEPS_TYPE = "array<struct<before:binary,after:binary>>"
STEPS_ARROW = pa.list_(pa.struct([("before", pa.binary()), ("after", pa.binary())]))
KEY = ["grp", "key"]


def level_up(level: list[bytes]) -> list[bytes]:
    """The digests, raw, of the runs of nodes; a digest enters as hex text."""
    return [hashlib.sha256(b"".join(level[i : i + FAN]).hex().encode()).digest() for i in range(0, len(level), FAN)]


def tree(level: list[bytes], whole: bool) -> list[list[bytes]]:
    """The levels above and with ``level``: to one node if it is a whole group, else three up."""
    levels = [level]
    while len(levels[-1]) > 1 if whole else len(levels) <= 3:
        levels.append(level_up(levels[-1]))
    return levels


def siblings(levels: list[list[bytes]], i: int) -> Steps:
    """The siblings of node ``i`` of the lowest level and of the nodes above it."""
    steps = []
    for level in levels[:-1]:
        first = i - i % FAN
        steps.append((b"".join(level[first:i]), b"".join(level[i + 1 : first + FAN])))
        i //= FAN
    return steps


def fold(leaf: bytes, steps: Steps) -> bytes:
    """The root that follows from ``leaf`` and its siblings, level by level."""
    for before, after in steps:
        leaf = hashlib.sha256((before + leaf + after).hex().encode()).digest()
    return leaf


def proof(steps: Steps) -> bytes:
    """The digest of all siblings, from the lowest level up."""
    return hashlib.sha256(b"".join(before + after for before, after in steps).hex().encode()).digest()


def _steps(rows: list[Steps]) -> pa.Array:
    return pa.array([[{"before": b, "after": a} for b, a in s] for s in rows], STEPS_ARROW)


def _slots(nodes: DataFrame, *more: str) -> DataFrame:
    return nodes.select("grp", F.expr(f"at div {SLOTS}").alias("key"), F.expr(f"cast(at % {SLOTS} as int)").alias("slot"), (F.col("size") <= SLOTS).alias("whole"), "leaf", *more)


def _by_key(rows: DataFrame) -> DataFrame:
    """The rows of a key, 512 slots and one more at most, together."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, *KEY).sortWithinPartitions(*KEY)


def _slot_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[bytes]]]:
    """(rows of one key, digests by slot); a row without a slot stands for what is above."""
    for table in runs(batches, KEY, 4 * SLOTS):
        starts = [*run_starts(table, KEY).tolist(), table.num_rows]
        for a, b in zip(starts, starts[1:]):
            part = table.slice(a, b - a)
            digests = {s: d for s, d in zip(part.column("slot").to_pylist(), part.column("leaf").to_pylist()) if s is not None}
            yield part, [digests[s] for s in range(len(digests))]


def _together(batches: Iterator[pa.RecordBatch], rows: int = 2_000) -> Iterator[pa.RecordBatch]:
    """Small batches put together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def reduced(nodes: DataFrame) -> DataFrame:
    """(grp, at, size, leaf, whole): a node for each key, three levels up or its group's top."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, slots in _slot_arrays(batches):
            whole = part.column("whole")[0].as_py()
            yield pa.RecordBatch.from_arrays([part.column("grp").combine_chunks()[:1], part.column("key").combine_chunks()[:1], pa.array(tree(slots, whole)[-1], pa.binary()), pa.array([whole])], names=["grp", "at", "leaf", "whole"])

    up = _by_key(_slots(nodes)).mapInArrow(lambda b: _together(reduce(b)), "grp string, at long, leaf binary, whole boolean")
    sizes = nodes.where("at = 0").select("grp", F.expr(f"(size + {SLOTS - 1}) div {SLOTS}").alias("size"))
    up = materialize(up, "tier").alias("a").join(small(materialize(sizes, "sizes")).alias("b"), _same("a", "b", ["grp"]))
    return materialize(up.select("a.grp", "at", "size", "leaf", "whole"), "tier")


def key_paths(nodes: DataFrame) -> DataFrame:
    """(grp, key, top, steps): for each key of ``nodes``, its group's top and the siblings
    from the node it reduces to up to that."""
    up = reduced(nodes)
    nothing = F.array().cast(STEPS_TYPE)
    ready = up.where("whole").select("grp", F.col("at").alias("key"), F.col("leaf").alias("top"), nothing.alias("steps"))
    left = up.where("NOT whole")
    if left.isEmpty():
        return ready
    return ready.unionByName(node_paths(left).withColumnRenamed("at", "key"))


def node_paths(nodes: DataFrame) -> DataFrame:
    """(grp, at, top, steps) of each of ``nodes`` (grp, at, size, leaf), written out."""

    def join(part: pa.Table, slots: list[bytes], top: bytes, levels: list[list[bytes]], above: Steps) -> Iterator[pa.RecordBatch]:
        found = [siblings(levels, s) + above for s in range(len(slots))]
        at = pa.array([part.column("key")[0].as_py() * SLOTS + s for s in range(len(slots))], pa.int64())
        grp = pa.array([part.column("grp")[0].as_py()] * len(slots), pa.string())
        yield pa.RecordBatch.from_arrays([grp, at, pa.array([top] * len(slots), pa.binary()), _steps(found)], names=["grp", "at", "top", "steps"])

    return materialize(down(nodes, key_paths(nodes), join, f"grp string, at long, top binary, steps {STEPS_TYPE}"), "paths")


def down(nodes: DataFrame, paths: DataFrame, work: Callable, schema: str, *more: str) -> DataFrame:
    """``work`` on the slots of each key together with the path above it, one shuffle."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, slots in _slot_arrays(batches):
            here = part.column("slot").is_valid()
            above = part.filter(pc.invert(here))
            steps = [(s["before"], s["after"]) for s in above.column("steps")[0].as_py()]
            part = part.filter(here)
            yield from work(part, slots, above.column("top")[0].as_py(), tree(slots, part.column("whole")[0].as_py()), steps)

    rows = _slots(nodes, *more).unionByName(paths.select(*KEY, "top", "steps"), allowMissingColumns=True)
    return _by_key(rows).mapInArrow(lambda b: _together(each(b)), schema)


def numbered(groups: DataFrame) -> DataFrame:
    """``groups`` (grp, top) with ``at``, their place by name: null first, then by bytes."""
    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(groups.repartitionByRange(n, F.asc_nulls_first("grp")).withColumn("part", F.spark_partition_id()), "groups")
    parts = dealt.groupBy("part").agg(F.count("*").alias("n"))  # as many rows as partitions
    ahead = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("part").orderBy(F.asc_nulls_first("grp"))) - 1
    out = dealt.withColumn("within", within).join(small(materialize(parts.select("part", ahead.alias("ahead")), "groups")), "part")
    return materialize(out.select("grp", "top", (F.col("ahead") + F.col("within")).alias("at")), "groups")


# ---------------------------------------------------------------- the operator


@dataclass
class Manifest:
    """Written tables of a dataset's tree.

    ``ranks``: the bitmap index (grp, word, bits, more, before).  ``nodes``: its leaves (row,
    id, grp, at, size, leaf, other).  ``paths``: for each key of 512 leaves (grp, key, top,
    root, steps).  ``subroots``: (grp, at, top).  ``root``: hex, or None of an empty dataset.
    """

    ranks: DataFrame
    nodes: DataFrame
    paths: DataFrame
    subroots: DataFrame
    root: str | None


def build(rows: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang", changed: dict[str, Column] | None = None, where: Column | None = None) -> Manifest:
    """The manifest of ``rows``: leaves of ``fields``, by ``id_col`` within ``group_col``.

    With ``changed``, a second leaf is kept of the rows for which ``where`` holds, as they
    are with those columns in place of theirs; ``proofs`` folds that one.

    A null group is a group, the first.  Rows without an id come before all others of their
    group; they, and rows that share an id, stand in the order of their leaves.  Ids may be
    any integers.  An empty dataset has no root.  Other columns do not matter.
    """
    table = leaves(rows, list(fields), id_col, group_col, changed, where).withColumn("row", F.monotonically_increasing_id())
    table = materialize(table, "leaves")
    ranks = ranked(words(table))
    nodes = placed(table, ranks)
    paths = materialize(key_paths(nodes), "paths")
    subroots = numbered(paths.where("key = 0").select("grp", "top"))
    upper = subroots.select(F.lit(None).cast("string").alias("grp"), "at", F.lit(subroots.count()).alias("size"), F.col("top").alias("leaf"))
    upper = node_paths(upper).select("at", F.col("top").alias("root"), F.col("steps").alias("more"))
    ends = materialize(subroots.join(small(upper), "at").select("grp", "root", "more"), "ends")
    whole = paths.alias("a").join(small(ends).alias("b"), _same("a", "b", ["grp"]))
    paths = materialize(whole.select("a.grp", "key", "top", "root", F.concat("steps", "more").alias("steps"), F.size("steps").alias("below")), "paths")
    first = ends.select("root").first()
    return Manifest(ranks, nodes, paths, subroots, None if first is None else first.root.hex())


def proofs(manifest: Manifest) -> DataFrame:
    """(id, grp, at, leaf, subroot, root, proof_sha256, folded_root, verified) of each row.

    ``folded_root`` follows from the row's siblings and its second leaf, where it has one,
    else its own; digests are hex.
    """
    names = ["id", "grp", "at", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def prove(part: pa.Table, slots: list[bytes], top: bytes, levels: list[list[bytes]], above: Steps) -> Iterator[pa.RecordBatch]:
        root = fold(slots[0], siblings(levels, 0) + above)
        key, done = part.column("key")[0].as_py(), []
        for slot, other in zip(part.column("slot").to_pylist(), part.column("other").to_pylist()):
            steps = siblings(levels, slot) + above
            end = root if other is None else fold(other, steps)
            done.append((key * SLOTS + slot, slots[slot].hex(), top.hex(), root.hex(), proof(steps).hex(), end.hex(), end == root))
        kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
        columns = [pa.array(c, kind) for c, kind in zip(zip(*done), kinds)]
        yield pa.RecordBatch.from_arrays([part.column("id").combine_chunks(), part.column("grp").combine_chunks(), *columns], names=names)

    schema = "id long, grp string, at long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return down(manifest.nodes, manifest.paths.drop("root", "below"), prove, schema, "id", "other")


def look_up(manifest: Manifest, wanted: DataFrame) -> DataFrame:
    """(grp, id, at): places of the (grp, id) of ``wanted`` from the index alone, the first
    of rows that share an id; null for ids that the dataset lacks."""
    nulls = manifest.nodes.where("id IS NULL").groupBy("grp").agg(F.count("*").alias("nulls"))
    side = manifest.ranks.withColumnRenamed("grp", "g")
    joined = wanted.select("grp", "id").join(side, F.col("grp").eqNullSafe(F.col("g")) & (F.shiftright("id", WORD) == F.col("word")), "left").alias("a")
    joined = joined.join(nulls.alias("b"), _same("a", "b", ["grp"]), "left")
    there = F.expr(f"(shiftright(bits, {BIT}) & 1L) = 1L")
    return joined.select("a.grp", "id", F.when(there, rank() + F.coalesce("nulls", F.lit(0))).alias("at"))
