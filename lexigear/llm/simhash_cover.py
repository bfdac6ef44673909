"""SimHash near-duplicates by anchor-point covering.

The anchors are the words of a covering code over 32 bits: the product of the Golay code
on 23 bits (covering radius 3), the Hamming code on 7 (radius 1) and all words on the last
2; every 32-bit word lies within 4 of an anchor, and 2**18 anchors cover them all.  Two
64-bit fingerprints that differ in at most 3 bits differ in at most 1 in their lower or
their upper half.  So for each half a fingerprint has one home, the anchor it decodes to,
and is replicated to the anchors within covering radius plus 1 that a change of one bit
can reach; a linked pair then meets at the home of either, in one half at least.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigear.llm.common import few, materialize, run_starts, runs, small, texts
from lexigear.llm.components import connected_components

SEED = 42
SHINGLE = 3
DISTANCE = 3
HOT_ROWS = 20_000  # rows of an anchor beyond which its pairs are dealt over several keys
PAIRS_AT_ONCE = 2_000_000


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of all word shingles; A-Z lowered, empty text gives 0."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - width + 1, 1)
    starts, ends = starts[:last].tolist(), ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), dtype="<u8", count=last)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, last, 8192):
        part = hashes[at : at + 8192].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << np.arange(64, dtype=np.uint64))[counts * 2 > last].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): one row per document; fp is the unsigned fingerprint as a signed long."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            fps = np.fromiter((fingerprint(t, width) for t in texts(batch.column(1))), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(of, "doc_id long, fp long")


# ---------------------------------------------------------------- the covering code

GOLAY = 0b101011100011  # generator polynomial of the binary Golay code of length 23
_TABLES: dict[str, np.ndarray] = {}


def _golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes by byte value and place, and the error of each of the 2,048 syndromes."""
    if not _TABLES:
        powers, x = [], 1
        for _ in range(23):
            powers.append(x)
            x <<= 1
            if x >> 11 & 1:
                x ^= GOLAY
        bits = np.array([*powers, 0], dtype=np.uint32)
        byte = np.arange(256, dtype=np.uint32)
        syndromes = np.zeros((3, 256), dtype=np.uint32)
        for place in range(3):
            for i in range(8):
                syndromes[place] ^= np.where(byte >> i & 1, bits[8 * place + i], 0).astype(np.uint32)
        errors = np.zeros(2048, dtype=np.uint32)
        flips = [1 << i for i in range(23)]
        for i in range(23):
            errors[powers[i]] = flips[i]
            for j in range(i):
                errors[powers[i] ^ powers[j]] = flips[i] | flips[j]
                for k in range(j):
                    errors[powers[i] ^ powers[j] ^ powers[k]] = flips[i] | flips[j] | flips[k]
        _TABLES["syndromes"], _TABLES["errors"] = syndromes, errors
    return _TABLES["syndromes"], _TABLES["errors"]


def anchor(half: np.ndarray) -> np.ndarray:
    """The anchor nearest to each 32-bit word (uint32 in, uint32 out)."""
    syndromes, errors = _golay_tables()
    low = half & np.uint32(0x7FFFFF)
    low = low ^ errors[syndromes[0][low & 255] ^ syndromes[1][low >> 8 & 255] ^ syndromes[2][low >> 16]]
    middle = half >> 23 & np.uint32(0x7F)
    wrong = np.zeros_like(middle)
    for i in range(7):
        wrong ^= np.where(middle >> i & 1, np.uint32(i + 1), np.uint32(0))
    middle = middle ^ np.where(wrong > 0, np.uint32(1) << np.maximum(wrong, 1).astype(np.uint32) - np.uint32(1), np.uint32(0)).astype(np.uint32)
    return (low | middle << np.uint32(23) | half & np.uint32(0xC0000000)).astype(np.uint32)


def replicas(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, home) of every anchor of every fingerprint; key holds the half in bit 32."""
    rows, keys, homes = [], [], []
    flips = np.concatenate(([0], np.uint32(1) << np.arange(32, dtype=np.uint32))).astype(np.uint32)
    for side in (0, 1):
        half = (fps >> np.uint64(32 * side) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        found = anchor((half[:, None] ^ flips[None, :]).ravel()).reshape(len(fps), -1)
        home = found[:, 0].copy()
        found.sort(axis=1)
        first = np.ones(found.shape, dtype=bool)
        first[:, 1:] = found[:, 1:] != found[:, :-1]
        row, at = np.nonzero(first)
        rows.append(row)
        keys.append(found[row, at].astype(np.int64) | side << 32)
        homes.append(found[row, at] == home[row])
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def covered(classes: DataFrame) -> DataFrame:
    """(key, home, fp, rep): every distinct fingerprint at all its anchors."""

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 5_000):
                part = batch.slice(at, 5_000)
                fp, rep = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                row, key, home = replicas(fp.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(home), pa.array(fp[row]), pa.array(rep[row])], names=["key", "home", "fp", "rep"])

    return classes.select("fp", "rep").mapInArrow(cover, "key long, home boolean, fp long, rep long")


# ---------------------------------------------------------------- pairs at an anchor


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links as stars: each end linked to the smallest end it reaches within them."""
    nodes, ends = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[label[moved]], nodes[moved]


HOME, OTHER = 1, 2


def links(cover: DataFrame, distance: int = DISTANCE, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(u, v): links between fingerprint classes, as stars of what each task has found.

    Home rows of an anchor are compared with all its rows.  An anchor with many rows is
    dealt over a square of keys: a row goes to the keys of its line as a home and to those
    of its column as the other side, so each pair still meets once and no key is large.
    """
    sizes = cover.groupBy("key").count().where(F.col("count") > hot_rows)
    parts = sizes.select("key", F.ceil(F.col("count") / hot_rows).cast("int").alias("parts"))
    dealt = cover.join(parts, "key", "left").withColumn("own", F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int"))
    whole = F.array(F.struct(F.lit(0).alias("row"), F.lit(0).alias("col"), F.when(F.col("home"), HOME + OTHER).otherwise(OTHER).alias("role")))
    steps = F.sequence(F.lit(0), F.col("parts") - 1)
    as_home = F.transform(steps, lambda i: F.struct(F.col("own").alias("row"), i.alias("col"), F.lit(HOME).alias("role")))
    as_other = F.transform(steps, lambda i: F.struct(i.alias("row"), F.col("own").alias("col"), F.lit(OTHER).alias("role")))
    places = F.when(F.col("parts").isNull(), whole).when(F.col("home"), F.concat(as_home, as_other)).otherwise(as_other)
    dealt = dealt.select("key", "fp", "rep", F.explode(places).alias("at")).select("key", "at.row", "at.col", "at.role", "fp", "rep")
    key = ["key", "row", "col"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, key):
            fp, rep, role = (table.column(c).to_numpy() for c in ("fp", "rep", "role"))
            starts = run_starts(table, key)
            own, others = np.flatnonzero(role & HOME), np.flatnonzero(role & OTHER)
            bucket = np.searchsorted(starts, own, side="right") - 1
            first = np.searchsorted(others, starts)[bucket]
            width = np.searchsorted(others, np.append(starts[1:], table.num_rows))[bucket] - first
            before = np.concatenate(([0], np.cumsum(width)))
            at = 0
            found: list[np.ndarray] = []
            while at < len(own):
                to = max(int(np.searchsorted(before, before[at] + PAIRS_AT_ONCE, side="right")) - 1, at + 1)
                n = width[at:to]
                left = np.repeat(own[at:to], n)
                right = others[np.arange(len(left)) + np.repeat(first[at:to] + before[at] - before[at:to], n)]
                near = np.bitwise_count((fp[left] ^ fp[right]).view(np.uint64)) <= distance
                near &= rep[left] != rep[right]
                if near.any():
                    found.append(np.stack(forest(rep[left[near]], rep[right[near]])))
                at = to
            if found:
                u, v = forest(*np.concatenate(found, axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    n = int(cover.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, *key).sortWithinPartitions(*key).mapInArrow(compare, "u long, v long")


# ---------------------------------------------------------------- the operator


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id): one row per document.

    Fingerprints of ``width`` words that differ in at most ``distance`` bits are linked.

    Null text counts as empty, and empty texts share fingerprint zero.  Equal fingerprints
    are one class, so a group of copies of any size is one row in the search.  A row
    without an id gets a fingerprint but links with nothing; its component_id is null.
    Rows that repeat an id each come back.
    """
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"the anchors find pairs of up to {DISTANCE} differing bits")
    prints = materialize(fingerprints(docs, id_col, text_col, width), "fingerprints")
    classes = materialize(prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    # an id that repeats with different texts stands for several fingerprints: they are one node
    found = materialize(connected_components(links(covered(classes), distance)), "components")
    labels = classes.join(found, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    out = prints.join(labels, "fp", "left")
    return out.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The documents without those linked to one of a smaller id; columns stay as they are.

    Rows without an id stay.  Of rows that repeat an id all stay or none.
    """
    found = near_duplicates(docs, id_col, text_col, width, distance)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id"))
    gone = materialize(gone.distinct(), "dropped")
    return docs.join(small(gone), docs[id_col] == gone["gone_id"], "left_anti")
