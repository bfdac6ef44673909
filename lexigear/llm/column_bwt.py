"""Removal of long repeated strings by a column-wise, multi-document construction.

Every window of 200 bytes is assigned to its anchor, the 64-byte string inside it whose
hash is smallest; equal windows have equal anchors at equal places.  Anchors whose hash
occurs once in the corpus are done: no window of theirs repeats.  The windows of each
other anchor form one excerpt, and the excerpts of one hash, aligned at the anchor, are a
small collection of strings.

For these collections the Burrows-Wheeler order and the common prefixes are built column by
column: each round takes one symbol further left from every excerpt, moves the excerpts to
the order of their suffixes that now begin there (a stable sort by the new symbol, as in
the insertion of a symbol into the transform), and updates the common prefixes of
neighbours by range minima.  Only suffixes of one column are kept, since windows can only
repeat at the same place from the anchor; so a round costs as much as it has excerpts, and
336 rounds do for documents of any length.  Wherever neighbours share 200 symbols, their
windows repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigear.llm.common import few, materialize, run_starts, runs

WIDTH = 200
GRAM = 64
REACH = WIDTH - GRAM + 1  # anchors that a window chooses from
BLOCK = 1 << 20  # bytes handled at a time
HOT_ROWS = 20_000  # different excerpts of one key beyond which the key is divided
BLOCKS = (16, 1)  # places from the anchor that share a key, when it is divided once and twice
SHIPPED = 1_000_000  # entries of a table up to which it is broadcast

_SEEDS = np.random.default_rng(64).integers(1, 1 << 63, size=256, dtype=np.uint64)
_FACTORS = np.random.default_rng(65).integers(1, 1 << 63, size=8, dtype=np.uint64) | np.uint64(1)
_PLACE = np.uint64(BLOCK - 1)


# ---------------------------------------------------------------- anchors


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every 64-byte string, from those of half the length."""
    h, size = _SEEDS[data], 1
    for factor in _FACTORS[:6]:
        h = h[:-size] * factor + h[size:]
        size *= 2
    h ^= h >> np.uint64(31)
    h *= _FACTORS[7]
    h ^= h >> np.uint64(29)
    return h


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, place, first window, last window) of the anchors of documents that
    lie one after another in ``data``, at most 2**20 bytes; windows across ends are left out."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < WIDTH:
        return none, none, none, none, none
    h = gram_hashes(data)
    lowest = window_minima(h & ~_PLACE | np.arange(len(h), dtype=np.uint64), REACH)
    place = (lowest & _PLACE).astype(np.int64)
    window = np.arange(len(place))
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[: len(place)]
    inside = window + WIDTH <= ends[doc]
    first = inside.copy()
    first[1:] &= (place[1:] != place[:-1]) | ~inside[:-1] | (doc[1:] != doc[:-1])
    last = inside.copy()
    last[:-1] &= (place[1:] != place[:-1]) | ~inside[1:] | (doc[1:] != doc[:-1])
    first, last = np.flatnonzero(first), np.flatnonzero(last)
    return doc[first], h[place[first]].view(np.int64), place[first], first, last


def excerpts(found: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``anchors`` of many documents, with places inside each document."""
    at = 0
    while at < len(found):
        to, size = at, 0
        while to < len(found) and (to == at or size + len(found[to]) <= BLOCK):
            size += len(found[to])
            to += 1
        if size <= BLOCK:
            ends = np.cumsum([len(x) for x in found[at:to]])
            data = np.frombuffer(b"".join(found[at:to]), dtype=np.uint8)
            doc, h, place, first, last = anchors(data, ends)
            begin = np.concatenate(([0], ends[:-1]))[doc] if len(doc) else doc
            yield doc + at, h, place - begin, first - begin, last - begin
        else:
            data = np.frombuffer(found[at], dtype=np.uint8)
            for start in range(0, len(data) - WIDTH + 1, BLOCK - WIDTH + 1):
                part = data[start : start + BLOCK]
                doc, h, place, first, last = anchors(part, np.array([len(part)]))
                yield doc + at, h, place + start, first + start, last + start
        at = to


# ---------------------------------------------------------------- the construction

COLUMNS = REACH - 1 + WIDTH
PAD = 0xFF  # no byte of UTF-8


def aligned(bodies: list[bytes], far: np.ndarray) -> np.ndarray:
    """Excerpts as rows of a matrix, the anchor's first byte in column REACH - 1."""
    rows = np.full((len(bodies), COLUMNS), PAD, dtype=np.uint8)
    for row, body, begin in zip(rows, bodies, (REACH - 1 - far).tolist()):
        row[begin : begin + len(body)] = np.frombuffer(body, dtype=np.uint8)
    return rows


def repeated(rows: np.ndarray, group: np.ndarray, far: np.ndarray, near: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(furthest, nearest) place before the anchor at which an excerpt's window repeats, -1
    for none.  ``rows`` are sorted by ``group``; windows of row i begin near[i]..far[i]
    bytes before its anchor, and the row stands for copies[i] excerpts.
    """
    n = len(rows)
    symbols = np.ascontiguousarray(rows.T)
    order = np.arange(n)
    shared = np.zeros(n + 1, dtype=np.int64)  # symbols that order[i] shares with order[i - 1]
    furthest, nearest = np.full(n, -1), np.full(n, -1)
    base = group.astype(np.int64) * 256
    for column in range(COLUMNS - 1, -1, -1):
        key = base[order] + symbols[column][order]
        move = np.argsort(key, kind="stable")
        key = key[move]
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        now = np.zeros(n + 1, dtype=np.int64)
        a, b = move[same - 1], move[same]
        next_to = b == a + 1
        now[same[next_to]] = shared[b[next_to]] + 1
        if not next_to.all():
            a, b = a[~next_to], b[~next_to]
            ranges = np.stack((a + 1, b + 1), axis=1).ravel()
            now[same[~next_to]] = np.minimum.reduceat(shared, ranges)[::2] + 1
        shared = np.minimum(now, WIDTH)
        order = order[move]
        place = REACH - 1 - column
        if place >= 0:
            kind = np.cumsum(shared[:n] < WIDTH)
            often = np.bincount(kind, weights=copies[order])[kind] > 1
            hit = order[often]
            hit = hit[(near[hit] <= place) & (place <= far[hit])]
            furthest[hit] = place
            nearest[hit] = np.where(nearest[hit] < 0, place, nearest[hit])
    return furthest, nearest


# ---------------------------------------------------------------- the operator


def shipped(df: DataFrame, entries: int) -> DataFrame:
    """A broadcast hint for a written table of so many entries, if they are few."""
    return F.broadcast(df) if entries <= SHIPPED else df


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row, text): rows of equal id and text share ``row``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col).cast("long"), text).alias("row"), text.alias("text"))


def anchor_hashes(rows: DataFrame) -> DataFrame:
    """(hash, row): every anchor of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            row = batch.column(0).to_numpy()
            for doc, h, *_ in excerpts([t.encode() for t in batch.column(1).to_pylist()]):
                if len(doc):
                    yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(row[doc])], names=["hash", "row"])

    return rows.select("row", "text").mapInArrow(work, "hash long, row long")


def cut_excerpts(rows: DataFrame) -> DataFrame:
    """(hash, excerpt, doc_id, row, place, far, near, body) for the anchors in a row's
    ``hashes``; a task writes the body of an excerpt once or a few times, not for each copy."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written: set[bytes] = set()
        for batch in few(batches):
            data = [t.encode() for t in batch.column(2).to_pylist()]
            wanted = [np.array(x, dtype=np.int64) for x in batch.column(3).to_pylist()]
            doc_id, row = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc, h, place, first, last in excerpts(data):
                out: list[tuple] = []
                edges = np.append(np.flatnonzero(np.diff(doc, prepend=-1)), len(doc))
                for a, b in zip(edges, edges[1:]):
                    d = int(doc[a])
                    text = data[d]
                    hit = np.flatnonzero(np.isin(h[a:b], wanted[d])) + a
                    for anchor, p, s, e in zip(h[hit].tolist(), place[hit].tolist(), first[hit].tolist(), last[hit].tolist()):
                        body = text[s : e + WIDTH]
                        name = xxhash.xxh3_128_digest(body, p - s)
                        new = name not in written
                        if new:
                            if len(written) >= 500_000:
                                written.clear()
                            written.add(name)
                        out.append((anchor, name, doc_id[d], row[d], p, p - s, p - e, body if new else None))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    names = ["hash", "excerpt", "doc_id", "row", "place", "far", "near", "body"]
    types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return rows.select("doc_id", "row", "text", "hashes").mapInArrow(work, "hash long, excerpt binary, doc_id long, row long, place long, far int, near int, body binary")


def divided(parts: DataFrame, places: int) -> DataFrame:
    """Excerpts cut so that a key holds the windows of ``places`` neighbouring places that
    agree in all bytes which these windows have in common."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, excerpt, far, near, copies, body in zip(*(batch.column(c).to_pylist() for c in names)):
                for block in range(near // places, far // places + 1):
                    low, high = max(near, block * places), min(far, block * places + places - 1)
                    core = body[far - block * places : far - block * places + WIDTH - places + 1] if block * places <= far else b""
                    new = xxhash.xxh3_64_intdigest(core, key + block & (1 << 63) - 1) - (1 << 63)
                    out.append((new, excerpt, high, low, copies, body[far - high : far - low + WIDTH]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    names = ["key", "excerpt", "far", "near", "copies", "body"]
    types = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    schema = "key long, excerpt binary, far int, near int, copies long, body binary"
    return parts.select(*names).mapInArrow(work, schema)


def construct(parts: DataFrame) -> DataFrame:
    """(excerpt, furthest, nearest) of excerpts with windows that repeat within their key."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["key"], 8_000):
            starts = run_starts(table, ["key"])
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
            far, near, copies = (table.column(c).to_numpy() for c in ("far", "near", "copies"))
            # a key with one excerpt that is no copy has nothing to compare
            alone = (np.bincount(group, weights=copies) < 2)[group]
            rest = np.flatnonzero(~alone)
            if not len(rest):
                continue
            bodies = table.column("body").take(pa.array(rest)).to_pylist()
            furthest, nearest = repeated(aligned(bodies, far[rest]), group[rest], far[rest], near[rest], copies[rest])
            hit = np.flatnonzero(furthest >= 0)
            yield pa.RecordBatch.from_arrays([table.column("excerpt").take(pa.array(rest[hit])).combine_chunks(), pa.array(furthest[hit]), pa.array(nearest[hit])], names=["excerpt", "furthest", "nearest"])

    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = parts.select("key", "excerpt", "far", "near", "copies", "body").repartition(n, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(work, "excerpt binary, furthest long, nearest long")


def repeats(parts: DataFrame, hot_rows: int = HOT_ROWS, blocks: tuple[int, ...] = BLOCKS) -> DataFrame:
    """``construct``, after dividing keys of many excerpts until none is left or a key's
    excerpts are single windows, all alike."""
    done: list[DataFrame] = []
    for places in blocks:
        hot = materialize(parts.groupBy("key").count().where(F.col("count") > hot_rows).select("key"), "hot-keys")
        if hot.isEmpty():
            break
        done.append(parts.join(hot, "key", "left_anti"))
        cut = divided(parts.join(hot, "key", "left_semi"), places)
        if places == 1:
            # single windows: equal ones are one row, however many excerpts they come from
            owners = materialize(cut, "windows")
            windows = owners.groupBy("key", "far", "near", "body").agg(F.sum("copies").alias("copies"))
            often = construct(windows.withColumn("excerpt", F.col("body"))).select(F.col("excerpt").alias("window"), F.col("furthest").alias("at"))
            hit = owners.join(often, (owners["body"] == often["window"]) & (owners["far"] == often["at"]), "left_semi")
            done = [construct(d) for d in done]
            return _merged([*done, hit.select("excerpt", F.col("far").cast("long").alias("furthest"), F.col("near").cast("long").alias("nearest"))])
        parts = materialize(cut, "divided")
    return _merged([*(construct(d) for d in done), construct(parts)])


def _merged(found: list[DataFrame]) -> DataFrame:
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("excerpt").agg(F.max("furthest").alias("furthest"), F.min("nearest").alias("nearest"))


def repeated_spans(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, row, spans): windows that repeat, joined where an excerpt's overlap, by document.

    ``rows`` come from ``keyed``.
    """
    every = materialize(anchor_hashes(rows), "anchors")
    # written out, so that the join below can split a hash that holds many rows
    often = materialize(every.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "often")
    hits = materialize(every.join(often, "hash").groupBy("row").agg(F.collect_set("hash").alias("hashes")), "hits")
    entries = hits.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0)), F.count("*")).first()
    near = rows
    if entries[0] > SHIPPED and entries[1] <= SHIPPED:
        near = rows.join(F.broadcast(hits.select("row")), "row", "left_semi")  # only these need be shuffled
    cut = materialize(cut_excerpts(near.join(shipped(hits, entries[0]), "row")), "excerpts")
    parts = cut.groupBy(F.col("hash").alias("key"), "excerpt").agg(F.count("*").alias("copies"), F.max("body").alias("body"), F.max("far").alias("far"), F.max("near").alias("near"))
    found = materialize(repeats(materialize(parts, "parts"), hot_rows), "repeats")
    placed = cut.select("excerpt", "doc_id", "row", "place").join(found, "excerpt")
    span = F.struct((F.col("place") - F.col("furthest")).alias("start"), (F.col("place") - F.col("nearest") + WIDTH).alias("end"))
    return placed.groupBy("doc_id", "row").agg(F.collect_set(span).alias("spans"))


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes; runs that touch are one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, spans, kept): one row per document.

    ``kept`` holds the bytes of the text that no repeated 200-byte string covers, ``spans``
    the removed runs.  Null text counts as empty.  Rows of the same id and text are copies
    of each other like any others.
    """
    rows = keyed(docs, id_col, text_col)
    spans = materialize(repeated_spans(rows, hot_rows), "spans")
    entries = spans.agg(F.coalesce(F.sum(F.size("spans")), F.lit(0)), F.count("*")).first()
    renamed = spans.select(F.col("doc_id").alias("its_id"), F.col("row").alias("its_row"), "spans")
    same = (F.col("row") == F.col("its_row")) & F.col("doc_id").eqNullSafe(F.col("its_id"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches, 100):
            out = []
            for doc, text, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.encode()
                runs_ = joined([(s["start"], s["end"]) for s in found])
                at, kept = 0, []
                for start, end in runs_:
                    kept.append(data[at:start])
                    at = end
                kept.append(data[at:])
                rest = b"".join(kept)
                out.append({"doc_id": doc, "n_bytes": len(data), "n_removed": len(data) - len(rest), "n_spans": len(runs_), "spans": [{"start": a, "end": b} for a, b in runs_], "kept": rest})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    arrow = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.list_(pair)), ("kept", pa.binary())])
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, end: long>>, kept binary"
    whole = ["doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.array().cast("array<struct<start: long, end: long>>").alias("spans"), F.col("text").cast("binary").alias("kept")]
    if entries[1] <= SHIPPED:
        keys = F.broadcast(renamed.select("its_id", "its_row"))
        cut = rows.join(keys, same, "left_semi").join(shipped(renamed, entries[0]), same)
        return cut.select("doc_id", "text", "spans").mapInArrow(work, schema).unionByName(rows.join(keys, same, "left_anti").select(*whole))
    return rows.join(renamed, same, "left").select("doc_id", "text", F.coalesce("spans", F.array().cast("array<struct<start: long, end: long>>"))).mapInArrow(work, schema)
