"""Packing of tokenized documents into sequences: best fit, then swap-based local search."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexigear.llm.common import few, materialize, texts

CAPACITY = 1024
END = 2
GROUP = 16_384  # pieces that one local search sees; a corpus has as many searches as it needs
LONG = 200_000  # characters beyond which the slower, stackless tokenizer is used
UNSURE = re.compile("[^\\x00-\\u2fff]")  # characters not compared one by one between the two encoders

# ---------------------------------------------------------------- ids

#: Fixed value: the pattern by which byte-level vocabularies split text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Encoder:
    """Ids of a byte-level vocabulary file, as the tokenizers library gives them.

    The rank-based encoder runs the same merges about five times as fast.  It is used only
    where the two cannot differ: texts without the strings of special tokens, of ordinary
    length, in which neither library's tables disagree about a character's class.
    """

    def __init__(self, path: str) -> None:
        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec["added_tokens"]]
        letters = byte_alphabet()
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if len(text) > LONG or any(s in text for s in self.special) or UNSURE.search(text):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full ones, after a shorter first one."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and the end id.

    Null text counts as empty: one piece that holds the end id alone.  Documents longer
    than ``capacity`` are cut; others are never.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        for batch in few(batches):
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                ids = array("I", encode(text))
                ids.append(end)
                data = memoryview(ids.tobytes())
                for i, (at, n) in enumerate(cuts(len(ids), capacity)):
                    row = (doc, i, at, n, zlib.crc32(data[4 * at : 4 * (at + n)]))
                    rows.append((*row, ids[at : at + n].tolist()) if with_ids else row)
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=arrow) if with_ids else pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)

    arrow = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids)
    names = arrow.names
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(cut, schema)


# ---------------------------------------------------------------- bins


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of lengths: longest first, each into the bin that it leaves with least room."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r is set if some bin has r left
    for n in sorted(lengths, reverse=True):
        fitting = open_rooms >> n
        if fitting:
            r = n + (fitting & -fitting).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_rooms ^= 1 << r
            bins[b].append(n)
            r -= n
        else:
            b, r = len(bins), capacity - n
            bins.append([n])
        room[r].append(b)
        open_rooms |= 1 << r
    return bins


class Search:
    """Local search over underfull bins.

    Bins are taken from the fullest down.  Each draws from bins that are no fuller: it
    takes a document, exchanges one for a longer one, one for two, or two for one, always
    the exchange that closes most of its gap.  Every step raises the sum of squared fills,
    so the search ends; emptier bins lose until they are empty.
    """

    def __init__(self, bins: list[list[int]], capacity: int) -> None:
        self.capacity = capacity
        self.items = [Counter(b) for b in bins]
        self.fill = [sum(b) for b in bins]
        self.holders: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.lengths = 0  # bit n is set if holders[n] may have a bin
        self.pairs: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
        self.sums = 0
        self.left = [False] * len(bins)  # bins that have had their turn this round

    def offer(self, b: int, n: int) -> None:
        self.holders[n].append(b)
        self.lengths |= 1 << n

    def holder(self, most: int, least: int, a: int) -> tuple[int, int] | None:
        """(bin, n): a bin no fuller than ``a`` with the longest n in least..most."""
        while (mask := self.lengths & (1 << most + 1) - 1) >> least:
            n = mask.bit_length() - 1
            where = self.holders[n]
            while where:
                b = where[-1]
                if self.left[b] or not self.items[b][n]:
                    where.pop()
                else:
                    return b, n
            self.lengths ^= 1 << n
        return None

    def pair(self, most: int, least: int) -> tuple[int, int, int] | None:
        """(bin, n, m) with the largest n + m in least..most, both in one bin."""
        while (mask := self.sums & (1 << most + 1) - 1) >> least:
            total = mask.bit_length() - 1
            where = self.pairs[total]
            while where:
                b, n, m = where[-1]
                have = self.items[b]
                if self.left[b] or not have[n] or not have[m] or n == m and have[n] < 2:
                    where.pop()
                else:
                    return b, n, m
            self.sums ^= 1 << total
        return None

    def exchange(self, a: int) -> bool:
        """The exchange that fills bin ``a`` most; False if there is none."""
        gap = self.capacity - self.fill[a]
        best: tuple[int, int, tuple[int, ...], tuple[int, ...]] | None = None
        own = sorted(n for n, k in self.items[a].items() if k)
        twice = {n + m: (n, m) for n, m in combinations(own, 2)} | {2 * n: (n, n) for n in own if self.items[a][n] > 1}
        for give in [(), *((n,) for n in own), *twice.values()]:
            out = sum(give)
            for found in (self.holder(out + gap, out + 1, a), self.pair(out + gap, out + 1) if len(give) == 1 and out + gap <= self.capacity else None):
                if found:
                    b, *take = found
                    gain = sum(take) - out
                    if (best is None or gain > best[0]) and self.fill[a] - self.fill[b] + gain > 0:
                        best = (gain, b, give, tuple(take))
                        if gain == gap:
                            self.swap(a, *best[1:])
                            return True
        if best:
            self.swap(a, *best[1:])
        return best is not None

    def swap(self, a: int, b: int, give: tuple[int, ...], take: tuple[int, ...]) -> None:
        for n in take:
            self.items[b][n] -= 1
            self.items[a][n] += 1
        for n in give:
            self.items[a][n] -= 1
            self.items[b][n] += 1
            self.offer(b, n)
        gain = sum(take) - sum(give)
        self.fill[a] += gain
        self.fill[b] -= gain

    def round(self) -> int:
        """One turn for every underfull bin; returns the number of exchanges."""
        under = sorted((b for b, f in enumerate(self.fill) if 0 < f < self.capacity), key=lambda b: -self.fill[b])
        self.holders = [[] for _ in range(self.capacity + 1)]
        self.pairs = [[] for _ in range(self.capacity + 1)]
        self.lengths = self.sums = 0
        self.left = [True] * len(self.fill)
        for b in under:
            self.left[b] = False
            have = sorted(n for n, k in self.items[b].items() if k)
            for n in have:
                self.offer(b, n)
            for n, m in [*combinations(have, 2), *((n, n) for n in have if self.items[b][n] > 1)]:
                self.pairs[n + m].append((b, n, m))
                self.sums |= 1 << n + m
        done = 0
        for a in under:
            if not self.fill[a]:
                continue
            self.left[a] = True
            while self.fill[a] < self.capacity and self.exchange(a):
                done += 1
        return done

    def run(self) -> list[list[int]]:
        least = -(-sum(self.fill) // self.capacity)
        while sum(f > 0 for f in self.fill) > least and self.round():
            pass
        return [list(c.elements()) for c, f in zip(self.items, self.fill) if f]


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of lengths, each at most ``capacity`` in sum."""
    full = [[n] for n in lengths if n == capacity]
    return full + Search(best_fit([n for n in lengths if n < capacity], capacity), capacity).run()


def places(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of every piece, gapless within each sequence."""
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i, n in enumerate(lengths.tolist()):
        waiting[n].append(i)
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    for number, held in enumerate(pack_lengths(lengths.tolist(), capacity)):
        at = 0
        for n in held:
            i = waiting[n].pop()
            sequence[i], offset[i] = number, at
            at += n
    return sequence, offset


def pack(cut: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``cut`` (a table with a column length) with sequence_id and offset.

    Pieces are dealt evenly over searches of about ``group`` pieces, whatever their
    documents or sources; each search wastes less than about one sequence.  ``cut`` is
    counted first and should be a written table.  An empty table gives no rows.
    """
    searches = max(1, -(-cut.count() // group))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        sequence, offset = places(table.column("length").to_numpy(), capacity)
        sequence += TaskContext.get().partitionId() << 32
        yield from table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset)).to_batches()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    return cut.repartition(searches).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """All documents as pieces with their places in sequences of at most ``capacity`` ids."""
    return pack(materialize(pieces(docs, tokenizer, id_col, text_col, capacity, end, with_ids), "pieces"), capacity)
