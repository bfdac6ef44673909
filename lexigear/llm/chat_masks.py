"""Chat formatting with loss masks that follow character offsets.

A conversation is rendered whole, encoded once with offsets, and each turn's character
span is laid over the sorted token spans by binary search.  The template marks turns with
control strings and escapes these inside roles and texts, so that rendering can be undone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexigear.llm.common import materialize, small
from lexigear.shared import numbered_rows

MOST_CHARS = 1_000_000  # of a conversation that is rendered whole; longer ones are cut between turns
SEGMENT_ROWS = 4_096  # turns of a longer one that go to one task
LOSS_ROLE = "assistant"

OPEN, MIDDLE, CLOSE = "### ", ":\n", "</turn>\n"
_ESCAPE = re.compile(r"\\|###|</turn>")
_ESCAPE_ROLE = re.compile(r"\\|###|</turn>|:")
_UNESCAPE = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:[^\\:]++|\\(?:\\|###|</turn>|:))*+):\n((?:[^\\<]++|\\(?:\\|###|</turn>)|<(?!/turn>))*+)</turn>\n")


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


@dataclass
class Formatted:
    """A rendered run of turns; spans are (start, end) of each turn's text in it."""

    text: str = ""
    roles: list[str] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)


def render(turns: list[tuple[str, str]]) -> Formatted:
    """Renders (role, text) pairs."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = OPEN + _ESCAPE_ROLE.sub(lambda m: "\\" + m[0], role) + MIDDLE
        body = escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, CLOSE]
        at = spans[-1][1] + len(CLOSE)
    return Formatted("".join(out), [r for r, _ in turns], spans)


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) pairs that were rendered."""
    found, at = [], 0
    while at < len(text):
        turn = _TURN.match(text, at)
        if not turn:
            raise ValueError(f"no turn at {at}")
        found.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return found


def overlay(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(first token, last token + 1, start, end) of each non-empty character span.

    ``starts`` and ``ends`` are sorted token offsets; start and end are what the tokens
    cover of the span, in characters.
    """
    found = []
    for a, b in spans:
        lo = int(np.searchsorted(ends, a, side="right"))
        hi = int(np.searchsorted(starts, b, side="left"))
        if a < b and lo < hi:
            if (starts[lo + 1 : hi] > ends[lo : hi - 1]).any():
                raise ValueError("tokens leave out characters")
            found.append((lo, hi, max(a, int(starts[lo])), min(b, int(ends[hi - 1]))))
    return found


@cache
def tokenizer(path: str) -> Tokenizer:
    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True  # their strings in a text are ordinary text
    return found


SCHEMA = "conv_id long, segment long, part int, formatted string, loss_spans array<struct<start: int, end: int>>"
IDS = ", ids array<int>, loss array<boolean>"


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values) if values else np.empty(0), kind))


def _encoded(keys: list[tuple], held: list[Formatted], path: str, loss_role: str, with_ids: bool) -> pa.RecordBatch:
    ids, masks, spans = [], [], []
    for done, found in zip(held, tokenizer(path).encode_batch([h.text for h in held], add_special_tokens=False)):
        offsets = np.fromiter(chain.from_iterable(found.offsets), dtype=np.int64, count=2 * len(found)).reshape(-1, 2)
        under = overlay(offsets[:, 0], offsets[:, 1], [s for r, s in zip(done.roles, done.spans) if r == loss_role])
        spans.append(np.array([(a, b) for *_, a, b in under], dtype=np.int32).reshape(-1, 2))
        if with_ids:
            mask = np.zeros(len(offsets), dtype=bool)
            for lo, hi, *_ in under:
                mask[lo:hi] = True
            masks.append(mask)
            ids.append(np.array(found.ids, dtype=np.int32))
    ends = np.cumsum([0, *map(len, spans)]).astype(np.int32)
    flat = np.concatenate(spans) if spans else np.empty((0, 2), dtype=np.int32)
    struct = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, i])) for i in (0, 1)], names=["start", "end"])
    columns = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([k[2] for k in keys], pa.int32()), pa.array([h.text for h in held], pa.string()), pa.ListArray.from_arrays(pa.array(ends), struct)]
    names = ["conv_id", "segment", "part", "formatted", "loss_spans"]
    if with_ids:
        columns += [_lists(ids, pa.int32()), _lists(masks, pa.bool_())]
        names += ["ids", "loss"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _size(role: str, text: str) -> Column:
    """Characters of a turn before escaping, its marks among them."""
    return F.length(role) + F.length(text) + len(OPEN + MIDDLE + CLOSE)


def _segmented(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` with their segment: 0, but in conversations of more than ``most`` characters
    the number of the run of ``SEGMENT_ROWS`` turns that a row is in.

    Such conversations are numbered by ranges of their turns, so that one of them may hold
    any share of all rows.
    """
    sizes = rows.groupBy("conv_id").agg(F.sum(_size("role", "text").cast("long")).alias("chars"))
    large = materialize(sizes.where(F.col("chars") > most).select(F.col("conv_id").alias("large_id")), "large")
    whole = rows.withColumn("segment", F.lit(0).cast("long"))
    if large.isEmpty():
        return whole
    is_large = F.col("conv_id").eqNullSafe(F.col("large_id"))
    rest = whole.join(small(large), is_large, "left_anti")
    cut = numbered_rows(rows.join(small(large), is_large, "left_semi"), "conv_id", "turn", "role", "text")
    starts = cut.groupBy(F.col("conv_id").alias("large_id")).agg(F.min("no").alias("first"))
    cut = cut.join(small(materialize(starts, "starts")), is_large)
    segment = F.expr(f"(no - first) div {SEGMENT_ROWS}")
    return rest.unionByName(cut.select(*rows.columns, segment.alias("segment")))


def format_conversations(turns: DataFrame, path: str, loss_role: str = LOSS_ROLE, most: int = MOST_CHARS, with_ids: bool = True) -> DataFrame:
    """(conv_id, segment, part, formatted, loss_spans, ids, loss) from rows of
    conv_id, turn, role, text; ids and loss only ``with_ids``.

    Turns are ordered by turn, then role and text, whatever their numbers are; null turns
    come first, null roles and texts count as empty, and rows without conv_id are one
    conversation.  A conversation is rendered whole and encoded once, one row, unless it has
    more than ``most`` characters: then it goes on in further segments, which other tasks may
    render, and parts of them, and its text is theirs in order.  ``loss`` tells for each
    id whether it touches a text of ``loss_role``; ``loss_spans`` are the characters of
    ``formatted`` under the mask, cut to these texts.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[tuple] = []
        held: list[Formatted] = []
        now: tuple | None = None
        part, pending, pending_size, size = 0, [], 0, 0

        def close() -> None:
            nonlocal pending, pending_size, part, size
            if pending:
                keys.append((*now, part))
                held.append(render(pending))
                size += len(held[-1].text)
                part, pending, pending_size = part + 1, [], 0

        for batch in batches:
            for conv, seg, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "role", "text"))):
                more = len(role) + len(text) + len(OPEN + MIDDLE + CLOSE)
                if (conv, seg) != now:
                    close()
                    now, part = (conv, seg), 0
                elif pending_size + more > most:
                    close()
                pending.append((role, text))
                pending_size += more
                if size > 1_000_000 or len(held) >= 200:
                    yield _encoded(keys, held, path, loss_role, with_ids)
                    keys, held, size = [], [], 0
        close()
        if held:
            yield _encoded(keys, held, path, loss_role, with_ids)

    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _segmented(rows, most).repartition(n, "conv_id", "segment").sortWithinPartitions("conv_id", "segment", "turn", "role", "text")
    return dealt.drop("turn").mapInArrow(work, SCHEMA + IDS * with_ids)
