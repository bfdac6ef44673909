"""CSV with quoted line breaks, read by many tasks.

Whether a line begins a record depends on the quotes of all lines before it, so Spark reads
such a file in one task.  Here it takes two scans of ordinary splits.  In the first, every
split says where it ends, inside or outside of quotes, for either way it may begin; carried
along the splits of a file, these answers tell how each begins.  In the second, every split
cuts its lines into records.  Lines before its first record belong to a record that an
earlier split has begun, and the pieces of these are put together.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigear.shared import through_table

QUOTE = '"'
SPLIT = ["path", "start"]
# Bytes of lines that a task hands on at a time.
BATCH_BYTES = 4 * 1024 * 1024


def inside_after(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether a quoted field is still open at the end of a line.

    A quote opens a field only where the field begins; in an unquoted field it is a
    character like others.  Within quotes, two quotes are one character, and one quote
    closes the field.
    """
    if QUOTE not in line:
        return inside
    at = 0
    while True:
        if inside:
            at = line.find(QUOTE, at)
            while at >= 0 and line.startswith(QUOTE, at + 1):
                at = line.find(QUOTE, at + 2)
            if at < 0:
                return True
            inside = False
            at += 1
        elif at == 0 and line.startswith(QUOTE):
            inside, at = True, 1
            continue
        # To the next field; what stands between a closing quote and it is not a quote's place.
        at = line.find(sep, at)
        if at < 0:
            return False
        at += 1
        if line.startswith(QUOTE, at):
            inside, at = True, at + 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, path, start``: the lines of each split in order; a line belongs to the split
    in which it begins."""
    return spark.read.text(path, lineSep="\n").select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """(split, its lines) of each run of lines of one split."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in (*SPLIT, "value"))))
    for split, lines in groupby(rows, key=lambda r: r[:2]):
        yield split, (line for *_, line in lines)


def split_states(lines: DataFrame, sep: str = ",") -> DataFrame:
    """``path, start, outside, inside``: whether a split ends within quotes, if it begins
    outside of them and if it begins inside."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (path, start), own in _by_split(batches):
            outside, inside = False, True
            for line in own:
                outside, inside = inside_after(line, outside, sep), inside_after(line, inside, sep)
            yield pa.RecordBatch.from_pylist([{"path": path, "start": start, "outside": outside, "inside": inside}])

    return lines.mapInArrow(scan, "path string, start long, outside boolean, inside boolean")


def begins_inside(states: DataFrame) -> DataFrame:
    """``path, start, begins``: whether each split begins within quotes.

    An answer that is the same for both beginnings settles what follows, whatever came
    before; between two such splits, each either keeps the state or turns it.  One row
    stands for a whole split, so the splits of a file are few.
    """
    order = W.partitionBy("path").orderBy("start")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    settled = F.when(F.col("outside") == F.col("inside"), F.col("outside"))
    turned = (F.col("outside") & ~F.col("inside")).cast("int")
    # Turns are counted from the last settled split on.
    block = F.sum(settled.isNotNull().cast("int")).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    marked = states.withColumns({"settled": settled, "turned": turned, "block": block})
    in_block = W.partitionBy("path", "block").orderBy("start").rowsBetween(W.unboundedPreceding, W.currentRow)
    first = F.coalesce(F.first("settled").over(in_block), F.lit(False)).cast("int")
    # A settled split is the first of its block; its own turn does not count.
    turns = F.sum(F.when(F.col("settled").isNull(), F.col("turned")).otherwise(0)).over(in_block)
    ends = marked.withColumn("ends", F.pmod(first + turns, F.lit(2)) == 1)
    return ends.select("path", "start", F.coalesce(F.last("ends").over(before), F.lit(False)).alias("begins"))


def records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """``path, start, no, record``: the records of the files, line breaks within quotes kept.

    ``start`` and ``no`` give the split and the number of a record in it; the first record
    of a file is number 0 of the split at 0.  Blank lines between records are no records.
    """
    lines = _lines(spark, path)
    begins = through_table(begins_inside(through_table(split_states(lines, sep), "splits")), "splits")
    # one row for each split of the scan, of which Spark holds the list as well
    known = lines.join(F.broadcast(begins), SPLIT)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in (*SPLIT, "begins", "value"))))
        held: list[tuple] = []
        split, inside, no = None, False, 0
        text: list[str] | None = None
        size = 0
        for path_, start, begins_, line in rows:
            if (path_, start) != split:
                if text is not None:
                    held.append((*split, no, "\n".join(text), False))
                # Lines before the first record of a split get the number -1.
                split, inside, no, text = (path_, start), begins_, -1 if begins_ else 0, [] if begins_ else None
            if text is None:
                if not line.strip("\r"):
                    continue
                text = []
            text.append(line)
            size += len(line)
            inside = inside_after(line, inside, sep)
            if not inside:
                held.append((*split, no, "\n".join(text), True))
                text, no = None, no + 1
            if size > BATCH_BYTES:
                yield batch_of(held)
                held, size = [], 0
        if text is not None:
            held.append((*split, no, "\n".join(text), False))
        if held:
            yield batch_of(held)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), arrow.types)], schema=arrow) if rows else pa.RecordBatch.from_pylist([], schema=arrow)

    arrow = pa.schema([("path", pa.string()), ("start", pa.int64()), ("no", pa.int64()), ("record", pa.string()), ("ended", pa.bool_())])
    pieces = through_table(known.mapInArrow(cut, "path string, start long, no long, record string, ended boolean"), "records")
    whole = pieces.where("no >= 0 AND ended").select("path", "start", "no", "record")
    # A record cut by the end of its split: its first piece, whole splits, and the beginning of one.
    broken = pieces.where("no < 0 OR NOT ended")
    order = W.partitionBy("path").orderBy("start", "no").rowsBetween(W.unboundedPreceding, W.currentRow)
    owner = F.last(F.when(F.col("no") >= 0, F.struct("start", "no")), ignorenulls=True).over(order)
    parts = broken.withColumn("owner", owner).groupBy("path", "owner").agg(F.array_sort(F.collect_list(F.struct("start", "no", "record"))).alias("parts"))
    mended = parts.select("path", "owner.start", "owner.no", F.array_join("parts.record", "\n").alias("record"))
    return whole.unionByName(mended)


def read_quoted(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """The rows of CSV files with a header, quoted line breaks and doubled quotes.

    The same rows as Spark's ``multiLine`` reader gives, with a file of any size read by
    many tasks.  Lines end in a line feed, or in a carriage return and a line feed if the
    header does; such ends become line feeds within quotes.
    """
    found = records(spark, path, sep)
    first = "start = 0 AND no = 0"
    ends = found.where(first).select("path", F.endswith("record", F.lit("\r")).alias("both"))
    body = found.where(f"NOT ({first})").join(F.broadcast(ends), "path")  # a row for each file
    text = F.when(F.col("both"), F.regexp_replace(F.regexp_replace("record", "\r$", ""), "\r\n", "\n")).otherwise(F.col("record"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE, "multiLine": "true"}
    return body.select(F.from_csv(text, fields, options).alias("row")).select("row.*")
