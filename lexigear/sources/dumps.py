"""Document dumps: text files holding ``<doc id= url= title=> ... </doc>`` blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigear.functions.text import hash_fraction

# The header line and the end of a block.
HEADER = r'^[^\n]*?id="([^"]*)"[^\n]*?url="([^"]*)"[^\n]*?title="([^"]*)"'
BODY = r"(?s)^[^\n]*\n(.*?)(?<=\n)</doc>"
OPENING = r"(?:^|\n)<doc "
OPENING_LINE = "\n<doc "


def read_dump(spark: SparkSession, glob: str) -> DataFrame:
    """One row per file: ``path, content``."""
    return spark.read.text(glob, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")
    )


def sample_rows(df: DataFrame, fraction: float, key: str, seed: int = 0) -> DataFrame:
    """Keep each row with probability ``fraction``, decided by a hash of ``key``.

    The choice is the same in every run and for every partitioning, so that counts
    taken downstream agree with each other.
    """
    return df.where(hash_fraction(F.col(key), seed) < fraction)


def sample_files(dump: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """Sample whole files before anything is parsed."""
    return sample_rows(dump, fraction, "path", seed)


def _documents(blocks: DataFrame, block: Column) -> DataFrame:
    """Turn texts that start right after ``<doc `` into documents.

    A block without header attributes in order, without closing line or without
    content gives no document.
    """
    return (
        blocks.select(block.alias("block"))
        .select(
            F.regexp_extract("block", HEADER, 1).alias("doc_id"),
            F.regexp_extract("block", HEADER, 2).alias("url"),
            F.regexp_extract("block", HEADER, 3).alias("title"),
            F.regexp_extract("block", BODY, 1).alias("content"),
        )
        .where((F.col("title") != "") & (F.col("content") != ""))
    )


def parse_documents(dump: DataFrame) -> DataFrame:
    """``doc_id, url, title, content`` of every complete block of every file."""
    pieces = F.split("content", OPENING)
    blocks = dump.select(F.explode(F.slice(pieces, F.lit(2), F.size(pieces))).alias("piece"))
    return _documents(blocks, F.col("piece"))


def read_documents(spark: SparkSession, glob: str) -> DataFrame:
    """Read and parse in one splittable scan, for files too large for one row.

    The reader breaks files at lines that open a block, so a record is one block and a
    file of any size is shared by many tasks.  Only the first record of a file may be
    something else, text before the first block, and it is told by its place: the first
    row read from offset 0.  A scan that returns no text finds these places.
    """
    place = F.monotonically_increasing_id().alias("place")
    scan = spark.read.text(glob, lineSep=OPENING_LINE)
    starts = scan.select(place, "_metadata.file_path", "_metadata.file_block_start").where("file_block_start = 0")
    firsts = starts.groupBy("file_path").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    # A few bytes for each file, of which the driver holds the path and more anyway.
    records = scan.select(place, "value").join(F.broadcast(firsts), "place", "left")
    opened = F.startswith("value", F.lit("<doc "))
    begun = records.where(F.col("first").isNull() | opened)
    return _documents(begun, F.when(F.col("first").isNotNull(), F.substr("value", F.lit(6))).otherwise(F.col("value")))


def write_dump(docs: DataFrame, path: str, docs_per_file: int = 1000) -> None:
    """Write ``doc_id, url, title, content`` as dump files of bounded size."""
    block = F.concat(
        F.lit('<doc id="'), F.col("doc_id").cast("string"),
        F.lit('" url="'), F.col("url"),
        F.lit('" title="'), F.col("title"),
        F.lit('">\n'), F.col("content"), F.lit("\n</doc>"),
    )
    (
        docs.select(block.alias("value"))
        .write.option("maxRecordsPerFile", docs_per_file)
        .text(path)
    )
