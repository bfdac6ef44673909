"""Exact deduplication as a stateful stream.

Each ingested set of documents adds signatures (digest, length, identifier, locator) to a
folder that a streaming query reads.  Its keyed state, on disk (RocksDB) and without
expiry, holds for every digest the winner's identifier, its content locator and the number
of rows; Spark combines rows of a digest within each task before they are shuffled, so a
group of copies of any size costs its key one row per task.  A digest that several rows
share is a hit: the bytes of its winner before this ingest, or within it, are read where the
locator says, in the files of an earlier ingest or this one, and compared with those of the
new rows.  Where they differ, the documents of that digest are grouped by their bytes instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigear.llm.common import materialize, scratch, small

#: State on disk; a task that has committed its part of it unloads it, so that an executor
#: holds only the databases it is working on, however many partitions the state has.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
KEY = ["digest", "n_bytes"]


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


class Deduplicator:
    """Deduplicates the documents of all ingests into ``folder``, which outlives a session.

    ``digest`` and the names of columns must be the same for all ingests.  Documents that
    are read from Parquet files as they are can be found again there, by file, identifier
    and digest, so the files must stay; of others identifier and text are kept below
    ``folder``.  An ingest that was broken off is done again with the same ``number``: what
    it has written is used, and the stream goes on from its checkpoint.
    """

    def __init__(self, spark: SparkSession, folder: str, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256):
        self.spark, self.folder, self.digest = spark, folder, digest
        self.id_col, self.text_col = id_col, text_col

    # What a document is known by

    def _narrow(self, docs: DataFrame) -> DataFrame:
        """(doc_id, text, digest, n_bytes)."""
        text = F.coalesce(docs[self.text_col].cast("string"), F.lit(""))
        read = docs.select(docs[self.id_col].cast("long").alias("doc_id"), text.alias("text"))
        return read.withColumns({"digest": self.digest(F.col("text")), "n_bytes": F.octet_length("text").cast("long")})

    def _sign(self, docs: DataFrame, number: int) -> DataFrame:
        """(digest, n_bytes, doc_id, row_no, locator): row_no tells rows of one id apart."""
        path = f"{self.folder}/signatures/ingest={number}"
        if not self._is_there(path):
            own = F.monotonically_increasing_id().alias("row_no")
            signed = self._narrow(docs).select(*KEY, "doc_id", own, F.input_file_name().alias("locator"))
            signed.write.option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path)

    def _is_there(self, path: str) -> bool:
        try:
            self.spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def _findable(self, docs: DataFrame, number: int) -> DataFrame:
        """``docs`` if they are a plain scan of files, else what is kept of them."""
        if docs._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation" and docs.inputFiles():
            return docs
        path = f"{self.folder}/contents/{number}"
        if not self._is_there(path):
            docs.select(docs[self.id_col], docs[self.text_col]).write.option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path)

    def signatures(self) -> DataFrame:
        return self.spark.read.schema(SIGNED).parquet(f"{self.folder}/signatures")

    def contents(self, wanted: DataFrame, by: list[str]) -> DataFrame:
        """(doc_id, text, digest, n_bytes) of the rows in the files of ``wanted`` whose ``by``
        are among its rows; ``wanted`` has them and locator, and is a written table."""
        files = [r.locator for r in wanted.select("locator").distinct().collect()]  # as many as the corpus has files
        if not files:
            return self.spark.createDataFrame([], "doc_id long, text string, digest string, n_bytes long")
        keys = small(materialize(wanted.select(*[F.col(c).alias(f"{c}_") for c in by]).distinct(), "wanted"))
        same = F.lit(True)
        for c in by:
            same &= F.col(c).eqNullSafe(F.col(f"{c}_"))
        return self._narrow(self.spark.read.parquet(*files)).join(keys, same, "left_semi")

    # Ingest

    def add(self, docs: DataFrame, number: int = 0) -> None:
        """Take in the documents of ingest ``number``, and compare bytes on hits."""
        docs = self._findable(docs, number)
        signed = self._sign(docs, number)
        self._stream()
        groups = self.groups().where("group_size > 1")
        hits = materialize(groups.join(signed.select(*KEY).distinct(), KEY, "left_semi").select(*KEY, "winner"), "hits")
        # the winner may be one of the new rows: then these are compared with the one before it
        older = self._runs().where(F.col("winner.ingest") != number).groupBy(*KEY).agg(F.max_by("winner", "batch").alias("older"))
        older = materialize(older.join(small(hits.select(*KEY)), KEY, "left_semi"), "older")
        hits = hits.join(small(older), KEY, "left").withColumn("known", F.coalesce("older", "winner"))
        hits = materialize(hits.select(*KEY, "known.doc_id", "known.locator"), "hits")
        kept = self.contents(hits, [*KEY, "doc_id"]).groupBy(*KEY).agg(F.min("text").alias("kept_text"))
        rows = self._narrow(docs).join(small(hits.select(*KEY)), KEY)
        # written out, so that the join can split a digest that holds many rows
        differ = rows.join(materialize(kept, "kept"), KEY).where(F.col("text") != F.col("kept_text"))
        # as above: a grouping on the join's own key would keep it from splitting
        apart = materialize(differ.select(*KEY), "differing").distinct()
        apart.write.mode("overwrite").parquet(f"{self.folder}/clashes/ingest={number}")

    def _stream(self) -> None:
        """Run the stream over the signatures that its state has not seen yet."""
        folder, session = self.folder, self.spark.newSession()  # settings of its own
        for name, value in self.spark.conf.getAll.items():
            if session.conf.isModifiable(name):
                session.conf.set(name, value)
        for name, value in STATE.items():
            session.conf.set(name, value)
        stream = session.readStream.schema(SIGNED).parquet(f"{folder}/signatures")
        winner = F.max(F.struct("doc_id", "ingest", "row_no", "locator")).alias("winner")
        groups = stream.groupBy(*KEY).agg(F.count("*").alias("group_size"), winner)

        def put(batch: DataFrame, number: int) -> None:
            batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/groups/run-{number}")

        query = groups.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        query.awaitTermination()

    # Results

    def _runs(self) -> DataFrame:
        """What each run of the stream has changed."""
        return self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.folder}/groups")

    def groups(self) -> DataFrame:
        """(digest, n_bytes, group_size, winner), the newest of every digest."""
        found = self._runs()
        if found.agg(F.min("batch") == F.max("batch")).first()[0] is False:
            newest = F.max_by(F.struct("group_size", "winner"), "batch").alias("now")
            found = found.groupBy(*KEY).agg(newest).select(*KEY, "now.*")
        return found.select(*KEY, "group_size", "winner")

    def members(self) -> DataFrame:
        """(doc_id, keep_id, group_size, kept, digest, n_bytes): one row per row of all ingests."""
        signed, groups = self.signatures(), self.groups()
        joined = signed.join(groups, KEY)
        first = (F.col("ingest") == F.col("winner.ingest")) & (F.col("row_no") == F.col("winner.row_no"))
        out = joined.select("doc_id", F.col("winner.doc_id").alias("keep_id"), "group_size", first.alias("kept"), *KEY)
        clashes = materialize(self.spark.read.schema(CLASHED).parquet(f"{self.folder}/clashes").select(*KEY).distinct(), "clashes")
        if clashes.isEmpty():
            return out
        wanted = signed.join(clashes, KEY, "left_semi").select(*KEY, "doc_id", "locator")
        apart = self.contents(materialize(wanted, "clashing"), [*KEY, "doc_id"])
        apart = materialize(apart.withColumn("row_no", F.monotonically_increasing_id()), "apart")
        exact = apart.groupBy(*KEY, "text").agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row_no")).alias("winner"))
        redone = apart.join(materialize(exact, "exact"), [*KEY, "text"])
        first = F.col("row_no") == F.col("winner.row_no")
        redone = redone.select("doc_id", F.col("winner.doc_id").alias("keep_id"), "group_size", first.alias("kept"), *KEY)
        return out.join(clashes, KEY, "left_anti").unionByName(redone)


SIGNED = "digest string, n_bytes long, doc_id long, row_no long, locator string, ingest int"
CLASHED = "digest string, n_bytes long, ingest int"


def members(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest, n_bytes): one row per row of ``docs``.

    Texts are equal when their bytes are; null counts as empty.  The row with the largest
    id stays; a null id is smaller than any other, and of rows with the same id and text
    exactly one stays.
    """
    found = Deduplicator(docs.sparkSession, scratch(docs.sparkSession, "dedup"), id_col, text_col, digest)
    found.add(docs)
    return found.members()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of equal texts, that of the largest id, columns as they are."""
    found = materialize(members(docs, id_col, text_col), "members")
    key = [F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest")]
    gone = materialize(found.where("NOT doc_id <=> keep_id").select(*key).distinct(), "dropped")
    twins = materialize(found.where("doc_id <=> keep_id").groupBy("doc_id", "digest").count().where("count > 1").select(*key), "twins")

    def same(rows: DataFrame, keys: DataFrame):
        text = F.coalesce(rows[text_col].cast("string"), F.lit(""))
        return rows[id_col].eqNullSafe(keys["gone_id"]) & (sha256(text) == keys["gone_digest"])

    left = docs.join(small(gone), same(docs, gone), "left_anti")
    if twins.isEmpty():
        return left
    twice = left.join(twins, same(left, twins), "left_semi")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    once = twice.groupBy(F.col(id_col).alias("k1"), sha256(text).alias("k2")).agg(F.first(whole).alias("row")).select("row.*")
    return left.join(twins, same(left, twins), "left_anti").unionByName(once)
