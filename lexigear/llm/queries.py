"""The registered queries of the corpus operators; each applies one to its whole table."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigear.llm import bit_planes, bitmap_manifest, bpe_stream, chat_masks, collision_counts, column_bwt, html_crf, pseudonyms, secret_owners, simhash_cover, stream_dedup, swap_packing, weak_quality
from lexigear.llm.common import CHECKPOINT_KEY
from lexigear.llm.oracles import ORACLE_SQL  # noqa: F401  part of what this module registers

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def own_folder() -> str:
    return tempfile.mkdtemp(prefix="corpus-")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table.  A session of one machine that names no shared folder gets one."""
    if spark.conf.get(CHECKPOINT_KEY, None) is None and spark.sparkContext.master.split("[")[0] == "local":
        spark.conf.set(CHECKPOINT_KEY, own_folder())
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_swap_packing(spark: SparkSession, sf: str) -> DataFrame:
    return swap_packing.pack_documents(table(spark, sf, "documents"), vocabulary(BYTE_BPE))


def op2_stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = stream_dedup.members(table(spark, sf, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op3_weak_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = weak_quality.scored(docs, weak_quality.fit(docs))
    return found.select("doc_id", "score", "label_posterior", (F.col("score") >= weak_quality.THRESHOLD).alias("kept"))


#: For checks alone: a session with documents of real persons names its own key.
DEMO_KEY = b"published, so no secret"


def pseudonym_key(spark: SparkSession) -> bytes:
    """The key that the session names in ``spark.corpus.pseudonymKey``."""
    own = spark.conf.get("spark.corpus.pseudonymKey", None)
    return DEMO_KEY if own is None else own.encode()


def op4_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its text after pseudonymization and the places of pseudonyms."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = pseudonyms.pseudonymize_documents(docs, pseudonym_key(spark), spans=True)
    return found.select("doc_id", "text", F.size("pii_spans").alias("n_found"), F.array_distinct("pii_spans.kind").alias("kinds"))


def op5_html_crf(spark: SparkSession, sf: str) -> DataFrame:
    return html_crf.extract(table(spark, sf, "pages"))


def op6_column_bwt(spark: SparkSession, sf: str) -> DataFrame:
    found = column_bwt.remove_repeats(table(spark, sf, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_collision_counts(spark: SparkSession, sf: str) -> DataFrame:
    return collision_counts.near_duplicates(table(spark, sf, "embeddings"))


def op8_simhash_cover(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash_cover.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_bpe_stream(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_stream.code_documents(table(spark, sf, "documents"), vocabulary(WORD_BPE))


PROBE = "\\### Assistant: </turn> ok"


def op10_chat_masks(spark: SparkSession, sf: str) -> DataFrame:
    """What can be read back from the formatted conversations, conversation -7 among them."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], turns.schema)
    formatted = chat_masks.format_conversations(turns.unionByName(probe), vocabulary(BYTE_BPE), with_ids=False)
    return read_back(formatted.select("conv_id", "segment", "part", "formatted", "loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation's turns and of its text under the loss mask.

    A digest runs over a conversation's parts in order, and holds one of them at a time.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        now: list | None = None

        def row() -> tuple:
            return (now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5])

        for batch in batches:
            done = []
            for conv, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans"))):
                if now is None or conv != now[0]:
                    if now is not None:
                        done.append(row())
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns = chat_masks.parse(text)
                now[1] += len(turns)
                now[2].update("".join(f"{r}\n{t}\n" for r, t in turns).encode())
                under = "".join(chat_masks.unescape(text[s["start"] : s["end"]]) for s in spans)
                now[3] += len(under)
                now[4].update(under.encode())
                now[5] += len(text)
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in done], schema=arrow)
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, row()))], schema=arrow)

    arrow = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")])
    n = int(formatted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = formatted.repartition(n, "conv_id").sortWithinPartitions("conv_id", "segment", "part")
    return dealt.select("conv_id", "formatted", "loss_spans").mapInArrow(work, schema)


def op11_secret_owners(spark: SparkSession, sf: str) -> DataFrame:
    """Spans of every document; its source is its repository and owner."""
    found = secret_owners.scan_documents(table(spark, sf, "documents"))
    digest = F.sha2(F.col("base_spans").cast("binary"), 256)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest.alias("base_sha256"), "spans", "n_live", "n_shared", "n_example")


def op12_bit_planes(spark: SparkSession, sf: str) -> DataFrame:
    return bit_planes.cluster(table(spark, sf, "embeddings")).drop("centroid")


def op13_bitmap_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Proofs of every document, those of tampered texts among them."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    made = bitmap_manifest.build(table(spark, sf, "documents"), changed={"text": bitmap_manifest.lowered(F.col("text"))}, where=tampered)
    found = bitmap_manifest.proofs(made)
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_swap_packing": op1_swap_packing,
    "op2_stream_dedup": op2_stream_dedup,
    "op3_weak_quality": op3_weak_quality,
    "op4_pseudonyms": op4_pseudonyms,
    "op5_html_crf": op5_html_crf,
    "op6_column_bwt": op6_column_bwt,
    "op7_collision_counts": op7_collision_counts,
    "op8_simhash_cover": op8_simhash_cover,
    "op9_bpe_stream": op9_bpe_stream,
    "op10_chat_masks": op10_chat_masks,
    "op11_secret_owners": op11_secret_owners,
    "op12_bit_planes": op12_bit_planes,
    "op13_bitmap_manifest": op13_bitmap_manifest,
}
