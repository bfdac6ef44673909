"""The registered queries against their SQL, and the pipeline against its stages in plain Python."""

import math
import os
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from lexigear.llm import pseudonyms, queries, simhash_cover, weak_quality

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    base = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        base.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = queries.QUERIES[name](spark, SF)
    wanted = base.sql(queries.ORACLE_SQL[name])
    assert sorted(found.columns) == sorted(wanted.columns)
    rows = Counter(tuple(r[c] for c in wanted.columns) for r in found.collect())
    assert rows == Counter(wanted.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    """Each stage is done again over its predecessor's documents, pair by pair."""
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    model = weak_quality.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = [r for r in rows if model.scorer.score(r["text"].encode()) >= weak_quality.THRESHOLD]
    best = {}
    for r in rows:
        best[r["text"]] = max(best.get(r["text"], -1), r["doc_id"])
    rows = sorted((r for r in rows if best[r["text"]] == r["doc_id"]), key=lambda r: r["doc_id"])
    prints = [simhash_cover.fingerprint(r["text"]) for r in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((root(a), root(b)))
                label[y] = x
    rows = [r for i, r in enumerate(rows) if root(i) == i]
    found = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in found} == {r["doc_id"] for r in rows}
    encode = __import__("lexigear.llm.swap_packing", fromlist=["encoder"]).encoder(queries.vocabulary(queries.BYTE_BPE)).ids
    ids = {r["doc_id"]: len(encode(pseudonyms.pseudonymize(r["text"], queries.DEMO_KEY)[0])) + 1 for r in rows}
    total = Counter()
    for r in found:
        total[r.doc_id] += r.length
    assert total == ids
    assert len({r.sequence_id for r in found}) <= 1.01 * math.ceil(sum(ids.values()) / 1024) + 1


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, SF).columns == docs.columns


def test_folder_is_one_that_all_can_reach(spark):
    from lexigear.llm.common import scratch

    assert os.path.isabs(scratch(spark, "x").removeprefix("file:"))
