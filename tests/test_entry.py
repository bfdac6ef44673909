import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as contract  # noqa: E402

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="driver tables are absent")
CHECKED = ["a3_read_documents", "c1_tokens_regex", "c3_tokens_lemma", "d8_tfidf", "f7_search", "f12_batch_search", "g4_one_hot", "h3_lloyd", "h12_cluster_entropy", "j8_class_metrics"]


@pytest.fixture(scope="module")
def tables():
    db = duckdb.connect()
    for path in SF.glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["doc_id", "title", "score"]


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, tables, name):
    got = contract.queries()[name](spark, str(SF)).toPandas()
    expected = tables.execute(contract.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    rows = lambda df: sorted(map(repr, df[columns].itertuples(index=False, name=None)))
    assert rows(got) == rows(expected)
