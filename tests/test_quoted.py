"""CSV with quoted line breaks, cut into splits, against Spark's reader of whole files."""

import random

import pytest
from pyspark.sql import types as T

from lexigear.sources.quoted import _lines, inside_after, read_quoted, records

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("a/b", "c", "d")])


@pytest.fixture
def tiny_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "900", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "6"}
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def whole(spark, path):
    reader = spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    return sorted(map(tuple, reader.csv(path).collect()), key=repr)


def cut(spark, path):
    return sorted(map(tuple, read_quoted(spark, path, SCHEMA).collect()), key=repr)


def test_state_at_the_end_of_a_line():
    assert [inside_after(x, False) for x in ("", "a,b", '"', 'a,"b', '"a""b', '"a","b"', 'a"b,c', '"a"b,"', '"",""', '"""', '""""')] == [
        False, False, True, True, True, False, False, True, False, True, False]
    assert [inside_after(x, True) for x in ("", "a,b", '"', 'x","y', 'x""y', 'x"",y"', '"",', ',"')] == [True, True, False, True, True, False, True, False]


FIELDS = ["", "x", "two words", "é€", '"plain"', '"a, b"', '"line\nbreak"', '"quote "" in"', '"\n\n"', '""', '"""start"', '"end"""', 'in"side', '"' + "long\n" * 60 + '"', '"x,""y"",\nz"']


def test_rows_equal_the_whole_reader(spark, tmp_path, tiny_splits):
    r = random.Random(2)
    rows = [",".join(r.choice(FIELDS) for _ in range(3)) for _ in range(60)]
    (tmp_path / "lf.csv").write_text("\n".join(["a/b,c,d", "", *(row for row in rows if row.strip(","))]) + "\n\n")
    (tmp_path / "crlf.csv").write_bytes(b'a/b,c,d\r\n1,"x\r\ny",2\r\n\r\n3,4,5\r\n' + b'6,"' + b"p\r\n" * 200 + b'",7')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("a/b,c,d\n")
    assert _lines(spark, str(tmp_path)).select("start").distinct().count() > 4
    for name in ("lf.csv", ""):
        assert cut(spark, f"{tmp_path}/{name}") == whole(spark, f"{tmp_path}/{name}"), name
    # records begin in several splits, so several tasks cut them
    assert records(spark, f"{tmp_path}/lf.csv").select("start").distinct().count() > 3
