import pytest
from pyspark.sql import functions as F

from lexigear.sources import dumps, sinks, tables

GOOD = '<doc id="1" url="u1" title="One">\nfirst line\nsecond\n</doc>\n'
DUMP_A = (
    "stray text\n" + GOOD
    + '<doc id="2" url="u2" title="Unclosed">\nlost\n'
    + '<doc id="3" url="u3" title="Three">\nthree\n</doc>\n'
    + '<doc title="Order" id="4" url="u4">\nfour\n</doc>\n'
    + '<doc id="5" url="u5" title="Empty"></doc>\n'
    + '<doc id="6" url="u6" title="">\nno title\n</doc>\n'
)
DUMP_B = (
    '<doc id="7" url="u7" title="Blank">\n\n</doc>\n'
    '<doc id="8" url="u8" title="Inline">\nkeep </doc> inside\n <doc indented\n</doc>\n'
    '<doc id="9" url="u9" title="Cut">\nnever closed'
)
EXPECTED = [
    ("1", "u1", "One", "first line\nsecond\n"),
    ("3", "u3", "Three", "three\n"),
    ("7", "u7", "Blank", "\n"),
    ("8", "u8", "Inline", "keep </doc> inside\n <doc indented\n"),
]


def put(tmp_path, **files):
    for name, text in files.items():
        path = tmp_path / name / "wiki_00"
        path.parent.mkdir(parents=True)
        path.write_text(text)
    return f"{tmp_path}/*/*"


def test_parse_documents(spark, tmp_path):
    dump = dumps.read_dump(spark, put(tmp_path, AA=DUMP_A, AB=DUMP_B))
    assert dump.count() == 2
    rows = dumps.parse_documents(dump).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == EXPECTED


def test_splittable_reader_agrees(spark, tmp_path):
    glob = put(tmp_path, AA=DUMP_A, AB=DUMP_B)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        rows = dumps.read_documents(spark, glob).orderBy("doc_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [tuple(r) for r in rows] == EXPECTED


def test_dump_round_trip(spark, folder):
    docs = spark.createDataFrame([(i, f"u{i}", f"t{i}", f"text {i}\nmore") for i in range(50)], "doc_id long, url string, title string, content string")
    dumps.write_dump(docs, folder, docs_per_file=5)
    back = dumps.read_documents(spark, folder)
    assert back.count() == 50
    assert back.where("content = concat('text ', doc_id, '\nmore\n')").count() == 50


def test_documents_after_text_that_looks_like_a_block(spark, tmp_path):
    """Text before the first block is dropped, whatever it looks like."""
    like = 'id="7" url="u" title="no block">\nbody\n</doc>\n'
    block = '<doc id="1" url="u" title="t">\ntext\n</doc>\n'
    for name, text in (("a", like + block + block), ("b", block), ("c", " " + block + block), ("d", like), ("e", "<doc " + block), ("f", "")):
        (tmp_path / f"{name}.txt").write_text(text)
    for glob in [f"{tmp_path}/{n}.txt" for n in "abcdef"] + [f"{tmp_path}/*"]:
        split = sorted(map(tuple, dumps.read_documents(spark, glob).collect()))
        assert split == sorted(map(tuple, dumps.parse_documents(dumps.read_dump(spark, glob)).collect())), glob


def test_sample_is_repeatable(spark):
    df = spark.range(10_000).withColumnRenamed("id", "path")
    first = {r.path for r in dumps.sample_files(df, 0.3, seed=1).collect()}
    again = {r.path for r in dumps.sample_files(df.repartition(7), 0.3, seed=1).collect()}
    assert first == again
    assert 2700 < len(first) < 3300
    assert dumps.sample_files(df, 1.0).count() == 10_000
    assert dumps.sample_files(df, 0.0).count() == 0


def test_stopwords_are_verbatim(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the\nThe\n and\nthe\n")
    assert sorted(r.term for r in tables.read_stopwords(spark, str(tmp_path / "stop.txt")).collect()) == [" and", "The", "the"]


def test_read_sensors(spark, tmp_path):
    (tmp_path / "Run_1.csv").write_text("1,2.5,3\n4,5.5,6\n")
    (tmp_path / "Run_2.csv").write_text("7,8.5,9\n")
    (tmp_path / "notes.txt").write_text("x\n")
    df = tables.read_sensors(spark, str(tmp_path))
    assert tables.sensor_columns(df) == ["sensor_1", "sensor_2", "sensor_3"]
    files = {r[0].rsplit("/", 1)[1]: r[1] for r in df.groupBy("source_file").count().collect()}
    assert files == {"Run_1.csv": 2, "Run_2.csv": 1}
    assert tables.read_sensors(spark, f"{tmp_path}/Run_1*").count() == 2


def test_stable_id_with_hot_copies(spark):
    rows = [(1.0, "a")] * 25 + [(2.0, "b")] * 3 + [(None, "c")]
    df = spark.createDataFrame(rows, "x double, f string")
    one = tables.with_stable_id(df, rows_per_task=4)
    other = tables.with_stable_id(df.repartition(5), rows_per_task=100)
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, other.collect()), key=repr)
    assert one.select("point_id").distinct().count() == len(rows)
    assert {r.f: r["count"] for r in one.groupBy("f").count().collect()} == {"a": 25, "b": 3, "c": 1}
    numbered = tables.with_point_id(df)
    assert numbered.select("point_id").distinct().count() == len(rows)


def test_read_labelled(spark, tmp_path):
    (tmp_path / "kdd.csv").write_text("0,tcp,http,SF,181,5450,normal.\n0,udp,dns,SF,1,2,smurf.\n")
    row = tables.read_labelled(spark, str(tmp_path / "kdd.csv"), width=7).orderBy("label").head()
    assert (row.number_0, row.protocol, row.service, row.state, row.number_4, row.number_5, row.label) == (0.0, "tcp", "http", "SF", 181.0, 5450.0, "normal.")


@pytest.mark.parametrize("bad", ["x", "", "1,2"])
def test_read_labelled_refuses_what_is_no_number(spark, tmp_path, bad):
    (tmp_path / "kdd.csv").write_text(f"0,tcp,http,SF,181,{bad},normal.\n")
    with pytest.raises(Exception, match="no number in number_5" if bad != "1,2" else "not 7 fields"):
        tables.read_labelled(spark, str(tmp_path / "kdd.csv"), width=7).collect()


def test_read_movies(spark, tmp_path):
    header = "Release Year,Title,Origin/Ethnicity,Director,Cast,Genre,Wiki Page,Plot\n"
    body = '1999,"Up, down",US,D,C,"drama, comedy",w,"He said ""go"".\nThen left."\n'
    (tmp_path / "m.csv").write_text(header + body)
    row = tables.read_movies(spark, str(tmp_path / "m.csv")).head()
    assert tuple(row) == ("Up, down", "drama, comedy", 'He said "go".\nThen left.')


def test_read_survey(spark, tmp_path):
    values = ["1.5" if c in tables.SURVEY_NUMBERS else "No" for c in tables.SURVEY_COLUMNS]
    (tmp_path / "s.csv").write_text(",".join(tables.SURVEY_COLUMNS) + "\n" + ",".join(values) + "\n")
    df = tables.read_survey(spark, str(tmp_path / "s.csv"))
    assert len(df.columns) == 18
    assert (df.head().BMI, df.head().Sex) == (1.5, "No")


def test_sinks(spark, folder):
    outliers = spark.createDataFrame([(2, 1, "f", 0, 3.5), (3, 1, "f", 1, 2.5)], "k int, point_id long, source_file string, prediction int, distance double")
    sinks.write_outliers(outliers, f"{folder}/o")
    assert spark.read.option("header", True).csv(f"{folder}/o/k=3").head().distance == "2.5"
    summary = spark.createDataFrame([(2, 1.5, 9.0)], "k int, avg_distance double, runtime_seconds double")
    sinks.write_runtimes(summary, f"{folder}/r")
    sinks.write_scores(summary, f"{folder}/s")
    assert spark.read.option("header", True).csv(f"{folder}/r").columns == ["k", "runtime_seconds"]
    assert spark.read.option("header", True).csv(f"{folder}/s").columns == ["k", "avg_distance"]
    for _ in range(2):
        sinks.append_run(summary, f"{folder}/a")
    assert spark.read.option("header", True).csv(f"{folder}/a").count() == 2
    scored = spark.createDataFrame([(1, [1.0, 2.5])], "prediction int, features array<double>")
    sinks.dump_clusters(scored, f"{folder}/d")
    assert spark.read.text(f"{folder}/d").head().value == "1,1.0,2.5"
    assert outliers.where(F.col("k") == 2).count() == 1
