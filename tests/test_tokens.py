import pytest
from pyspark.sql import functions as F

from lexigear.operators import tokens as tk

TEXTS = [
    "The Quick brown foxes: café abc123 3.14 1234 a ab abc",
    "١٢٣٤ naïve Über straße THE",
    "",
    "x 12 ab",
    "pi 3.14159 and 10. or 7",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def listed(df, column="features", key="doc_id"):
    return [r[column] for r in df.orderBy(key).select(column).collect()]


def test_regex_tokens(docs):
    expected = [["quick", "brown", "foxes", "caf", "abc", "123", "1234", "abc"], ["١٢٣٤", "ber", "stra"], [], [], ["14159", "and"]]
    assert listed(tk.tokens_regex(docs, stop_words=["the"])) == expected


def test_exercise_tokens_keep_decimals(docs):
    found = listed(tk.tokens_exercise(docs, stop_words=["the", "and"]))
    assert found[4] == ["3.14159", "10."]
    assert "3.14" in found[0]


def test_split_keeps_empty_strings(docs):
    expected = [
        ["the", "quick", "brown", "foxes", "café", "abc123", "3", "14", "1234", "a", "ab", "abc"],
        ["١٢٣٤", "naïve", "über", "straße", "the"], [""], ["x", "12", "ab"], ["pi", "3", "14159", "and", "10", "or", "7"],
    ]
    assert listed(tk.tokens_split(docs)) == expected


def test_filter_terms(spark):
    df = spark.createDataFrame([(1, ["ab", "abc", "ab1", "the", "été"])], "doc_id long, features array<string>")
    assert listed(tk.filter_terms(df, stop_words=["the"], alpha_only=True)) == [["abc", "été"]]


def test_long_stop_lists_give_the_same_result(spark, docs):
    words = spark.createDataFrame([("the",), ("brown",), ("unused",)], "term string")
    plain = tk.tokens_regex(docs, stop_words=[])
    short = tk.drop_words(plain, words)
    joined = tk.drop_words(plain, words, max_list=0)
    assert listed(short) == listed(joined)
    assert listed(joined)[2] == []


LEXICON = ["wolf", "box", "city", "bus", "man", "dress", "woman", "church", "house"]


def test_lemmas(spark):
    text = "Wolves boxes cities buses men dress xyzs women churches houses Bus"
    docs = spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id long, text string")
    lexicon = spark.createDataFrame([(w,) for w in LEXICON], "lemma string")
    found = listed(tk.tokens_lemma(docs, lexicon=lexicon, stop_words=[]))
    assert found[0] == "wolf box city bus man dress xyzs woman church house bus".split()
    assert found[1] == [] and not found[2]


def test_lemma_exceptions_and_large_maps(spark):
    words = spark.createDataFrame(
        [(i, ["mice", "wolves", "cat"] if i % 2 else []) for i in range(40)], "doc_id long, features array<string>"
    )
    lexicon = spark.createDataFrame([("mouse",), ("wolf",), ("cat",)], "lemma string")
    exceptions = spark.createDataFrame([("mice", "mouse")], "form string, lemma string")
    listed_map = tk.lemmatize(words, lexicon, exceptions)
    joined_map = tk.lemmatize(words, lexicon, exceptions, max_map=0)
    assert listed(listed_map) == listed(joined_map)
    assert listed(listed_map)[1] == ["mouse", "wolf", "cat"]


def test_joined_lemmas_of_forms_with_and_without_ending(spark):
    """Keys and words of the lexicon may repeat; an exception may concern any form."""
    texts = ["Geese and mice chase Wolves, men, foxes", "buses buses geese", None, "", "women ladies dress mens"]
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    lexicon = spark.createDataFrame([(w,) for w in ["goose", "mouse", "mouse", "wolf", "man", "fox", "bus", "bus", "woman", "lady", None]], "lemma string")
    exceptions = spark.createDataFrame([("geese", "goose"), ("mice", "mouse"), ("mens", "man"), ("dress", None)], "form string, lemma string")

    def found(max_map, **options):
        rows = tk.tokens_lemma(docs, stop_words=[], lexicon=lexicon, max_map=max_map, **options).select("doc_id", "text", "features")
        return sorted((r.doc_id, r.text or "", r.features) for r in rows.collect())

    for options in ({}, {"exceptions": exceptions}):
        assert found(0, **options) == found(1000, **options)
    assert found(0)[0][2] == "geese and mice chase wolf man fox".split()
    assert found(0, exceptions=exceptions)[0][2] == "goose and mouse chase wolf man fox".split()
    assert found(0, exceptions=exceptions)[4][2] == "woman lady dress man".split()


def test_lemma_map_skips_forms_without_rule(spark):
    """Only forms with an ending, or an exception, are matched with the lexicon."""
    terms = spark.createDataFrame([("cats",), ("cat",), ("mice",), ("dog",), (None,)], "form string")
    lexicon = spark.createDataFrame([("cat",), ("mouse",), ("dog",)], "lemma string")
    exceptions = spark.createDataFrame([("mice", "mouse")], "form string, lemma string")
    pairs = lambda *a: sorted(map(tuple, tk.lemma_map(terms, lexicon, *a).collect()))
    assert pairs() == [("cats", "cat")] and pairs(exceptions) == [("cats", "cat"), ("mice", "mouse")]
    assert "EndsWith" in tk.lemma_map(terms, lexicon)._jdf.queryExecution().optimizedPlan().toString().split("Generate")[-1].partition("\n")[2]


def test_joined_lemmas_deal_out_little(spark):
    """Forms without an ending are not exploded for the join, and the rows meet their pairs as texts."""
    docs = spark.createDataFrame([(1, "wolves wolf the"), (2, None)], "doc_id long, text string")
    plan = tk.tokens_lemma(docs, max_map=0)._jdf.queryExecution().optimizedPlan().toString()
    exploded = next(x for x in plan.splitlines() if "Generate explode" in x)
    assert "EndsWith" in exploded
    rows, _, pairs = plan.partition("Join LeftOuter")[2].partition("Aggregate")
    assert "regexp_extract_all" not in rows and "regexp_extract_all" in pairs


def test_shortest_candidate_wins_with_own_vocabulary(spark):
    docs = spark.createDataFrame([(1, "cats cat glass dog")], "doc_id long, text string")
    assert listed(tk.tokens_lemma(docs, stop_words=[])) == [["cat", "cat", "glass", "dog"]]


def test_compare(spark):
    left = spark.createDataFrame([("a", 2), ("b", 1)], "term string, df long")
    right = spark.createDataFrame([("b", 3), ("c", 1)], "term string, df long")
    rows = {r.term: (r.left_df, r.right_df, r.found_in) for r in tk.compare_vocabularies(left, right).collect()}
    assert rows == {"a": (2, None, "left"), "b": (1, 3, "both"), "c": (None, 1, "right")}
    tops = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c")], "concept int, term string")
    pair = tk.compare_concepts(tops, tops.where(F.col("term") != "c")).collect()
    assert [(r.left_concept, r.right_concept, r.shared_terms, r.terms) for r in pair] == [(0, 0, 2, ["a", "b"])]
