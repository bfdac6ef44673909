"""Tokenizers.  Each adds an array column of terms and leaves a document one row."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigear.functions import text as fx
from lexigear.functions.stopwords import ENGLISH
from lexigear.shared import through_table

FEATURES = "features"

# A word list up to this size travels with the plan; a longer one is joined.  Both give
# the same rows.
MAX_LIST = 10_000
# Lemma pairs that are shipped to the tasks (some 4 MB); more are joined, with the same result.
MAX_PAIRS = 100_000
# Tokens that a task's Python looks up at a time.
TOKENS_PER_STEP = 200_000

# Noun endings and what replaces them.
NOUN_SUFFIXES = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
)


def _empty() -> Column:
    return F.array().cast("array<string>")


def _without_joined(df: DataFrame, words: DataFrame, column: str, key: str) -> DataFrame:
    """Anti join for word lists too long to ship.

    The list is first cut to the terms the documents use.  What is left decides the
    join: AQE turns it into a broadcast when it is small and splits hot terms when not.
    """
    tokens = df.select(key, F.posexplode(column).alias("_pos", "term"))
    used = words.join(tokens.select("term").distinct(), "term", "left_semi")
    kept = (
        tokens.join(used, "term", "left_anti")
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("_pos", "term"))).alias("_kept"))
    )
    restored = F.coalesce(F.col("_kept.term"), _empty())
    return df.join(kept, key, "left").withColumn(column, restored).drop("_kept")


def drop_words(
    df: DataFrame, stop_words: DataFrame | list[str] | None, column: str = FEATURES,
    key: str = "doc_id", max_list: int = MAX_LIST,
) -> DataFrame:
    """Remove stop words.  ``None`` means the built-in English list.

    A null in the list stops nothing, and a null token array counts as empty.
    """
    df = df.withColumn(column, F.coalesce(column, _empty()))
    if stop_words is None:
        stop_words = ENGLISH
    if isinstance(stop_words, DataFrame):
        stop_words = stop_words.where("term IS NOT NULL")
        listed = [r.term for r in stop_words.select("term").limit(max_list + 1).collect()]
        if len(listed) > max_list:
            return _without_joined(df, stop_words, column, key)
        stop_words = listed
    stop_words = [w for w in stop_words if w is not None]
    if not stop_words:
        return df
    # A long IN list becomes one hash set, looked up once per token.
    return df.withColumn(column, F.filter(column, lambda t: ~t.isin(stop_words)))


def filter_terms(
    df: DataFrame, column: str = FEATURES, min_length: int = 3, stop_words=None,
    alpha_only: bool = False, key: str = "doc_id",
) -> DataFrame:
    """The filters all tokenizers share: length, letters only, stop words."""
    kept = fx.longer_than(F.col(column), min_length - 1)
    if alpha_only:
        kept = F.filter(kept, lambda t: F.regexp_like(t, F.lit(f"^{fx.LETTERS}$")))
    return drop_words(df.withColumn(column, kept), stop_words, column, key)


def tokens_regex(df: DataFrame, text: str = "text", stop_words=None, key: str = "doc_id") -> DataFrame:
    """ASCII words and digit runs of the lower-cased text, filtered."""
    return filter_terms(
        df.withColumn(FEATURES, fx.matches(text, fx.WORDS_OR_DIGITS)), stop_words=stop_words, key=key
    )


def tokens_exercise(df: DataFrame, text: str = "text", stop_words=None, key: str = "doc_id") -> DataFrame:
    """Like ``tokens_regex``, but a number may carry a decimal part."""
    return filter_terms(
        df.withColumn(FEATURES, fx.matches(text, fx.WORDS_OR_DECIMALS)), stop_words=stop_words, key=key
    )


def tokens_split(df: DataFrame, text: str = "text") -> DataFrame:
    """Split at non-word runs, without any filter; empty strings stay.  Null text has no token."""
    return df.withColumn(FEATURES, F.coalesce(F.split(F.lower(F.col(text)), fx.NON_WORD, -1), _empty()))


def lemma_candidates(terms: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """``form, candidate``: the form itself, its exceptions and its suffix variants."""
    form = F.col("form")
    variants = [form] + [
        F.when(
            form.endswith(old),
            F.concat(F.substring(form, F.lit(1), F.length(form) - len(old)), F.lit(new)),
        )
        for old, new in NOUN_SUFFIXES
    ]
    options = terms.select(form, F.explode(F.array_compact(F.array(*variants))).alias("candidate"))
    if exceptions is not None:
        listed = terms.join(exceptions, "form").select("form", F.col("lemma").alias("candidate"))
        options = options.unionByName(listed)
    return options


def _has_ending(form: Column) -> Column:
    """Whether a suffix rule applies to ``form``; other forms have a lemma by an exception only."""
    # "ches" also ends with "s": an ending that has another one at its end needs no test.
    endings = [old for old, _ in NOUN_SUFFIXES]
    least = [e for e in endings if not any(e != other and e.endswith(other) for other in endings)]
    return reduce(or_, [form.endswith(e) for e in least])


def lemma_map(terms: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """``form, lemma`` for the distinct ``form``s whose lemma differs from the form.

    A lemma is the shortest candidate the ``lexicon(lemma)`` knows, ties in
    alphabetical order.  A form without known candidate is its own lemma.
    """
    # Other forms have no candidate but themselves.
    ruled = _has_ending(F.col("form"))
    some = terms.where(ruled)
    if exceptions is not None:
        some = some.unionByName(terms.where(~ruled).join(exceptions, "form", "left_semi"))
    best = (
        lemma_candidates(some, exceptions)
        .join(lexicon.select(F.col("lemma").alias("candidate")), "candidate", "left_semi")
        .groupBy("form")
        .agg(F.min(F.struct(F.length("candidate").alias("n"), "candidate")).alias("best"))
    )
    return best.select("form", F.col("best.candidate").alias("lemma")).where("form <> lemma")


def _slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The batches in slices of about ``TOKENS_PER_STEP`` tokens, or one row.

    What is made of a slice is handed on before the next, and the memory of a batch given
    back, so that a worker does not hold more the more batches it has seen.
    """
    pool = pa.default_memory_pool()
    for batch in batches:
        column = batch.field(0) if pa.types.is_struct(batch.type) else batch
        ends = pc.cumulative_sum(pc.coalesce(pc.list_value_length(column), pa.scalar(0, pa.int32()))).to_numpy()
        first = 0
        while first < len(batch):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + TOKENS_PER_STEP, "right")))
            yield batch.slice(first, last - first)
            first = last
        del batch, column, ends
        pool.release_unused()


def _lists(old: pa.Array, new: pa.Array) -> pa.Array:
    """``new`` cut into lists like those of ``old``; a null list becomes an empty one."""
    # ``flatten`` starts at the first row of the batch, so the offsets do too.
    ends = pc.cumulative_sum(pc.coalesce(pc.list_value_length(old), pa.scalar(0, pa.int32())))
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends.cast(pa.int32())])
    return pa.ListArray.from_arrays(offsets, new)


def _lemmas_of(tokens: pa.Array, forms: pa.Array, lemmas: pa.Array) -> pa.Array:
    """Every token that is one of ``forms`` replaced by its lemma, without Python strings."""
    return pc.coalesce(lemmas.take(pc.index_in(tokens, value_set=forms)), tokens)


def _replace_listed(df: DataFrame, pairs: list, column: str) -> DataFrame:
    """Replace forms by lemmas inside the rows.  Only the token column passes through
    Python, and a task builds its lookup once."""
    forms = pa.array([p.form for p in pairs], pa.string())
    lemmas = pa.array([p.lemma for p in pairs], pa.string())

    @F.arrow_udf("array<string>")
    def replace(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for old in _slices(batches):
            yield _lists(old, _lemmas_of(old.flatten().cast(pa.string()), forms, lemmas))

    return df.withColumn(column, replace(column))


def _replace_joined(df: DataFrame, mapping: DataFrame, words: Column, column: str, key: str, ruled: bool) -> DataFrame:
    """Replacement for maps too large to ship.

    Only the distinct forms of a document that have a lemma are joined and gathered, so a
    frequent form is one row per document and most forms are none after the join.  With
    ``ruled`` the map has only forms that a suffix rule changes, so no others are joined.
    The pairs meet the rows before their tokens are made, which are larger than a text.
    """
    forms = F.filter(words, _has_ending) if ruled else words
    changed = df.select(key, F.explode(F.array_distinct(forms)).alias("form")).join(mapping, "form")
    pair = F.struct("form", "lemma")
    own = changed.groupBy(key).agg(F.collect_set(pair).alias("_pairs"))

    @F.arrow_udf("array<string>")
    def replace(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in _slices(batches):
            old, forms, lemmas = (rows.field(i) for i in range(3))
            tokens = old.flatten().cast(pa.string())
            # A form has one lemma in all documents, so the pairs of a slice are one lookup.
            codes = forms.flatten().cast(pa.string()).dictionary_encode()
            listed = pa.array(np.unique(codes.indices, return_index=True)[1])
            found = _lemmas_of(tokens, codes.dictionary, lemmas.flatten().cast(pa.string()).take(listed))
            # A row without pairs, as one without key, keeps its tokens.
            sizes = pc.coalesce(pc.list_value_length(old), pa.scalar(0, pa.int32()))
            paired = np.repeat(forms.is_valid().to_numpy(zero_copy_only=False), sizes)
            yield _lists(old, pc.if_else(pa.array(paired, pa.bool_()), found, tokens))

    replaced = replace(F.struct(words.alias("old"), F.col("_pairs.form").alias("forms"), F.col("_pairs.lemma").alias("lemmas")))
    return df.join(own, key, "left").withColumn(column, replaced).drop("_pairs")


def lexicon_of(df: DataFrame, column: str = FEATURES) -> DataFrame:
    """``lemma``: the distinct terms of the documents, written out for reuse."""
    return through_table(df.select(F.explode(F.array_distinct(column)).alias("lemma")).distinct(), "terms")


def lemmatize(
    df: DataFrame, lexicon: DataFrame | None = None, exceptions: DataFrame | None = None,
    column: str = FEATURES, key: str = "doc_id", max_map: int = MAX_PAIRS, words: Column | None = None,
) -> DataFrame:
    """Replace every token by its lemma.

    The rules run once per distinct term.  Without a lexicon, the documents' own terms
    serve as one.  The tokens are those of ``column``, or ``words``, which then become it.
    """
    words = F.col(column) if words is None else words
    with_words = df.withColumn(column, words)
    if lexicon is None:
        # Used on both sides of a join: tokenize once, read the distinct terms twice.
        lexicon = lexicon_of(with_words, column)
        terms = lexicon.toDF("form")
    else:
        terms = with_words.select(F.explode(F.array_distinct(column)).alias("form")).distinct()
    mapping = lemma_map(terms, lexicon, exceptions)
    pairs = mapping.limit(max_map + 1).collect()
    if len(pairs) > max_map:
        # As a table its size is known when the join is planned.
        mapping = through_table(mapping, "lemmas")
        return _replace_joined(df, mapping, words, column, key, ruled=exceptions is None)
    return _replace_listed(with_words, pairs, column)


def tokens_lemma(
    df: DataFrame, text: str = "text", stop_words=None, lexicon: DataFrame | None = None,
    exceptions: DataFrame | None = None, key: str = "doc_id", max_map: int = MAX_PAIRS,
) -> DataFrame:
    """Letter runs, lower-cased and lemmatized, then filtered."""
    words = fx.matches(text, fx.LETTERS)
    lemmas = lemmatize(df, lexicon, exceptions, key=key, max_map=max_map, words=words)
    return filter_terms(lemmas, stop_words=stop_words, alpha_only=True, key=key)


def with_features(df: DataFrame, text: str, key: str = "doc_id", **options) -> DataFrame:
    """A table plus the ``features`` array of its lemmatized text column."""
    return tokens_lemma(df, text, key=key, **options)


def compare_vocabularies(left: DataFrame, right: DataFrame) -> DataFrame:
    """Document frequency of every term under two tokenizers, and who has the term.

    Both inputs are ``term, df``.
    """
    both = left.select("term", F.col("df").alias("left_df")).join(
        right.select("term", F.col("df").alias("right_df")), "term", "full_outer"
    )
    found = (
        F.when(F.col("right_df").isNull(), "left")
        .when(F.col("left_df").isNull(), "right")
        .otherwise("both")
    )
    return both.withColumn("found_in", found)


def compare_concepts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Shared top terms of every pair of concepts that share any.

    Both inputs are ``concept, term`` lists of top terms; they hold at most a few
    hundred rows, as concepts and terms per concept are both bounded reports.
    """
    shared = left.select(F.col("concept").alias("left_concept"), "term").join(
        right.select(F.col("concept").alias("right_concept"), "term"), "term"
    )
    return shared.groupBy("left_concept", "right_concept").agg(
        F.count("*").alias("shared_terms"),
        F.array_sort(F.collect_set("term")).alias("terms"),
    )
