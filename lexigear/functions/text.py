"""Column expressions over text and token arrays.  All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a token.
WORDS_OR_DIGITS = r"[a-z]+|\p{Nd}+"
WORDS_OR_DECIMALS = r"[a-z]+|[0-9]+(\.[0-9]*)?"
LETTERS = r"\p{L}+"
NON_WORD = r"[^\p{L}\p{N}_]+"


def matches(text: Column | str, pattern: str) -> Column:
    """All matches of ``pattern`` in the lower-cased text, in order."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def longer_than(tokens: Column, length: int) -> Column:
    return F.filter(tokens, lambda t: F.length(t) > length)


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times inside ``body``.

    A lambda variable is evaluated once per row, whatever the optimizer does with
    neighbouring projections.
    """
    return F.transform(F.array(value), body)[0]


def run_lengths(tokens: Column) -> Column:
    """Count equal tokens of one row: ``array<struct<term, tf>>`` in term order.

    Sorting the row's own tokens makes equal ones neighbours, so the count is the
    distance between run starts.  No shuffle is needed, as a document is one row.
    """

    def count(run):
        # Element 0 of ``edges`` is 1; each later element starts a new term; the
        # last is one past the end.
        def edges(s):
            inner = F.filter(
                F.sequence(F.lit(1), F.size(s)),
                lambda i: (i == 1) | (F.get(s, i - 1) != F.get(s, i - 2)),
            )
            return F.concat(inner, F.array(F.size(s) + 1))

        return let(
            edges(run),
            lambda e: F.transform(
                F.slice(e, 1, F.size(e) - 1),
                lambda start, i: F.struct(
                    F.get(run, start - 1).alias("term"),
                    (F.get(e, i + 1) - start).cast("long").alias("tf"),
                ),
            ),
        )

    empty = F.array().cast("array<struct<term:string,tf:bigint>>")
    return F.when(F.size(tokens) > 0, let(F.sort_array(tokens), count)).otherwise(empty)


def joined(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def hash_order(key: Column, seed: int) -> Column:
    """A repeatable pseudo-random order that does not depend on partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_fraction(key: Column, seed: int) -> Column:
    """A repeatable uniform draw in [0, 1): the first 32 bits of ``hash_order``."""
    bits = F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("double")
    return bits / F.lit(float(2**32))
