"""Numeric features: assembling, scaling, one-hot encoding.

Features are arrays of doubles.  Where the array is built from columns, the optimizer
reads the columns and scoring stays in generated code; Spark ML takes arrays as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigear.functions.vectors import literal
from lexigear.shared import numbered_rows, shared_folder, through_table

FEATURES = "features"

# Up to this many dimensions scaling is written out and joins whole-stage code
# generation; beyond it the generated code would outgrow what the JVM compiles.  Both
# forms give the same rows; a null array stays null.
UNROLL_LIMIT = 64


def assemble(df: DataFrame, columns: Sequence[str], out: str = FEATURES) -> DataFrame:
    """Numeric columns as one array.  A null or NaN is an error."""

    def checked(name: str) -> Column:
        value = F.col(name).cast("double")
        bad = value.isNull() | F.isnan(value)
        return F.when(bad, F.raise_error(F.lit(f"null or NaN in column {name}")).cast("double")).otherwise(value)

    return df.withColumn(out, F.array(*[checked(c) for c in columns]))


@dataclass(frozen=True)
class Scaling:
    """One shift and one factor per dimension; fitted once, applied to any frame."""

    means: Sequence[float]
    factors: Sequence[float]

    def apply(self, df: DataFrame, column: str = FEATURES, out: str = FEATURES) -> DataFrame:
        if len(self.means) <= UNROLL_LIMIT:
            parts = [
                (F.get(column, F.lit(j)) - m) * f for j, (m, f) in enumerate(zip(self.means, self.factors))
            ]
            return df.withColumn(out, F.when(F.col(column).isNotNull(), F.array(*parts)))
        shifted = F.zip_with(column, literal(self.means), lambda x, m: x - m)
        return df.withColumn(out, F.zip_with(shifted, literal(self.factors), lambda x, f: x * f))


def _moments(df: DataFrame, column: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Mean and sample deviation per dimension and the number of arrays, in one
    aggregation that keeps two numbers per dimension; null arrays do not count."""
    vector = array_to_vector(F.col(column)).alias("v")
    found = df.where(F.col(column).isNotNull()).select(vector).select(
        Summarizer.metrics("mean", "std", "count").summary(F.col("v")).alias("m")
    )
    m = found.head().m
    return m.mean.toArray(), m.std.toArray(), m["count"]


def standard_scaling(df: DataFrame, column: str = FEATURES) -> Scaling:
    """Sample standard deviation; a constant dimension becomes 0."""
    means, deviations, _ = _moments(df, column)
    return Scaling(means.tolist(), [1.0 / d if d else 0.0 for d in deviations.tolist()])


def population_scaling(df: DataFrame, column: str = FEATURES) -> Scaling:
    """Population standard deviation; a constant dimension is only shifted."""
    means, deviations, n = _moments(df, column)
    deviations = deviations * np.sqrt((n - 1) / n) if n else deviations
    return Scaling(means.tolist(), [1.0 / d if d > 0 else 1.0 for d in deviations.tolist()])


def standardize(df: DataFrame, column: str = FEATURES) -> DataFrame:
    return standard_scaling(df, column).apply(df, column)


def normalize_pop(df: DataFrame, column: str = FEATURES) -> DataFrame:
    return population_scaling(df, column).apply(df, column)


def categories(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """Distinct values per column in alphabetical order, from one pass, on the driver.

    For the dense encoding, which writes them all into every row; ``category_index`` keeps
    any number of them in a table.
    """
    rows = _values(df, columns).distinct().toArrow()
    found: dict[str, list] = {c: [] for c in columns}
    for name, value in zip(rows.column("name").to_pylist(), rows.column("value").to_pylist()):
        found[name].append(value)
    return {c: sorted(v) for c, v in found.items()}


def _values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``name, value`` of the categorical columns; nulls are no values."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.*").where("value IS NOT NULL")


def one_hot(
    df: DataFrame, first: str, categorical: Sequence[str], numeric: Sequence[str],
    values: dict[str, list] | None = None, out: str = FEATURES,
) -> DataFrame:
    """Array of the first number, one 0/1 per category (all kept), and the other numbers.

    Unknown and null values have no flag set.  A few categories are written out and join
    whole-stage code generation; of more, the flags of a column are one expression over the
    list of its categories.  Of very many take ``one_hot_sparse``.
    """
    if values is None:
        values = categories(df, categorical)
    first_number, numbers = F.col(first).cast("double"), [F.col(c).cast("double") for c in numeric]

    def flag(name: str, value: Column | str) -> Column:
        return F.coalesce((F.col(name).cast("string") == value).cast("double"), F.lit(0.0))

    if sum(map(len, values.values())) <= UNROLL_LIMIT:
        return df.withColumn(out, F.array(first_number, *[flag(c, v) for c in categorical for v in values[c]], *numbers))

    def flags(name: str) -> Column:
        listed = F.lit(values[name]) if values[name] else F.array().cast("array<string>")
        return F.transform(listed, lambda v: flag(name, v))

    return df.withColumn(out, F.concat(F.array(first_number), *map(flags, categorical), F.array(*numbers).cast("array<double>")))


# Sparse rows: many categories

# Index tables up to so many rows are shipped to the tasks, larger ones joined by shuffle.
MAX_SHIPPED_CATEGORIES = 200_000


@dataclass(frozen=True)
class CategoryIndex:
    """``table`` has ``name, value, at``, values of a column counted alphabetically from 0;
    ``sizes`` the number of values of each column."""

    table: DataFrame
    sizes: dict[str, int]

    def offsets(self, columns: Sequence[str]) -> dict[str, int]:
        """Places of the columns' first flags, behind the first number."""
        out, at = {}, 1
        for c in columns:
            out[c], at = at, at + self.sizes[c]
        return out


def category_index(df: DataFrame, columns: Sequence[str]) -> CategoryIndex:
    """The index of any number of categories; only a count per column reaches the driver."""
    numbered = numbered_rows(_values(df, columns).distinct(), "name", "value")
    starts = {r.name: (r.first, r.n) for r in numbered.groupBy("name").agg(F.min("no").alias("first"), F.count("*").alias("n")).collect()}
    first = F.create_map(*[F.lit(x) for c, (no, _) in starts.items() for x in (c, no)]) if starts else F.lit(None)
    at = (F.col("no") - first[F.col("name")]).cast("int") if starts else F.lit(0)
    table = through_table(numbered.select("name", "value", at.alias("at")), "categories")
    return CategoryIndex(table, {c: starts[c][1] if c in starts else 0 for c in columns})


def with_places(df: DataFrame, columns: Sequence[str], index: CategoryIndex, max_shipped: int = MAX_SHIPPED_CATEGORIES) -> DataFrame:
    """Add ``_at_<column>``, the place of each value among its column's; null for unknown
    and null values."""
    for c in columns:
        own = index.table.where(F.col("name") == c).select(F.col("value").alias("_value"), F.col("at").alias(f"_at_{c}"))
        own = F.broadcast(own) if index.sizes[c] <= max_shipped else own
        df = df.join(own, F.col(c).cast("string") == F.col("_value"), "left").drop("_value")
    return df


def one_hot_sparse(
    df: DataFrame, first: str, categorical: Sequence[str], numeric: Sequence[str],
    index: CategoryIndex | None = None, out: str = FEATURES, max_shipped: int = MAX_SHIPPED_CATEGORIES,
) -> DataFrame:
    """The rows of ``one_hot`` as ``size, indices, values``, without their zero flags.

    A row holds as many entries as there are columns, however many categories they have.
    The categories stay in a table, which is joined once for each column.
    """
    index = index or category_index(df, categorical)
    offsets, size = index.offsets(categorical), 1 + sum(index.sizes[c] for c in categorical)

    def entry(at: Column, value: Column) -> Column:
        return F.struct(at.cast("int").alias("i"), value.cast("double").alias("v"))

    flags = [entry(F.col(f"_at_{c}") + offsets[c], F.lit(1.0)) for c in categorical]
    numbers = [entry(F.lit(size + j), F.col(c)) for j, c in enumerate(numeric)]
    entries = F.filter(F.array(entry(F.lit(0), F.col(first)), *flags, *numbers), lambda e: e["i"].isNotNull())
    rows = with_places(df, categorical, index, max_shipped).withColumn("_entries", entries)
    made = F.struct(F.lit(size + len(numeric)).alias("size"), F.col("_entries.i").alias("indices"), F.col("_entries.v").alias("values"))
    return rows.withColumn(out, made).drop("_entries", *[f"_at_{c}" for c in categorical])


def sparse_vectors(df: DataFrame, column: str = FEATURES) -> DataFrame:
    """``df`` with sparse rows as the vectors of Spark ML, written to the shared folder.

    A vector is stored as a struct of just these fields, so the rows are written as that and
    read as vectors; no row passes through Python.
    """
    as_stored = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.col(column)["size"].alias("size"),
        F.col(column)["indices"].alias("indices"), F.col(column)["values"].alias("values"),
    )
    spark, path = df.sparkSession, shared_folder(df.sparkSession, "vectors")
    rows = df.withColumn(column, F.when(F.col(column).isNotNull(), as_stored))
    rows.write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT() if f.name == column else f.dataType) for f in rows.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def scale_vectors(df: DataFrame, column: str = FEATURES) -> DataFrame:
    """Vectors divided by the population deviation of each dimension, sparse as before.

    ``normalize_pop`` without its shift, which moves all points alike: distances, and so
    clusters, are the same.  A constant dimension is left as it is.
    """
    rows = df.where(F.col(column).isNotNull()).select(Summarizer.metrics("std", "count").summary(F.col(column)).alias("m"))
    m = rows.head().m
    deviations = m.std.toArray() * np.sqrt((m["count"] - 1) / m["count"]) if m["count"] else m.std.toArray()
    factors = np.divide(1.0, deviations, out=np.ones_like(deviations), where=deviations > 0)
    scaling = ElementwiseProduct(scalingVec=Vectors.dense(factors), inputCol=column, outputCol="_scaled")
    return scaling.transform(df).drop(column).withColumnRenamed("_scaled", column)


def drop_categoricals(df: DataFrame, first: str, numeric: Sequence[str], out: str = FEATURES) -> DataFrame:
    """Array of the numeric fields only."""
    return assemble(df, [first, *numeric], out)


def as_matrix(centers: Sequence[Sequence[float]]) -> list[list[float]]:
    return np.asarray(centers, dtype=float).tolist()
