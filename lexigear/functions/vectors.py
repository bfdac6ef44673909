"""Array arithmetic as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigear.functions.text import let


def literal(values: Sequence[float]) -> Column:
    """One array literal (not one literal per element)."""
    return F.lit(np.asarray(values, dtype=np.float64))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(total(F.transform(a, lambda x: x * x)))


def scale(a: Column, factors: Sequence[float]) -> Column:
    return F.zip_with(a, literal(factors), lambda x, y: x * y)


def unit(a: Column) -> Column:
    """The array divided by its length; null for a zero array."""
    return let(norm(a), lambda n: F.when(n > 0, F.transform(a, lambda x: x / n)))


def square(x: Column) -> Column:
    return x * x


# Up to this many differences distances are written out and join whole-stage code
# generation; more would make code that takes long to compile.  Same numbers either way.
UNROLL_LIMIT = 32


def squared_distance(a: Column, b: Column, width: int | None = None) -> Column:
    """Null if an array is null or, given the ``width`` of both, of another one."""
    if width is None or width > UNROLL_LIMIT:
        return total(F.zip_with(a, b, lambda x, y: square(x - y)))
    parts = [square(F.get(a, F.lit(j)) - F.get(b, F.lit(j))) for j in range(width)]
    return F.when(F.size(a) == width, sum(parts[1:], parts[0]) if parts else F.lit(0.0))


def matrix(rows: Sequence[Sequence[float]]) -> Column:
    """A small matrix as one array-of-arrays literal."""
    return F.array(*[literal(row) for row in rows])


def with_nearest(df: DataFrame, features: str, centers: Sequence[Sequence[float]]) -> DataFrame:
    """Add ``prediction`` (int) and ``distance`` (double) to the nearest center.

    Equal distances go to the lowest cluster number.  Null features give a null
    cluster and a null distance.  The distances get a column of their own because two
    results are read from them: the optimizer keeps such a projection apart.
    """
    own = F.col(features)
    width = len(centers[0]) if len(centers) else 0
    if 0 < len(centers) * width <= UNROLL_LIMIT:
        distances = F.array(*[squared_distance(own, literal(c), width) for c in centers])
    else:
        distances = F.transform(matrix(centers), lambda c: squared_distance(own, c))
    return (
        df.withColumn("_d2", F.when(own.isNotNull(), distances))
        .withColumn("_min", F.array_min("_d2"))
        .withColumn("prediction", (F.array_position("_d2", F.col("_min")) - 1).cast("int"))
        .withColumn("distance", F.sqrt("_min"))
        .drop("_d2", "_min")
    )
