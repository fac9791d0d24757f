"""Vector functions on arrays as Column builders, computed in doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine; 1 where a vector is zero; null for null or unequally long vectors."""
    n = norm(a) * norm(b)
    return F.when(F.size(a) != F.size(b), None).otherwise(F.when(n == 0, F.lit(1.0)).otherwise(1 - dot(a, b) / n))


def l2_normalize(a: Column) -> Column:
    """Unit vector; a zero vector stays as it is."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n)).otherwise(F.transform(a, lambda x: x.cast("double")))


def is_valid(a: Column) -> Column:
    """Not null, not empty, no null or NaN in it."""
    return F.coalesce((F.size(a) > 0) & ~F.exists(a, lambda x: x.isNull() | F.isnan(x)), F.lit(False))
