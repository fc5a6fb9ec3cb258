"""Vector arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 0 when a vector has no length. Vectors of unequal size raise."""
    size = norm(a) * norm(b)
    uneven = F.size(a) != F.size(b)
    return F.when(uneven, F.raise_error(F.lit("cosine: vectors differ in size")).cast("double")).when(
        size == 0, F.lit(0.0)).otherwise(F.try_divide(dot(a, b), size))


def squared_distance(a: Column | str, b: Column | str) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, p: acc + p)
