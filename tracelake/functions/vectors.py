"""Vector similarity as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine_similarity(left: Column, right: Column) -> Column:
    """Null for a zero vector, which has no direction."""
    size = F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))
    return F.when(size > 0, dot(left, right) / size)


def cosine_distance(left: Column, right: Column) -> Column:
    return 1.0 - cosine_similarity(left, right)
