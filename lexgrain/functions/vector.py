"""Vectors as arrays, with higher-order functions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    product = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(product, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null for vectors of different length or of length zero."""
    scale = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (scale > 0), dot(a, b) / F.when(scale > 0, scale))
