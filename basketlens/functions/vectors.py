"""Array-as-vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketlens.functions.numeric import ratio


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, item: total + item)


def norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity; null when either vector has length zero."""
    return ratio(dot(left, right), norm(left) * norm(right))
