"""Arithmetic on array columns, in doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 9


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, item: total + item)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, null for a zero vector; rounded so that copies of a vector get equal scores."""
    return F.round(F.try_divide(dot(a, b), norm(a) * norm(b)), DIGITS)
