"""Vector expressions on double arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foldwise.functions.rows import col


def doubles(v: str | Column) -> Column:
    return col(v).cast("array<double>")


def dot(a: str | Column, b: str | Column) -> Column:
    products = F.zip_with(doubles(a), doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def unit(v: str | Column) -> Column:
    """Scaled to length one; a zero vector stays zero."""
    norm = F.sqrt(dot(v, v))
    return F.transform(doubles(v), lambda x: F.when(norm > 0, x / norm).otherwise(x))


def distance(a: str | Column, b: str | Column) -> Column:
    gaps = F.zip_with(doubles(a), doubles(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x))
