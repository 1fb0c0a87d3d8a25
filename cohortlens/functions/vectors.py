"""Arithmetic on array<double> columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def squared_distance(left: Column, right: Column) -> Column:
    squares = F.zip_with(left, right, lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)


def distance(left: Column, right: Column) -> Column:
    return F.sqrt(squared_distance(left, right))


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
