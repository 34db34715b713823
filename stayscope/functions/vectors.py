"""Arithmetic on arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stayscope.functions.text import let


def dot(left: Column, right: Column) -> Column:
    """Sum of products, in double precision."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def unit(vector: Column) -> Column:
    """The vector at length one; a zero vector stays zero."""
    def scaled(v: Column) -> Column:
        return let(F.sqrt(dot(v, v)), lambda length: F.transform(
            v, lambda x: F.when(length > 0, x / length).otherwise(F.lit(0.0))
        ))

    return let(vector, scaled)
