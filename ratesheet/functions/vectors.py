"""Vector functions on array columns, computed in double precision."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _doubles(c: Column) -> Column:
    return c.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y),
        F.lit(0.0),
        lambda total, x: total + x,
    )


def norm(c: Column) -> Column:
    return F.sqrt(F.aggregate(_doubles(c), F.lit(0.0), lambda total, x: total + x * x))


def normalise(c: Column) -> Column:
    """Unit-length vector; a zero vector stays zero."""
    length = norm(c)
    return F.transform(_doubles(c), lambda x: F.when(length > 0, x / length).otherwise(F.lit(0.0)))


def cosine(a: Column, b: Column) -> Column:
    """Inner product of the normalised vectors; 0 when either is zero."""
    lengths = norm(a) * norm(b)
    return F.when(lengths > 0, dot(a, b) / lengths).otherwise(F.lit(0.0))
