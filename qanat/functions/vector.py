"""Vector operators as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """In double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def usable(a: Column) -> Column:
    """Neither null, nor empty, nor all zero."""
    return F.coalesce(F.exists(a, lambda x: x != 0), F.lit(False))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine; null where a vector is null or all zero."""
    return 1 - dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def dense_score(distance: Column) -> Column:
    return 1 / (1 + distance)


def stub_embedding(position: Column, size: int = 1024) -> Column:
    """A vector made from a position alone, for tests without a provider."""
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda j: F.sin(position * 97 + j) * 0.01)
