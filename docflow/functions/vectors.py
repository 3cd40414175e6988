"""Scalar expressions over vectors in arrays of doubles; vectors of unequal lengths give null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)


def dot(a: Column, b: Column) -> Column:
    return F.when(F.size(a) == F.size(b), _sum(F.zip_with(a, b, lambda x, y: x * y)))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x * x)))


def cosine(a: Column, b: Column) -> Column:
    """Null if a vector is zero."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def squared_distance(a: Column, b: Column) -> Column:
    return F.when(F.size(a) == F.size(b), _sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


#: Of each metric its expression and whether larger is nearer.
METRICS = {"cosine": (cosine, True), "dotproduct": (dot, True), "euclidean": (squared_distance, False)}


def all_close(a: Column, b: Column, atol: float = 1e-4, rtol: float = 1e-5) -> Column:
    """Whether vectors have one length and all components differ by atol + rtol * |b| at most; NaN is close to nothing, an infinity to itself."""

    def finite(x: Column) -> Column:
        return ~F.isnan(x) & (F.abs(x) != float("inf"))

    def close(x: Column, y: Column) -> Column:
        return F.when(finite(x) & finite(y), F.abs(x - y) <= atol + rtol * F.abs(y)).otherwise((x == y) & ~F.isnan(x))

    a, b = F.coalesce(a, F.array().cast("array<double>")), F.coalesce(b, F.array().cast("array<double>"))
    return (F.size(a) == F.size(b)) & F.forall(F.zip_with(a, b, lambda x, y: F.coalesce(close(x, y), F.lit(False))), lambda ok: ok)
