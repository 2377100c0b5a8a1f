"""Vector expressions for row-wise use; searches over whole tables use operators.knn."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, 0.0 where either vector has no length."""
    scale = norm(a) * norm(b)
    return F.when(scale == 0, 0.0).otherwise(dot(a, b) / scale)


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance."""
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))))


def l2_normalised(a: Column) -> Column:
    length = norm(a)
    return F.when(length == 0, a).otherwise(F.transform(a, lambda x: (x / length).cast("float")))


def similarity_inv(cosine_similarity: Column) -> Column:
    """1 / (1 + cosine distance), the scale the search thresholds and scores are on."""
    return 1.0 / (1.0 + (1.0 - cosine_similarity))
