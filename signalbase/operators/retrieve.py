"""Retrieval over stored vectors and texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(c: str, query: Sequence[float]) -> Column:
    """Cosine of a vector column with a fixed query vector; 0 for a zero vector."""
    vector = F.col(c).cast("array<double>")
    wanted = F.array(*[F.lit(float(q)) for q in query])
    size = sum(float(q) ** 2 for q in query) ** 0.5
    norm = F.sqrt(_dot(vector, vector)) * F.lit(size)
    return F.when(norm > 0, _dot(vector, wanted) / norm).otherwise(F.lit(0.0))


def keyword_score(c: str, keywords: Sequence[str]) -> Column:
    """Share of the keywords that occur in a text."""
    lowered = F.lower(F.coalesce(F.col(c), F.lit("")))
    hits = sum((lowered.contains(k.lower()).cast("int") for k in keywords), F.lit(0))
    return hits / F.lit(float(len(keywords)))


def vector_topk(vectors: DataFrame, vector: str, item: str, query: Sequence[float], k: int) -> DataFrame:
    """The ``k`` items most like the query: (item, score). Ties go to the lower item."""
    return _best(vectors.select(item, cosine(vector, query).alias("score")), item, k)


def _best(scored: DataFrame, item: str, k: int) -> DataFrame:
    """The ``k`` best by the exact score, which is rounded for display only."""
    best = scored.orderBy(F.col("score").desc(), F.col(item)).limit(k)
    return best.withColumn("score", F.round("score", 6))


def hybrid_topk(texts: DataFrame, vector: str, text: str, item: str, query: Sequence[float],
                keywords: Sequence[str], k: int, weight: float = 0.5) -> DataFrame:
    """The ``k`` best items by ``weight`` x cosine + (1 - ``weight``) x keyword share. No vector counts as cosine 0."""
    likeness = F.coalesce(cosine(vector, query), F.lit(0.0))
    score = F.lit(weight) * likeness + F.lit(1 - weight) * keyword_score(text, keywords)
    return _best(texts.select(item, score.alias("score")), item, k)
