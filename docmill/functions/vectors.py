"""Vector columns (array<float>) as column expressions, in double precision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _doubles(v: Column | str) -> Column:
    return (F.col(v) if isinstance(v, str) else v).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(_doubles(v), F.lit(0.0), lambda s, x: s + x * x))


def normalized(v: Column | str) -> Column:
    """The vector at length one; a zero vector stays as it is."""
    n = norm(v)
    return F.when(n > 0, F.transform(_doubles(v), lambda x: x / n)).otherwise(_doubles(v)).cast("array<float>")


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; null where a length is zero."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n)


def top_k(vectors: DataFrame, query: list[float], k: int, *, vector: str = "embedding", key: str = "id", at_least: float | None = None, decimals: int | None = None) -> DataFrame:
    """The k rows most similar to one stated vector: a scan with a literal and TakeOrdered, no join, no shuffle."""
    literal = F.array(*[F.lit(float(x)) for x in query])
    scored = vectors.withColumn("similarity", cosine(vector, literal)).where(F.col("similarity").isNotNull() & ~F.isnan("similarity"))
    if decimals is not None:
        scored = scored.withColumn("similarity", F.round("similarity", decimals))
    if at_least is not None:
        scored = scored.where(F.col("similarity") >= at_least)
    return scored.orderBy(F.desc("similarity"), key).limit(k)
