"""Two-extract reconciliation on DataFrame columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import text as T


def stitch(df: DataFrame, a: str, b: str, n: int = T.SHINGLE_WORDS, output: str = "merged_text") -> DataFrame:
    """Add A with the part of B before their first common ``n`` words put in."""
    return df.withColumn(output, T.stitch(a, b, n))


def lead_in(df: DataFrame, a: str, b: str, n: int = T.SHINGLE_WORDS, output: str = "lead_in") -> DataFrame:
    """Add the part of B that :func:`stitch` would put in; NULL if none matches."""
    return df.withColumn(output, T.lead_in(a, b, n))
