"""Top-k, samples and limits: bounded results by definition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def top_k_values(df: DataFrame, column: str, k: int = 5, count_name: str = "n") -> DataFrame:
    """The k most frequent values; ties go to the smaller value, NULL is left out."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(count_name))
        .orderBy(F.col(count_name).desc(), F.col(column).asc())
        .limit(k)
    )


def sample_rows(df: DataFrame, order: Sequence[str | Column], n: int = 3) -> DataFrame:
    """First n rows under an explicit order."""
    return df.orderBy(*order).limit(n)


def limit_events(df: DataFrame, order: Sequence[str | Column], n: int | None = 30) -> DataFrame:
    """First n events; None or 0 keeps all."""
    return df.orderBy(*order).limit(n) if n else df
