"""Projections and row filters. All are plain predicates Spark can push down."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakestrata import constants as K
from lakestrata.functions.time import add_days, ntz


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep a declared column subset; a missing column is an error."""
    return df.select(*columns)


def map_columns(
    df: DataFrame, mapping: Mapping[str, str | Column], defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Rename or derive columns; an absent source column takes its default."""
    defaults = defaults or {}
    out = []
    for name, source in mapping.items():
        if isinstance(source, Column):
            out.append(source.alias(name))
        elif source in df.columns:
            out.append(F.col(source).alias(name))
        elif name in defaults:
            out.append(F.lit(defaults[name]).alias(name))
        else:
            raise ValueError(f"column {source!r} is absent and {name!r} has no default")
    return df.select(*out)


def drop_if_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def normalise_na(df: DataFrame, tokens: Sequence[str] = K.NA_TOKENS) -> DataFrame:
    """Turn the NA spellings of CSV files into NULL in every string column."""
    tokens = list(tokens)
    return df.select(*[
        F.when(~F.col(f.name).isin(tokens), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema
    ])


def filter_min(df: DataFrame, column: str, minimum: float) -> DataFrame:
    """Rows strictly above ``minimum``; NaN does not qualify."""
    return df.where(above(F.col(column), minimum))


def above(col: Column, minimum: float) -> Column:
    return (col > minimum) & ~F.isnan(col)


def drop_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows with a value in every column of ``subset``; NaN is no value.

    Plain terms, which reach the scan and turn outer joins into inner ones.
    """
    kept = F.lit(True)
    for name in subset:
        kept &= F.col(name).isNotNull()
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            kept &= ~F.isnan(name)
    return df.where(kept)


def between_ts(
    df: DataFrame, column: str, start: datetime | str, end: datetime | str, day_column: str | None = None
) -> DataFrame:
    """Closed time range; ``day_column`` names a date partition to prune by."""
    start, end = ntz(start), ntz(end)
    if day_column:
        df = df.where(F.col(day_column).between(F.to_date(start), F.to_date(end)))
    return df.where(F.col(column).between(start, end))


def last_days(
    df: DataFrame, column: str, days: int, as_of: datetime | str, day_column: str | None = None
) -> DataFrame:
    """Rows from ``as_of - days`` on, inclusive."""
    start = add_days(ntz(as_of), -days)
    if day_column:
        df = df.where(F.col(day_column) >= F.to_date(start))
    return df.where(F.col(column) >= start)


def filter_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def filter_not_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Rows that differ from ``value``; NULL differs from every value."""
    return df.where(~F.col(column).eqNullSafe(F.lit(value)))


def outside(col: Column, low: float, high: float) -> Column:
    return (col < low) | (col > high)


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where(outside(F.col(column), low, high))


def filter_contains(df: DataFrame, column: str, text: str) -> DataFrame:
    """Case-sensitive substring."""
    return df.where(F.col(column).contains(text))


def split_by_age(
    df: DataFrame, column: str, days: int = K.HOT_DAYS, *, as_of: datetime | str, day_column: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(hot, cold): cold rows are strictly older than ``days``.

    Rows without a timestamp stay hot, so the two parts cover the input.
    ``day_column`` names the table's date partition: each part then reads only
    its own days, and the day of the cutoff is read by both.
    """
    cutoff = add_days(ntz(as_of), -days)
    hot = (F.col(column) >= cutoff) | F.col(column).isNull()
    cold = F.col(column) < cutoff
    if day_column:
        day = F.col(day_column)
        hot = hot & ((day >= F.to_date(cutoff)) | day.isNull())
        cold = cold & (day <= F.to_date(cutoff))
    return df.where(hot), df.where(cold)
