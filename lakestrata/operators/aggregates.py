"""Whole-table aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.functions.text import percent


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: (table, n_rows)."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def count_if(condition: Column) -> Column:
    return F.count_if(condition)


def value_counts(df: DataFrame, column: str, count_name: str = "n") -> DataFrame:
    """Rows per value; NULL is left out."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(count_name))
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_distinct) for several columns, NULL not counted.

    The (column, value) pairs are grouped before they are counted, so each
    value crosses the network at most once per task.
    """
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("p")).select("p.*")
    values = pairs.groupBy("column", "value").agg(F.lit(1).alias("one"))
    return values.groupBy("column").agg(F.count("value").alias("n_distinct"))


def masking_stats(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values per masked column before and after masking."""
    left = distinct_counts(before, columns).withColumnRenamed("n_distinct", "original_unique")
    right = distinct_counts(after, columns).withColumnRenamed("n_distinct", "masked_unique")
    return left.join(right, "column")


def null_cells(df: DataFrame) -> tuple[Column, Column]:
    """Aggregates (null cells, all cells) over the whole frame."""
    missing = sum((F.col(f"`{c}`").isNull().cast("bigint") for c in df.columns), start=F.lit(0))
    return F.coalesce(F.sum(missing), F.lit(0)), F.count(F.lit(1)) * len(df.columns)


def null_fraction(df: DataFrame) -> DataFrame:
    """One row: (null_cells, cells, null_fraction); the share of no cells is NULL."""
    missing, cells = null_cells(df)
    return df.agg(missing.alias("null_cells"), cells.alias("cells")).withColumn(
        "null_fraction", F.try_divide(F.col("null_cells"), F.col("cells"))
    )


def compliance_rate(df: DataFrame, ok: Column) -> DataFrame:
    """One row: (total, ok, rate) with the rate in percent, 0 for no rows."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("ok")).withColumn(
        "rate", percent(F.col("ok"), F.col("total"))
    )
