"""Gold aggregates and lineage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from lakestrata.functions.masking import mask_hash
from lakestrata.functions.time import month_start


def gold_sales(fact: DataFrame, clients: DataFrame, products: DataFrame, how: str = "rollup") -> DataFrame:
    """Sales by state x category x month with subtotals.

    Sales are added up at the finest level first, merged per task before the
    shuffle; only those few rows are multiplied by the grouping sets.
    """
    if how not in ("rollup", "cube"):
        raise ValueError("how is 'rollup' or 'cube'")
    keys = ["estado", "categoria", "mes"]
    leaves = (
        fact.select("cliente_id", "produto_id", "valor_total", "quantidade", month_start(F.col("data_venda")).alias("mes"))
        .join(clients.select("cliente_id", "estado"), "cliente_id", "left")
        .join(products.select("produto_id", "categoria"), "produto_id", "left")
        .groupBy(*keys)
        .agg(
            F.sum("valor_total").alias("valor_total"),
            F.sum("quantidade").alias("quantidade"),
            F.count(F.lit(1)).alias("linhas"),
        )
    )
    grouped = leaves.rollup(*keys) if how == "rollup" else leaves.cube(*keys)
    return grouped.agg(
        F.grouping_id().cast("int").alias("nivel"),
        F.sum("valor_total").cast("decimal(38,2)").alias("valor_total"),
        F.sum("quantidade").cast("bigint").alias("quantidade"),
        F.sum("linhas").cast("bigint").alias("linhas"),
    )


def monthly_sales(fact: DataFrame) -> DataFrame:
    return fact.groupBy(month_start(F.col("data_venda")).alias("mes")).agg(
        F.sum("valor_total").cast("decimal(38,2)").alias("valor_total")
    )


def indicator_by_month(indicator: DataFrame, date_format: str = "dd/MM/yyyy") -> DataFrame:
    """Typed monthly view of the text feed (data, valor); unreadable rows drop out."""
    typed = indicator.select(
        month_start(F.try_to_timestamp(F.col("data"), F.lit(date_format))).alias("mes"),
        F.col("valor").try_cast("decimal(18,6)").alias("valor"),
    )
    return typed.where("mes is not null and valor is not null").groupBy("mes").agg(
        F.avg(F.col("valor").cast("double")).alias("indicador")
    )


def indicator_correlation(sales: DataFrame, indicator: DataFrame, lag_months: int = 0) -> DataFrame:
    """Correlation of monthly sales with the indicator ``lag_months`` earlier."""
    shifted = indicator.withColumn("mes", F.add_months("mes", lag_months))
    return sales.join(shifted, "mes").agg(
        F.count(F.lit(1)).alias("months"),
        F.round(F.corr(F.col("valor_total").cast("double"), F.col("indicador")), 6).alias("correlation"),
    )


def regional_weather(
    sales: DataFrame, weather: DataFrame, key: str | None = None
) -> DataFrame:
    """Sales per state and day beside that day's weather.

    ``sales`` holds (estado, dia, valor_total); when its state is masked, pass
    the masking key and the plain states of ``weather`` (estado, dia,
    temperatura) are hashed the same way. Both sides are reduced to one row
    per state and day before the join, and states are hashed after that.
    """
    days = weather.groupBy("estado", "dia").agg(
        F.avg("temperatura").alias("temperatura"), F.count(F.lit(1)).alias("medicoes")
    )
    if key:
        days = days.withColumn("estado", mask_hash(F.col("estado"), key))
    sold = sales.groupBy("estado", "dia").agg(
        F.sum("valor_total").cast("decimal(38,2)").alias("valor_total"), F.count(F.lit(1)).alias("vendas")
    )
    return sold.join(days, ["estado", "dia"], "left")


def lineage(stages: Sequence[tuple[str, Mapping[str, DataFrame], DataFrame]]) -> DataFrame:
    """One row per stage: (stage, inputs, input_rows, output_rows).

    Each table is counted in the cluster; only names are handled on the driver.
    """
    rows = None
    for name, inputs, output in stages:
        row = output.agg(F.count(F.lit(1)).alias("output_rows"))
        total = sum(
            (df.agg(F.count(F.lit(1)).alias("n")).scalar() for df in inputs.values()), start=F.lit(0)
        )
        row = row.select(
            F.lit(name).alias("stage"),
            F.lit(", ".join(sorted(inputs))).alias("inputs"),
            total.cast("bigint").alias("input_rows"),
            "output_rows",
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows
