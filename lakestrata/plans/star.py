"""Star schema: dimensions and fact from the (masked) consolidated table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata import constants as K
from lakestrata.operators.dedupe import dedupe_first
from lakestrata.operators.filters import drop_null, map_columns

# Source column per star column; a caller can pass another mapping.
CLIENT_COLUMNS = {
    "cliente_id": "customer_id",
    "nome": "customer_unique_id",
    "segmento": "customer_segment",
    "cidade": "customer_city",
    "estado": "customer_state",
}
CLIENT_DEFAULTS = {"nome": "N/A", "segmento": "N/A"}
PRODUCT_COLUMNS = {
    "produto_id": "product_id",
    "nome_produto": "product_category_name",
    "categoria": "product_category_name",
    "preco_unitario": "price",
}
# The older loaders' mapping, on request: the weight as the price, and (for the
# fact) the line's number as its quantity.
LEGACY_PRODUCT_COLUMNS = {**PRODUCT_COLUMNS, "preco_unitario": "product_weight_g"}
LEGACY_QUANTITY = "order_item_id"
PRODUCT_DEFAULTS = {"nome_produto": "N/A", "categoria": "N/A", "preco_unitario": 0}
FACT_GRAIN = ["order_id", "product_id", "order_item_id"]
LEGACY_GRAIN = ["order_id"]


def _dimension(
    source: DataFrame, key: str, mapping: Mapping[str, str | Column], defaults: Mapping[str, object], order: Sequence
) -> DataFrame:
    """One row per key, the first under ``order``.

    The wide table repeats a dimension row many times: equal rows are merged
    per task by hash before the few that are left are ranked.
    """
    dim = map_columns(source, mapping, defaults).where(F.col(key).isNotNull()).distinct()
    return dedupe_first(dim, [key], order or [c for c in dim.columns if c != key])


def build_dim_cliente(
    consolidated: DataFrame, mapping: Mapping[str, str | Column] = CLIENT_COLUMNS, order: Sequence = ()
) -> DataFrame:
    return _dimension(consolidated, "cliente_id", mapping, CLIENT_DEFAULTS, order)


def build_dim_produto(
    consolidated: DataFrame, mapping: Mapping[str, str | Column] = PRODUCT_COLUMNS, order: Sequence = ()
) -> DataFrame:
    """One row per product; of several prices the lowest is its unit price."""
    return _dimension(consolidated, "produto_id", mapping, PRODUCT_DEFAULTS, order)


def _fact_rows(consolidated: DataFrame) -> DataFrame:
    if "order_item_id" in consolidated.columns:
        return consolidated
    return consolidated.withColumn("order_item_id", F.lit(1))


def fact_losses(consolidated: DataFrame, grain: Sequence[str] = FACT_GRAIN) -> DataFrame:
    """One row: what the fact makes of the source rows: ``rows``, ``incomplete``
    (a required value is missing), ``merged`` (a grain key occurs again) and
    ``kept``."""
    rows = _fact_rows(consolidated)
    whole = F.lit(True)
    for column in K.FACT_REQUIRED:
        whole &= F.col(column).isNotNull()
    counted = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(whole).alias("whole"),
        # A grain key may hold NULLs beyond the required columns.
        F.count_distinct(F.when(whole, F.to_json(F.struct(*grain)))).alias("kept"),
    )
    return counted.select(
        "rows", (F.col("rows") - F.col("whole")).alias("incomplete"), (F.col("whole") - F.col("kept")).alias("merged"), "kept"
    )


def build_fato_vendas(
    consolidated: DataFrame,
    grain: Sequence[str] = FACT_GRAIN,
    order: Sequence = ("price", "order_purchase_timestamp"),
    quantity: str | int = 1,
) -> DataFrame:
    """Sales fact; rows lacking a required value are dropped, one row per grain key.

    ``quantity`` is a number per line, or the column that holds it.
    ``fact_losses`` counts the rows that are dropped or merged.
    """
    rows = drop_null(_fact_rows(consolidated), K.FACT_REQUIRED)
    needed = list(dict.fromkeys([*K.FACT_REQUIRED, "order_item_id", *grain, *([quantity] if isinstance(quantity, str) else [])]))
    rows = dedupe_first(rows.select(*needed), grain, [*order, *[c for c in needed if c not in order]])
    return rows.select(
        F.col("order_id"),
        F.col("customer_id").alias("cliente_id"),
        F.col("product_id").alias("produto_id"),
        F.col("order_purchase_timestamp").cast("timestamp_ntz").alias("data_venda"),
        F.col("price").alias("valor_total"),
        F.coalesce(F.col(quantity) if isinstance(quantity, str) else F.lit(quantity), F.lit(1)).cast("int").alias("quantidade"),
    )


def build_star(consolidated: DataFrame, grain: Sequence[str] = FACT_GRAIN) -> dict[str, DataFrame]:
    return {
        "dim_cliente": build_dim_cliente(consolidated),
        "dim_produto": build_dim_produto(consolidated),
        "fato_vendas": build_fato_vendas(consolidated, grain),
    }


def build_star_from_tables(tables: Mapping[str, DataFrame], consolidated: DataFrame) -> dict[str, DataFrame]:
    """Star with dimensions from the entity tables, where they are smallest.

    A product's unit price is the lowest price it was sold for, NULL if it
    never was.
    """
    prices = tables["items"].groupBy("product_id").agg(F.min("price").alias("price"))
    return {
        "dim_cliente": build_dim_cliente(tables["customers"]),
        "dim_produto": build_dim_produto(tables["products"].join(prices, "product_id", "left")),
        "fato_vendas": build_fato_vendas(consolidated),
    }
