"""Registered queries and their SQL twins."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Runner
    sql: str | None


QUERIES: dict[str, Query] = {}

MODULES = ["joins", "rows", "privacy", "quality", "star", "audit", "feeds", "streams", "storage", "pipelines"]

# SQL twins of ``lakestrata.sources.domain``.
DOMAIN_SQL = """
d_customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_unique_id, r_name AS customer_city,
         n_name AS customer_state, c_mktsegment AS customer_segment
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
d_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
         o_orderdate AS order_purchase_timestamp FROM orders),
d_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS freight_value
  FROM lineitem),
d_products AS (
  SELECT p_partkey AS product_id, p_type AS product_category_name, p_size AS product_weight_g FROM part),
d_paid AS (
  SELECT o_orderkey AS order_id, o_orderpriority AS payment_type,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         CAST((CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 1) // 2 AS BIGINT) AS n FROM orders),
d_payments AS (
  SELECT order_id, payment_type,
         CAST(CAST(cents // n AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS payment_value,
         CAST(unnest(range(1, n + 1)) AS INTEGER) AS payment_sequential FROM d_paid),
d_reviews AS (
  SELECT o_orderkey AS order_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS review_score
  FROM orders WHERE o_orderstatus <> 'O')
"""


def with_domain(body: str, *ctes: str) -> str:
    """A SQL statement that may use the domain tables."""
    return f"WITH {', '.join([DOMAIN_SQL.strip(), *ctes])} {body}"


def _plain_column(field: T.StructField) -> Column:
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DecimalType):
        return col.cast("double").alias(field.name)
    if isinstance(field.dataType, T.DateType):
        return col.cast("string").alias(field.name)
    return col


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, once everything is added up, and dates as text."""
    return df.select(*[_plain_column(f) for f in df.schema])


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query; ``sql`` computes the same on the same tables."""

    def register(run: Runner) -> Runner:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = Query(name, lambda spark, sf_dir: plain(run(spark, sf_dir)), sql)
        return run

    return register


def load_all() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"lakestrata.workload.{module}")
    return QUERIES
