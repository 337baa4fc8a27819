"""Consolidation and joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakestrata.functions.masking import mask_hash
from lakestrata.operators.aggregates import row_counts
from lakestrata.operators.joins import hot_keys, join_with_suffixes, left_join, orphan_keys
from lakestrata.plans import bucketed
from lakestrata.plans.consolidate import (
    consolidate, customers_with_orders, items_with_products, payments_per_order, sales_by_state,
)
from lakestrata.settings import work_path
from lakestrata.sources.domain import domain_tables, table
from lakestrata.workload.registry import query, with_domain

DEMO_KEY = "demo-masking-key"

WIDE_CUSTOMER_FIRST = """
SELECT c.customer_id, customer_unique_id, customer_city, customer_state, customer_segment,
       o.order_id, order_status, order_purchase_timestamp, payment_type,
       CAST(payment_value AS DOUBLE) AS payment_value, payment_sequential, order_item_id, i.product_id,
       CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value,
       product_category_name, product_weight_g
FROM d_customers c LEFT JOIN d_orders o ON c.customer_id = o.customer_id
LEFT JOIN d_payments p ON o.order_id = p.order_id LEFT JOIN d_items i ON o.order_id = i.order_id
LEFT JOIN d_products r ON i.product_id = r.product_id"""


@query("consolidate_customer_first", with_domain(WIDE_CUSTOMER_FIRST))
def consolidate_customer_first(spark, sf_dir):
    return consolidate(domain_tables(spark, sf_dir), driving="customers")


ORDER_FIRST_SQL = with_domain("""
SELECT o.order_id, o.customer_id, order_status, order_purchase_timestamp, customer_city, customer_state,
       payment_type, CAST(payment_value AS DOUBLE) AS payment_value, order_item_id, i.product_id,
       CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value,
       product_category_name, review_score
FROM d_orders o LEFT JOIN d_customers c ON o.customer_id = c.customer_id
LEFT JOIN d_payments p ON o.order_id = p.order_id LEFT JOIN d_items i ON o.order_id = i.order_id
LEFT JOIN d_products r ON i.product_id = r.product_id LEFT JOIN d_reviews v ON o.order_id = v.order_id""")


@query("consolidate_order_first", ORDER_FIRST_SQL)
def consolidate_order_first(spark, sf_dir):
    return consolidate(domain_tables(spark, sf_dir), driving="orders")


@query("consolidate_bucketed", ORDER_FIRST_SQL)
def consolidate_bucketed(spark, sf_dir):
    """The same from silver tables that are stored by order."""
    prefix = f"by_order_{uuid.uuid4().hex}"
    tables = domain_tables(spark, sf_dir)
    bucketed.store_by_order(spark, tables, work_path(spark, "by-order"), prefix, bucketed.buckets_for(tables))
    wide = bucketed.consolidate_stored(bucketed.read_by_order(spark, prefix))
    bucketed.forget(spark, prefix)
    return wide


@query("consolidate_preaggregated", with_domain("""
SELECT o.order_id, o.customer_id, order_status, order_purchase_timestamp, customer_city, customer_state,
       CAST(payment_value AS DOUBLE) AS payment_value, payment_count, order_item_id, i.product_id,
       CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value,
       product_category_name, review_score, review_count
FROM d_orders o LEFT JOIN d_customers c ON o.customer_id = c.customer_id
LEFT JOIN (SELECT order_id, sum(payment_value) AS payment_value, count(*) AS payment_count
           FROM d_payments GROUP BY order_id) p ON o.order_id = p.order_id
LEFT JOIN d_items i ON o.order_id = i.order_id
LEFT JOIN d_products r ON i.product_id = r.product_id
LEFT JOIN (SELECT order_id, avg(review_score) AS review_score, count(*) AS review_count
           FROM d_reviews GROUP BY order_id) v ON o.order_id = v.order_id"""))
def consolidate_preaggregated(spark, sf_dir):
    return consolidate(domain_tables(spark, sf_dir), driving="orders", mode="preaggregate")


@query("sales_by_masked_state", with_domain(f"""
SELECT sha256(customer_state || '{DEMO_KEY}') AS customer_state, CAST(count(*) AS BIGINT) AS wide_rows,
       count(DISTINCT c.customer_id) AS customers, CAST(sum(price) AS DOUBLE) AS price_total
FROM d_customers c LEFT JOIN d_orders o ON c.customer_id = o.customer_id
LEFT JOIN d_payments p ON o.order_id = p.order_id LEFT JOIN d_items i ON o.order_id = i.order_id
GROUP BY 1"""))
def sales_by_masked_state(spark, sf_dir):
    """States are hashed once per result row, not once per sale."""
    sales = sales_by_state(domain_tables(spark, sf_dir))
    return sales.withColumn("customer_state", mask_hash(F.col("customer_state"), DEMO_KEY))


@query("customers_left_pending_orders", with_domain("""
SELECT c.customer_id, customer_state, order_id, order_status
FROM d_customers c LEFT JOIN (SELECT * FROM d_orders WHERE order_status = 'P') o ON c.customer_id = o.customer_id"""))
def customers_left_pending_orders(spark, sf_dir):
    tables = domain_tables(spark, sf_dir, "customers", "orders")
    pending = tables["orders"].where("order_status = 'P'").select("customer_id", "order_id", "order_status")
    return customers_with_orders(tables["customers"].select("customer_id", "customer_state"), pending)


@query("items_left_products", with_domain("""
SELECT i.product_id, order_id, order_item_id, CAST(price AS DOUBLE) AS price,
       CAST(freight_value AS DOUBLE) AS freight_value, product_category_name, product_weight_g
FROM d_items i LEFT JOIN d_products r ON i.product_id = r.product_id"""))
def items_left_products(spark, sf_dir):
    tables = domain_tables(spark, sf_dir, "items", "products")
    return items_with_products(tables["items"], tables["products"])


@query("orders_left_payments", with_domain("""
SELECT o.order_id, order_status, payment_type, CAST(payment_value AS DOUBLE) AS payment_value, payment_sequential
FROM d_orders o LEFT JOIN d_payments p ON o.order_id = p.order_id"""))
def orders_left_payments(spark, sf_dir):
    tables = domain_tables(spark, sf_dir, "orders", "payments")
    return left_join(tables["orders"].select("order_id", "order_status"), tables["payments"], "order_id")


@query("payments_per_order", with_domain("""
SELECT order_id, CAST(sum(payment_value) AS DOUBLE) AS payment_value, count(*) AS payment_count
FROM d_payments GROUP BY order_id"""))
def payments_by_order(spark, sf_dir):
    return payments_per_order(domain_tables(spark, sf_dir, "payments")["payments"])


@query("join_null_keys_match", """
WITH l AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer),
r AS (SELECT nullif(c_mktsegment, 'BUILDING') AS segment, count(*) AS segment_customers FROM customer GROUP BY 1)
SELECT c_custkey, l.segment, segment_customers FROM l LEFT JOIN r ON l.segment IS NOT DISTINCT FROM r.segment""")
def join_null_keys_match(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment")
    )
    right = left.groupBy("segment").agg(F.count(F.lit(1)).alias("segment_customers"))
    return left_join(left, right, "segment", null_keys="match")


@query("join_null_keys_sql", """
WITH l AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer),
r AS (SELECT nullif(c_mktsegment, 'BUILDING') AS segment, count(*) AS segment_customers FROM customer GROUP BY 1)
SELECT c_custkey, l.segment, segment_customers FROM l LEFT JOIN r ON l.segment = r.segment""")
def join_null_keys_sql(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment")
    )
    right = left.groupBy("segment").agg(F.count(F.lit(1)).alias("segment_customers"))
    return left_join(left, right, "segment")


@query("join_hot_keys_salted", """
SELECT c_custkey, c_mktsegment AS segment, o_orderkey, o_totalprice
FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def join_hot_keys_salted(spark, sf_dir):
    """The salted path on real data: the most frequent buyers count as hot."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return left_join(customers, orders, "c_custkey", hot=hot_keys(orders, "c_custkey", min_rows=14))


@query("join_suffixes", """
SELECT l_partkey AS product_id, l_orderkey, l_linenumber, l_extendedprice AS price_order, p_retailprice AS price_item
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def join_suffixes(spark, sf_dir):
    left = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"), "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price")
    )
    right = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_retailprice").alias("price")
    )
    return join_with_suffixes(left, right, "product_id")


@query("orphan_keys", """
SELECT l_orderkey, count(*) AS fact_rows FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""")
def orphans(spark, sf_dir):
    """Line items whose order is not finished."""
    finished = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return orphan_keys(table(spark, sf_dir, "lineitem"), finished, "l_orderkey", "o_orderkey")


@query("row_counts", with_domain("""
SELECT 'customers' AS "table", count(*) AS n_rows FROM d_customers
UNION ALL SELECT 'orders', count(*) FROM d_orders UNION ALL SELECT 'payments', count(*) FROM d_payments
UNION ALL SELECT 'items', count(*) FROM d_items UNION ALL SELECT 'reviews', count(*) FROM d_reviews
UNION ALL SELECT 'products', count(*) FROM d_products"""))
def counts(spark, sf_dir):
    return row_counts(domain_tables(spark, sf_dir))
