"""Whole pipelines: each query runs one from the given tables to its output."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestrata.operators import quality
from lakestrata.plans import pipelines
from lakestrata.plans.pipelines import Lake
from lakestrata.settings import cut_lineage, work_path
from lakestrata.sinks import files
from lakestrata.sources.domain import domain_tables, table
from lakestrata.sources.tables import load_tables, read_csv, read_layer, split_rescued
from lakestrata.workload.joins import DEMO_KEY
from lakestrata.workload.registry import query, with_domain

AS_OF = "2024-02-01 00:00:00"
VERSION = "v20240201000000"
SUITE = [{"type": "not_null", "column": "customer_id"}, {"type": "between", "column": "price", "min": 0, "max": 1e9}]

SOLD = "d_items i JOIN d_orders o ON i.order_id = o.order_id JOIN d_customers c ON o.customer_id = c.customer_id"
SALES = f"sold AS (SELECT DISTINCT i.order_id, i.product_id, i.order_item_id, i.price FROM {SOLD})"


@query("batch_pipeline", with_domain(f"""
SELECT 'dim_cliente' AS "table", count(*) AS n_rows FROM d_customers
UNION ALL SELECT 'dim_produto', count(DISTINCT i.product_id) FROM {SOLD}
UNION ALL SELECT 'fato_vendas', count(*) FROM (SELECT DISTINCT i.order_id, i.product_id, i.order_item_id FROM {SOLD})"""))
def batch_pipeline(spark, sf_dir):
    """Consolidate, mask, gate, build and publish: row counts of the star."""
    lake = Lake(work_path(spark, "batch"))
    return pipelines.run_batch(spark, domain_tables(spark, sf_dir), lake, DEMO_KEY, SUITE, VERSION, AS_OF)


@query("stream_pipeline_totals", with_domain("""
SELECT n AS consumed, p AS processed, n - p AS skipped, CAST(0 AS BIGINT) AS invalid FROM (
  SELECT count(*) AS n, count(*) FILTER (WHERE price > 100) AS p FROM (
    SELECT order_id, product_id, order_item_id, min(price) AS price FROM sold GROUP BY ALL)
)""", SALES))
def stream_pipeline_totals(spark, sf_dir):
    """Batch, rebuild, and the stream run twice: each order line is consumed once."""
    lake = Lake(work_path(spark, "stream"))
    tables = domain_tables(spark, sf_dir)
    ordered = tables["orders"].join(tables["items"].select("order_id").distinct(), "order_id", "left_semi")
    tables["orders"] = cut_lineage(ordered, "ordered")  # both rounds read it
    totals = dict.fromkeys(("consumed", "processed", "skipped", "invalid"), 0)
    for _ in range(2):
        pipelines.consolidate_and_mask(spark, tables, lake, DEMO_KEY, AS_OF, driving="orders", mode="preaggregate")
        run = pipelines.finish_stream(spark, lake, pipelines.run_stream(spark, lake, AS_OF), AS_OF)
        totals = {name: totals[name] + run[name] for name in totals}
    return spark.createDataFrame([tuple(totals.values())], ", ".join(f"{n} bigint" for n in totals))


@query("quality_gate", with_domain(f"""
SELECT 0 AS rule_id, count(*) AS tested, CAST(0 AS BIGINT) AS unexpected, true AS success FROM d_items
UNION ALL SELECT 1, count(price), CAST(0 AS BIGINT), true FROM d_items"""))
def quality_gate(spark, sf_dir):
    """The gate lets a suite through that every item passes."""
    suite = [{"type": "not_null", "column": "order_id"}, {"type": "between", "column": "price", "min": 0, "max": 1e9}]
    gated = quality.quality_gate(domain_tables(spark, sf_dir, "items")["items"], suite)
    return gated.select("rule_id", "tested", "unexpected", "success")


@query("csv_by_name", "SELECT c_custkey AS customer_id, c_mktsegment AS customer_state, CAST(NULL AS VARCHAR) AS note FROM customer")
def csv_by_name(spark, sf_dir):
    """A CSV with more columns and in another order, read by name."""
    root = work_path(spark, "csv")
    files.write_csv(table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("customer_state"), "c_acctbal", F.col("c_custkey").alias("customer_id"), "c_name"
    ), f"{root}/customers.csv")
    schema = "customer_id bigint, customer_state string, note string"
    schemas = {"customers": spark.createDataFrame([], schema).schema}
    return load_tables(spark, root, {"customers": "customers.csv"}, schemas, {"customers": ["customer_state"]})["customers"]


@query("layer_of_csv", "SELECT o_orderkey, o_orderstatus FROM orders")
def layer_of_csv(spark, sf_dir):
    """A layer table kept as CSV."""
    root = work_path(spark, "layer")
    files.write_csv(table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey"), f"{root}/bronze/orders")
    return read_layer(spark, root, "bronze", "orders", fmt="csv", schema="o_orderkey bigint, o_orderstatus string")


@query("csv_other_case", "SELECT c_custkey AS customer_id, c_mktsegment AS customer_state FROM customer")
def csv_other_case(spark, sf_dir):
    """A header in capitals answers to the schema's names."""
    root = work_path(spark, "csv")
    files.write_csv(table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("CUSTOMER_STATE"), F.col("c_custkey").alias("Customer_Id")
    ), f"{root}/customers.csv")
    return read_csv(spark, f"{root}/customers.csv", "customer_id bigint, customer_state string")


@query("csv_rescued", """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 3 THEN round(o_totalprice, 2) END AS price,
       CASE WHEN o_orderkey % 7 <> 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS sold_on,
       concat_ws(';', CASE WHEN o_orderkey % 10 = 3 THEN 'price=R$ ' || o_orderkey END,
                 CASE WHEN o_orderkey % 7 = 2 THEN 'sold_on=32/13/' || o_orderkey END) AS lost
FROM orders""")
def csv_rescued(spark, sf_dir):
    """Prices and dates that do not convert are kept beside their rows."""
    path = f"{work_path(spark, 'csv')}/orders.csv"
    key = F.col("o_orderkey")
    files.write_csv(table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 7 == 2, F.concat(F.lit("32/13/"), key.cast("string"))).otherwise(F.to_date("o_orderdate").cast("string")).alias("sold_on"),
        F.when(key % 10 == 3, F.concat(F.lit("R$ "), key.cast("string"))).otherwise(F.round("o_totalprice", 2).cast("string")).alias("price"),
    ), path)
    rows = read_csv(spark, path, "o_orderkey bigint, price double, sold_on date", rescue="lost")
    rows = rows.withColumn("sold_on", F.date_format("sold_on", "yyyy-MM-dd"))
    good, rescued = split_rescued(rows, "lost")
    told = F.array_join(F.transform("lost", lambda x: F.concat(x["column"], F.lit("="), x["text"])), ";")
    return good.withColumn("lost", F.lit("")).unionByName(rescued.withColumn("lost", told))
