"""Sinks: written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestrata.settings import work_path
from lakestrata.sinks import files
from lakestrata.sources.domain import domain_tables, table
from lakestrata.sources.tables import load_tables, read_csv, read_layer
from lakestrata.workload.registry import query, with_domain


@query("csv_roundtrip", "SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM documents")
def csv_roundtrip(spark, sf_dir):
    """Whole texts, line breaks and quotes included, through CSV."""
    documents = table(spark, sf_dir, "documents")
    path = work_path(spark, "csv")
    files.write_csv(documents, path)
    return read_csv(spark, path, documents.schema, multi_line=True)


@query("land_bronze_status", """
SELECT 'customer' AS "table", 'LANDED' AS status, count(*) AS n_rows FROM customer
UNION ALL SELECT 'orders', 'LANDED', count(*) FROM orders UNION ALL SELECT 'returns', 'SKIPPED', NULL""")
def land_bronze_status(spark, sf_dir):
    tables = {
        "customer": table(spark, sf_dir, "customer"),
        "orders": f"{sf_dir}/orders.parquet",
        "returns": f"{sf_dir}/returns.parquet",
    }
    return files.land_bronze(tables, work_path(spark, "bronze"), spark)


@query("promote_silver", "SELECT * FROM customer")
def promote_silver(spark, sf_dir):
    root = work_path(spark, "silver")
    files.promote(spark, f"{sf_dir}/customer.parquet", root, "silver", "customer")
    return read_layer(spark, root, "silver", "customer")


@query("gold_partitioned", "SELECT o_orderkey, o_totalprice, o_orderstatus, year(o_orderdate)::INTEGER AS ano FROM orders")
def gold_partitioned(spark, sf_dir):
    """Partitioned gold table; one partition is then rewritten on its own."""
    root = work_path(spark, "gold")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.year("o_orderdate").alias("ano")
    )
    files.write_gold(rows, root, "orders", ["ano"])
    files.write_gold(rows.where("ano = 1995"), root, "orders", ["ano"])
    return read_layer(spark, root, "gold", "orders")


@query("load_tables", with_domain("""
SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey"""))
def load(spark, sf_dir):
    mapping = {"orders": "orders.parquet", "customer": "customer.parquet"}
    tables = load_tables(spark, sf_dir, mapping, required={"orders": ["o_custkey"], "customer": ["c_custkey"]})
    orders, customer = tables["orders"], tables["customer"]
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select("o_orderkey", "c_name", "o_totalprice")


@query("append_new_repeated", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def append_new_repeated(spark, sf_dir):
    """The same batch twice: the second run adds nothing."""
    path = work_path(spark, "append")
    batch = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    files.append_new(spark, path, batch.where("c_mktsegment = 'BUILDING'"), ["c_custkey"], ["c_name"])
    files.append_new(spark, path, batch, ["c_custkey"], ["c_name"])
    files.append_new(spark, path, batch, ["c_custkey"], ["c_name"])
    return spark.read.parquet(path)


@query("upsert_partitions", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' AND year(o_orderdate) < 1995 THEN 0.0 ELSE o_totalprice END AS amount,
       year(o_orderdate)::INTEGER AS ano FROM orders""")
def upsert_partitions(spark, sf_dir):
    """Urgent orders before 1995 get a new amount; later years stay untouched."""
    path = work_path(spark, "upsert-table")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("amount"), F.year("o_orderdate").alias("ano"),
        "o_orderpriority",
    )
    rows.drop("o_orderpriority").hint("rebalance", "ano").write.partitionBy("ano").parquet(path)
    batch = rows.where("o_orderpriority = '1-URGENT' and ano < 1995").withColumn("amount", F.lit(0.0))
    files.upsert_partitions(spark, path, batch.drop("o_orderpriority"), ["o_orderkey"], ["amount"], ["ano"])
    return spark.read.parquet(path)


@query("silver_by_month", with_domain("""
SELECT order_id, order_status, order_purchase_timestamp, strftime(order_purchase_timestamp, '%Y-%m') AS mes FROM d_orders"""))
def silver_by_month(spark, sf_dir):
    root = work_path(spark, "silver-month")
    orders = domain_tables(spark, sf_dir, "orders")["orders"].select("order_id", "order_status", "order_purchase_timestamp")
    orders = orders.withColumn("mes", F.date_format("order_purchase_timestamp", "yyyy-MM"))
    files.write_layer(orders, root, "silver", "orders", ["mes"])
    schema = orders.schema
    return read_layer(spark, root, "silver", "orders", schema=schema)
