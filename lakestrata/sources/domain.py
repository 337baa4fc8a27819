"""The domain tables, derived from the TPC-H-like tables of a folder.

customers = customer with nation and region; orders, items and products map
one to one; payments are instalments of an order (as many as its priority
digit, halved and rounded up); reviews exist for orders that are no longer
open, with the priority digit as the score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table, under the schema its files have now."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(col: Column) -> Column:
    return col.cast("decimal(18,2)")


def _priority() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    customer = table(spark, sf_dir, "customer")
    return customer.join(places, customer.c_nationkey == places.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("r_name").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
        F.col("c_mktsegment").alias("customer_segment"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = money(F.col("l_extendedprice"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        price.alias("price"),
        money(price * F.col("l_tax").cast("decimal(4,2)")).alias("freight_value"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.col("p_size").alias("product_weight_g"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("payment_type"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        F.expr("cast((cast(substring(o_orderpriority, 1, 1) as int) + 1) div 2 as int)").alias("n"),
    )
    value = F.expr("cast(cents div n as decimal(18,0)) * cast(0.01 as decimal(3,2))")
    return paid.select(
        "order_id", "payment_type", money(value).alias("payment_value"),
        F.explode(F.sequence(F.lit(1), F.col("n"))).alias("payment_sequential"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderstatus <> 'O'").select(
        F.col("o_orderkey").alias("order_id"), _priority().alias("review_score")
    )


BUILDERS = {
    "customers": customers,
    "orders": orders,
    "payments": payments,
    "items": items,
    "reviews": reviews,
    "products": products,
}


def domain_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named domain tables, all six without a name."""
    return {name: BUILDERS[name](spark, sf_dir) for name in names or BUILDERS}
