"""Silver tables stored by order, so that later joins on the order move nothing.

Orders with their customer, items with their product, payments and reviews are
each written once into the same number of buckets of the order id, sorted within
them. Spark then joins bucket with bucket: the consolidation of stored tables
has no exchange on the order, however often it runs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.operators.aggregates import row_counts
from lakestrata.operators.joins import left_join
from lakestrata.plans.consolidate import Tables, items_with_products, order_first_tables

PARTS = ("spine", "payments", "lines", "reviews")
# Rows of the largest table that one bucket holds, about: a task sorts them.
BUCKET_ROWS = 500_000


def buckets_for(tables: Tables, least: int = 8) -> int:
    """Buckets that keep a bucket of the largest table at ``BUCKET_ROWS``.

    A stored bucket is one task of every later join, which adaptive execution
    does not split: their number must grow with the rows.
    """
    counts = row_counts({name: tables[name] for name in ("orders", "payments", "items", "reviews")})
    most = counts.agg(F.max("n_rows").alias("n")).first()["n"]
    return max(least, -(-most // BUCKET_ROWS))


def store_by_order(spark: SparkSession, tables: Tables, root: str, prefix: str, buckets: int) -> None:
    """Write the tables ``<prefix>_spine``, ``_payments``, ``_lines`` and
    ``_reviews`` under ``root`` and enter them in the catalog.

    Each bucket is one file: rows are dealt by the order id before the write.
    Choose ``buckets`` so that one bucket of the largest table fits a task, as
    ``buckets_for`` does. An
    order that alone holds more than that belongs to ``consolidate``, which
    salts it.
    """
    tables = order_first_tables(tables)
    parts = {
        "spine": left_join(tables["orders"], tables["customers"], "customer_id"),
        "payments": tables["payments"],
        "lines": items_with_products(tables["items"], tables["products"]),
        "reviews": tables["reviews"],
    }
    for name in PARTS:
        (
            parts[name].repartition(buckets, "order_id").write.mode("overwrite")
            .bucketBy(buckets, "order_id").sortBy("order_id").option("path", f"{root}/{name}").format("parquet")
            .saveAsTable(f"{prefix}_{name}")
        )


def read_by_order(spark: SparkSession, prefix: str) -> dict[str, DataFrame]:
    return {name: spark.table(f"{prefix}_{name}") for name in PARTS}


def consolidate_stored(stored: Mapping[str, DataFrame]) -> DataFrame:
    """The wide table of ``consolidate(driving="orders")`` from stored tables."""
    wide = stored["spine"]
    for name in PARTS[1:]:
        wide = wide.join(stored[name], "order_id", "left")
    columns = [c for name in PARTS for c in stored[name].columns if c != "order_id"]
    return wide.select("order_id", *columns)


def forget(spark: SparkSession, prefix: str) -> None:
    """Take the tables out of the catalog; their files stay."""
    for name in PARTS:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_{name}")
