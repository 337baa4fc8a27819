"""Consolidation of the sales tables into one wide table.

``driving="customers"`` starts from all customers, ``driving="orders"`` from
all orders. Payments, items and reviews of one order multiply each other in
``mode="fanout"``; ``mode="preaggregate"`` reduces payments and reviews to one
row per order first, so sums over items stay right and the wide table has one
row per item.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from lakestrata import constants as K
from lakestrata.operators.filters import project
from lakestrata.operators.joins import HOT_ROWS, hot_keys_of, left_join

Tables = Mapping[str, DataFrame]


def buyers_and_idle(customers: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two parts of customers left join orders: matched rows, and customers
    without orders.

    In the inner part adaptive execution may split a customer with very many
    orders (it may not on the right of an outer join), and the anti part only
    sees one row per buyer.
    """
    matched = customers.join(orders, "customer_id", "inner")
    idle = customers.join(orders.select("customer_id").distinct(), "customer_id", "left_anti")
    return matched, idle


def customers_with_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """customers left join orders."""
    matched, idle = buyers_and_idle(customers, orders)
    return matched.unionByName(idle, allowMissingColumns=True)


def items_with_products(items: DataFrame, products: DataFrame) -> DataFrame:
    return left_join(items, products, "product_id")


def payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").cast("decimal(18,2)").alias("payment_value"),
        F.count(F.lit(1)).alias("payment_count"),
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("review_score"), F.count(F.lit(1)).alias("review_count")
    )


def consolidate(
    tables: Tables,
    driving: str = "customers",
    mode: str = "fanout",
    null_keys: str = "sql",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """The wide sales table.

    ``hot_rows`` is the size from which one order's payments, items or reviews
    are salted; None skips the look at key frequencies, which costs one pass
    over the key column of each table.
    """
    if driving not in ("customers", "orders"):
        raise ValueError("driving is 'customers' or 'orders'")
    if mode not in ("fanout", "preaggregate"):
        raise ValueError("mode is 'fanout' or 'preaggregate'")
    if driving == "orders":
        tables = order_first_tables(tables)
    else:
        tables = {name: tables[name] for name in ("customers", "orders", "payments", "items", "products")}
    if mode == "preaggregate":
        tables["payments"] = payments_per_order(tables["payments"])
        if "reviews" in tables:
            tables["reviews"] = reviews_per_order(tables["reviews"])

    # What is already one row per order needs no salt.
    many = ["items"] if mode == "preaggregate" else [t for t in ("payments", "items", "reviews") if t in tables]
    hot: dict[str, list] = {}
    if hot_rows and null_keys == "sql":
        hot = hot_keys_of({name: tables[name] for name in many}, "order_id", hot_rows)

    def per_order(spine: DataFrame, parts: Tables) -> DataFrame:
        """Left join the parts on the order, those with hot keys last: a salted
        join leaves its rows in another partitioning. Parts of one row per order
        come first, so that they are joined before the items multiply the rows."""
        wide = spine
        for name in sorted(parts, key=lambda name: (bool(hot.get(name)), name in many)):
            wide = left_join(wide, parts[name], "order_id", null_keys=null_keys, hot=hot.get(name))
        columns = [c for df in (spine, *parts.values()) for c in df.columns if c != "order_id"]
        return wide.select("order_id", *columns)

    customers, orders, items, products = (tables[t] for t in ("customers", "orders", "items", "products"))
    payments = {"payments": tables["payments"]}
    if driving == "orders":
        spine = left_join(orders, customers, "customer_id", null_keys=null_keys)
        reviews = {"reviews": tables["reviews"]}
        if null_keys == "match":
            # Orders without items meet a product without id: products last.
            wide = left_join(per_order(spine, payments | {"items": items}), products, "product_id", null_keys="match")
            return per_order(wide, reviews)
        # Products first, so all joins on the order share one partitioning.
        return per_order(spine, payments | {"items": items_with_products(items, products)} | reviews)

    lines = {"items": left_join(items, products, "product_id", null_keys=null_keys)}
    if null_keys == "match":
        return per_order(left_join(customers, orders, "customer_id", null_keys="match"), payments | lines)

    # Customers without orders have no order key to join on: they skip the
    # order joins, which also keeps one huge NULL key out of them.
    matched, idle = buyers_and_idle(customers, orders)
    return per_order(matched, payments | lines).unionByName(idle, allowMissingColumns=True)


def order_first_tables(tables: Tables) -> dict[str, DataFrame]:
    """The tables with the columns that the order-first consolidation reads."""
    return {name: project(tables[name], _order_first_columns(tables[name], name)) for name in K.ORDER_FIRST_COLUMNS}


def _order_first_columns(df: DataFrame, name: str) -> list[str]:
    """The declared subset, plus the item ordinal when the table has one."""
    columns = K.ORDER_FIRST_COLUMNS[name]
    if name == "items" and "order_item_id" in df.columns:
        return [*columns, "order_item_id"]
    return columns


def sales_by_state(tables: Tables) -> DataFrame:
    """Fan-out sums per state without building the fan-out.

    Rows and price of payments x items of one order follow from its counts,
    so payments and items are reduced to one row per order, and orders to one
    row per customer, before each is joined: every join is one to one, and a
    customer or order with very many rows is merged before the shuffle.
    """
    paid = tables["payments"].groupBy("order_id").agg(F.count(F.lit(1)).alias("payment_rows"))
    lines = tables["items"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_rows"), F.sum("price").alias("item_price")
    )
    payment_rows = F.coalesce("payment_rows", F.lit(1))
    per_customer = (
        tables["orders"].select("order_id", "customer_id")
        .join(paid, "order_id", "left")
        .join(lines, "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.sum(payment_rows * F.coalesce("item_rows", F.lit(1))).alias("rows"),
            F.sum(F.col("item_price") * payment_rows).cast("decimal(38,2)").alias("price"),
        )
    )
    customers = tables["customers"].select("customer_id", "customer_state")
    return customers.join(per_customer, "customer_id", "left").groupBy("customer_state").agg(
        F.sum(F.coalesce("rows", F.lit(1))).alias("wide_rows"),
        F.count_distinct("customer_id").alias("customers"),
        F.sum("price").cast("decimal(38,2)").alias("price_total"),
    )
