from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.joins import (
    broadcast_if_small, hot_keys, hot_keys_of, join_with_suffixes, left_join, orphan_keys,
)
from lakestrata.plans.consolidate import consolidate


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    return {
        # c3 never ordered; o2 has no items; o1 has 2 payments x 3 items and 2 reviews.
        "customers": make(
            [("c1", "u1", "sp", "SP"), ("c2", "u2", "rj", "RJ"), ("c3", "u3", "bh", "MG")],
            "customer_id string, customer_unique_id string, customer_city string, customer_state string",
        ),
        "orders": make(
            [("o1", "c1", "delivered", "2024-01-01 10:00:00"), ("o2", "c2", "created", "2024-01-02 10:00:00"),
             ("o4", "c9", "created", "2024-01-03 10:00:00")],
            "order_id string, customer_id string, order_status string, order_purchase_timestamp string",
        ).withColumn("order_purchase_timestamp", F.col("order_purchase_timestamp").cast("timestamp_ntz")),
        "payments": make(
            [("o1", "card", 10.0), ("o1", "voucher", 5.0), ("o2", "card", 7.0)],
            "order_id string, payment_type string, payment_value double",
        ),
        "items": make(
            [("o1", 1, "p1", 1.0, 0.1), ("o1", 2, "p2", 2.0, 0.2), ("o1", 3, None, 3.0, 0.3), (None, 1, "p1", 4.0, 0.4)],
            "order_id string, order_item_id int, product_id string, price double, freight_value double",
        ),
        "products": make(
            [("p1", "toys", 5), (None, "ghost", 0)],
            "product_id string, product_category_name string, product_weight_g int",
        ),
        "reviews": make([("o1", 5), ("o1", 1)], "order_id string, review_score int"),
    }


def test_customer_first_fans_out(tables):
    wide = consolidate(tables)
    per_order = {r["order_id"]: r["count"] for r in wide.groupBy("order_id").count().collect()}
    assert per_order == {"o1": 6, "o2": 1, None: 1}
    idle = wide.where("order_id is null").first()
    assert idle["customer_id"] == "c3" and idle["price"] is None
    # The item without a product stays, and does not meet the NULL product.
    assert wide.where("price = 3.0 and product_category_name is null").count() == 2


def test_order_first_keeps_orders_of_unknown_customers(tables):
    wide = consolidate(tables, driving="orders")
    per_order = {r["order_id"]: r["count"] for r in wide.groupBy("order_id").count().collect()}
    assert per_order == {"o1": 12, "o2": 1, "o4": 1}
    assert wide.where("order_id = 'o4'").first()["customer_state"] is None


def test_preaggregate_does_not_double_count(tables):
    wide = consolidate(tables, driving="orders", mode="preaggregate")
    o1 = wide.where("order_id = 'o1'")
    assert o1.count() == 3
    first = o1.first()
    assert (float(first["payment_value"]), first["payment_count"], first["review_score"]) == (15.0, 2, 3.0)


def test_null_keys_match_like_a_data_frame_merge(spark, tables):
    wide = consolidate(tables, null_keys="match")
    # The customer without orders meets the item without order id ...
    assert wide.where("customer_id = 'c3'").first()["price"] == 4.0
    # ... and items without a product meet the product without id.
    assert wide.where("price = 3.0").first()["product_category_name"] == "ghost"
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    right = spark.createDataFrame([(None, 10), (None, 20), ("b", 30)], "k string, y int")
    assert rows(left_join(left, right, "k", null_keys="match")) == rows(
        spark.createDataFrame([(None, 1, 10), (None, 1, 20), ("a", 2, None)], "k string, x int, y int")
    )
    assert rows(left_join(left, right, "k")) == [("a", 2, None), (None, 1, None)]


def test_unknown_modes_are_errors(tables):
    for bad in ({"driving": "items"}, {"mode": "pairs"}):
        with pytest.raises(ValueError):
            consolidate(tables, **bad)
    with pytest.raises(ValueError):
        left_join(tables["orders"], tables["items"], "order_id", null_keys="maybe")


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the right side, a third of it exact copies."""
    ids = spark.range(9_000)
    right = ids.select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("k"),
        F.when(F.col("id") % 9 == 0, F.lit(-1)).otherwise(F.col("id")).alias("y"),
    )
    left = spark.range(600).select(
        F.when(F.col("id") > 550, F.lit(None)).otherwise(F.col("id")).alias("k"), (F.col("id") * 2).alias("x")
    )
    return left, right


def test_hot_keys_finds_the_heavy_one(skewed):
    left, right = skewed
    assert hot_keys(right, "k", min_rows=2_000) == [7]
    assert hot_keys(right, "k", min_rows=5_000) == []
    assert hot_keys_of({"l": left, "r": right}, "k", min_rows=2_000) == {"l": [], "r": [7]}


def test_salted_join_equals_the_plain_join(skewed):
    left, right = skewed
    plain = left.join(right, "k", "left")
    salted = left_join(left, right, "k", hot=[7, 11], salts=16)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)
    twice = left.unionByName(left)
    assert rows(left_join(twice, right, "k", hot=[7], salts=4)) == rows(twice.join(right, "k", "left"))


def test_salts_spread_copies_over_partitions(spark, skewed):
    _, right = skewed
    from lakestrata.operators.joins import _salt

    copies = right.where("y = -1").repartition(8, F.rand(1))
    used = copies.select(_salt(copies.columns, 32).alias("s")).distinct().count()
    assert used > 1


def test_consolidate_with_hot_orders_is_unchanged(tables):
    for driving in ("customers", "orders"):
        plain = consolidate(tables, driving=driving, hot_rows=None)
        salted = consolidate(tables, driving=driving, hot_rows=2)
        assert rows(plain) == rows(salted)


def test_suffixes_only_touch_shared_columns(spark):
    left = spark.createDataFrame([(1, 2, 3)], "k int, price int, a int")
    right = spark.createDataFrame([(1, 4, 5)], "k int, price int, b int")
    joined = join_with_suffixes(left, right, "k")
    assert joined.columns == ["k", "price_order", "a", "price_item", "b"]


def test_orphans(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(2,)], "id int")
    assert rows(orphan_keys(fact, dim, "k", "id")) == [(1, 2)]


def test_broadcast_only_behind_a_size_check(spark):
    small, big = spark.range(10), spark.range(1_000)
    probe = spark.range(100)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(probe.join(broadcast_if_small(small, 100), "id"))
    assert "broadcast" not in plan(probe.join(broadcast_if_small(big, 100), "id"))


@pytest.mark.parametrize("has_null", [True, False])
def test_null_key_is_dealt_over_tasks_and_matches(spark, has_null):
    left = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (2, 4)], "k int, a int")
    right = spark.createDataFrame([(1, 10), (1, 11), *([(None, n) for n in range(20, 60)] if has_null else [])], "k int, b int")
    want = [(1, 3, 10), (1, 3, 11), (2, 4, None)]
    want += [(None, a, n) for a in (1, 2) for n in (range(20, 60) if has_null else [None])]
    out = left_join(left, right, "k", null_keys="match")
    assert out.columns == ["k", "a", "b"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    with_hot = left_join(left, right, "k", null_keys="match", hot=[1])
    assert sorted(map(tuple, with_hot.collect()), key=repr) == sorted(want, key=repr)


def test_hot_list_holds_every_key_above_its_share(spark):
    rows = [(k,) for k in range(4) for _ in range(50)] + [(k,) for k in range(100, 140)]
    df = spark.createDataFrame(rows, "k int")
    # 240 rows: with a list of 4, a key is hot from 60 rows on whatever the floor is.
    assert hot_keys(df, "k", 1, 4) == []
    assert sorted(hot_keys(df, "k", 1, 8)) == [0, 1, 2, 3]
