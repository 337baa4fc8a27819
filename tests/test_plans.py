"""Plan shape of the operators that matter at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import quality
from lakestrata.operators.dedupe import dedupe_first, with_sequence
from lakestrata.plans.consolidate import consolidate
from lakestrata.settings import apply_scale_settings, shared_dir
from lakestrata.sources.domain import domain_tables, table
from lakestrata.workload.registry import load_all

SF = "/root/testdata/sf0.001"


@pytest.fixture
def plan_of(capsys):
    def show(df):
        capsys.readouterr()
        df.explain()
        return capsys.readouterr().out

    return show


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def scans(plan):
    return len(re.findall(r"FileScan", plan))


def test_a_suite_is_one_scan_with_pruned_columns(spark, plan_of):
    suite = [
        {"type": "not_null", "column": "l_orderkey"}, {"type": "between", "column": "l_quantity", "min": 0},
        {"type": "in_set", "column": "l_returnflag", "values": ["A"]},
    ]
    plan = plan_of(quality.validate(table(spark, SF, "lineitem"), suite))
    assert scans(plan) == 1
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in plan


def test_dedupe_limits_groups_before_the_shuffle(spark, plan_of):
    plan = plan_of(dedupe_first(table(spark, SF, "lineitem"), ["l_orderkey"], ["l_partkey"]))
    partial, exchange = plan.index("row_number(), 1, Partial"), plan.index("Exchange hashpartitioning")
    assert exchange < partial  # plans print from the top: partial runs first


def test_order_joins_share_one_partitioning(spark, plan_of, no_broadcast):
    plan = plan_of(consolidate(domain_tables(spark, SF), driving="orders"))
    by_order = re.findall(r"Exchange hashpartitioning\(order_id#\d+L, \d+\)", plan)
    assert len(by_order) == 4  # spine, payments, items, reviews; the wide rows move once


def test_one_row_per_order_is_joined_before_the_items(spark, plan_of, no_broadcast):
    plan = plan_of(consolidate(domain_tables(spark, SF), driving="orders", mode="preaggregate"))
    joins = [line for line in plan.splitlines() if "SortMergeJoin [order_id" in line]
    # Plans print from the top: the last join on the order is the first one.
    assert len(joins) == 3
    below = plan[plan.index(joins[0]):plan.index(joins[1])]
    assert "review_score" not in joins[0] and plan.index(joins[1]) < plan.index("avg(review_score") < plan.index("l_partkey")
    assert "l_linenumber" not in below


def test_filters_and_columns_reach_the_scan(spark, plan_of):
    queries = load_all()
    plan = plan_of(queries["between_ts"].run(spark, SF))
    assert "GreaterThanOrEqual(ts," in plan and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan
    plan = plan_of(queries["sales_by_masked_state"].run(spark, SF))
    assert "l_tax" not in plan and "l_shipdate" not in plan


def test_numbering_has_no_single_task_sort_of_the_rows(spark, plan_of):
    numbered = with_sequence(table(spark, SF, "orders").select("o_orderkey"), ["o_orderkey"])
    plan = plan_of(numbered)
    single = plan[plan.index("Exchange SinglePartition"):]
    assert "HashAggregate" in single  # only the row counts per part meet in one task
    assert scans(plan) == 2


def test_salting_only_touches_hot_keys(spark, plan_of):
    queries = load_all()
    plan = plan_of(queries["consolidate_order_first"].run(spark, SF))
    assert "_salt" not in plan
    assert "_salt" in plan_of(queries["join_hot_keys_salted"].run(spark, SF))


def test_settings_respect_the_cluster(spark):
    apply_scale_settings(spark)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir", shared_dir(spark)).rstrip("/")


def test_zscore_reads_the_table_once_for_its_moments(spark, plan_of):
    plan = plan_of(load_all()["zscore_outliers"].run(spark, SF))
    assert "BroadcastNestedLoopJoin" not in plan and "Subquery" in plan


def test_group_sizes_do_not_reach_the_driver(spark):
    """A customer with a third of all orders gives the same consolidated rows."""
    tables = domain_tables(spark, SF)
    orders = tables["orders"]
    tables["orders"] = orders.withColumn(
        "customer_id", F.when(F.col("order_status") == "F", F.lit(1).cast("bigint")).otherwise(F.col("customer_id"))
    )
    wide = consolidate(tables, hot_rows=5)
    plain = consolidate(tables, hot_rows=None)
    assert wide.exceptAll(plain).isEmpty() and plain.exceptAll(wide).isEmpty()
