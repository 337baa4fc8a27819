from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import quality
from lakestrata.operators.quality import QualityGateError, validate


@pytest.fixture(scope="module")
def sales(spark):
    rows = [
        ("o1", 0.0, "delivered", "1"), ("o2", 10000.0, "shipped", "2"), ("o3", 10000.01, "lost", "x"),
        (None, None, None, None), ("o5", -0.01, "created", "5"),
    ]
    return spark.createDataFrame(rows, "order_id string, price double, order_status string, code string")


def by_rule(df):
    return {r["rule_id"]: r for r in df.collect()}


def test_rules_ignore_null_and_include_bounds(sales):
    suite = [
        {"type": "not_null", "column": "order_id"},
        {"type": "between", "column": "price", "min": 0, "max": 10000},
        {"type": "between", "column": "price", "min": 0, "max": None},
        {"type": "in_set", "column": "order_status", "values": ["delivered", "shipped", "created"]},
        {"type": "of_type", "column": "code", "as": "int"},
        {"type": "between", "column": "price", "max": 1e9},
        {"type": "between", "column": "price", "min": 0, "max": 10000, "mostly": 0.5},
    ]
    got = by_rule(validate(sales, suite))
    assert [(got[i]["unexpected"], got[i]["tested"]) for i in range(7)] == [
        (1, 5), (2, 4), (1, 4), (1, 4), (1, 4), (0, 4), (2, 4),
    ]
    assert [got[i]["success"] for i in range(7)] == [False, False, False, False, False, True, True]
    assert got[1]["unexpected_percent"] == 50.0


def test_examples_are_distinct_sorted_and_bounded(spark):
    df = spark.range(1_000).select((F.col("id") % 20).cast("string").alias("v"))
    got = by_rule(validate(df, [
        {"type": "in_set", "column": "v", "values": ["0"]}, {"type": "not_null", "column": "v"},
    ], examples=5))
    assert got[0]["examples"] == ["1", "10", "11", "12", "13"] and got[0]["unexpected"] == 950
    assert got[1]["examples"] is None
    clean = validate(df, [{"type": "not_null", "column": "v"}], examples=5).first()
    assert clean["examples"] is None and clean["success"]


def test_empty_table_and_all_null(spark):
    suite = [{"type": "not_null", "column": "v"}, {"type": "between", "column": "v", "min": 0}]
    empty = spark.createDataFrame([], "v int")
    assert all(r["success"] for r in validate(empty, suite).collect())
    nulls = by_rule(validate(spark.createDataFrame([(None,), (None,)], "v int"), suite))
    assert not nulls[0]["success"] and nulls[0]["unexpected"] == 2
    assert nulls[1]["success"] and nulls[1]["tested"] == 0


def test_bad_suites(sales):
    for suite in ([], [{"type": "magic", "column": "price"}], [{"type": "not_null", "column": "nope"}],
                  [{"type": "between", "column": "price"}]):
        with pytest.raises(ValueError):
            validate(sales, suite)


def test_parse_suite():
    document = {
        "expectation_suite_name": "s",
        "expectations": [
            {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "order_id"}},
            {"expectation_type": "expect_column_values_to_be_between",
             "kwargs": {"column": "price", "min_value": 0, "max_value": 10000}},
        ],
    }
    assert quality.parse_suite(document) == [
        {"type": "not_null", "column": "order_id"}, {"type": "between", "column": "price", "min": 0, "max": 10000},
    ]
    for bad in ({"expectations": []}, {"expectation_suite_name": "s"}, {
        "expectation_suite_name": "s", "expectations": [{"expectation_type": "expect_magic", "kwargs": {"column": "c"}}],
    }):
        with pytest.raises(ValueError):
            quality.parse_suite(bad)


@pytest.mark.parametrize("good,below", [(19, False), (18, True), (20, False)])
def test_summary_threshold_is_strict(spark, good, below):
    results = spark.createDataFrame([(i, "r", i < good) for i in range(20)], "rule_id int, rule_type string, success boolean")
    summary = quality.suite_summary(results).first()
    assert (summary["below_threshold"], summary["success"]) == (below, good == 20)
    assert summary["success_rate"] == good / 20


def test_failed_rules_text(spark):
    results = spark.createDataFrame([(0, "b", False), (1, "a", False), (2, "b", False), (3, "c", True)],
                                    "rule_id int, rule_type string, success boolean")
    assert quality.failed_rule_summary(results).first()[0] == "a, b"
    assert quality.failed_rule_summary(results.where("success")).first()[0] == ""


def test_gate(sales):
    with pytest.raises(QualityGateError, match="order_id"):
        quality.quality_gate(sales, [{"type": "not_null", "column": "order_id"}])
    passed = quality.quality_gate(sales, [{"type": "not_null", "column": "order_id", "mostly": 0.8}])
    assert passed.first()["success"]


def test_quarantine_partitions_the_input(sales):
    suite = [{"type": "not_null", "column": "order_id"}, {"type": "between", "column": "price", "min": 0, "max": 10000}]
    good, bad = quality.quarantine(sales, suite)
    assert {r["order_id"] for r in good.collect()} == {"o1", "o2"}
    assert {(r["order_id"], tuple(r["failed_rules"])) for r in bad.collect()} == {("o3", (1,)), (None, (0,)), ("o5", (1,))}


def test_registered_rule(spark):
    quality.register_rule("even", lambda df, c, rule: c % 2 != 0)
    assert validate(spark.range(5), [{"type": "even", "column": "id"}]).first()["unexpected"] == 2


def test_outliers(spark):
    df = spark.range(1_000).select(F.when(F.col("id") == 7, F.lit(1e6)).otherwise(F.col("id") % 10).alias("v"))
    assert [r["v"] for r in quality.zscore_outliers(df, "v").collect()] == [1e6]
    assert quality.quarantine(df, [{"type": "iqr", "column": "v"}])[1].count() == 1


def test_check_collected(spark):
    ok = spark.createDataFrame([(float(t), "x") for t in (-10, 50, 20)], "temperatura double, c string")
    hot = ok.unionByName(spark.createDataFrame([(-10.1, None), (50.1, "x")], "temperatura double, c string"))
    rows = {r["source"]: r for r in quality.check_collected({"ok": ok, "hot": hot, "gone": None}).collect()}
    assert (rows["ok"]["status"], rows["ok"]["extreme_rows"]) == ("OK", 0)
    assert (rows["hot"]["status"], rows["hot"]["null_percent"], rows["hot"]["extreme_rows"]) == ("NULLS", 10.0, 2)
    assert rows["gone"]["status"] == "MISSING"


def test_nan_is_unexpected_but_hides_nothing(spark):
    values = [float(v) for v in range(50)] + [1e6, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    low = validate(df, [{"type": "between", "column": "v", "min": -1}]).first()
    assert (low["unexpected"], low["success"]) == (1, False)
    for kind in ("zscore", "iqr"):
        bad = quality.quarantine(df, [{"type": kind, "column": "v"}])[1]
        assert sorted(str(r["v"]) for r in bad.collect()) == ["1000000.0", "nan"]
