"""Filters, scalar functions, ranking, numbering, aggregates."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakestrata.functions import text, time
from lakestrata.operators import aggregates, filters, ranking
from lakestrata.operators.dedupe import dedupe_first, with_sequence


def column(df):
    return [r[0] for r in df.collect()]


def eval_all(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return column(df.orderBy("i").select(build(F.col("v"))))


def test_safe_number_and_price_filter(spark):
    raw = ["100", "100.01", "abc", "", None, "NaN", "Infinity", " 150 ", "-5"]
    numbers = eval_all(spark, raw, text.safe_number)
    assert numbers[:5] == [100.0, 100.01, None, None, None] and numbers[7:] == [150.0, -5.0]
    df = spark.createDataFrame([(v,) for v in raw], "v string").select(text.safe_number(F.col("v")).alias("p"))
    assert sorted(column(filters.filter_min(df, "p", 100))) == [100.01, 150.0, float("inf")]


def test_default_text(spark):
    assert eval_all(spark, [None, " ", " SP ", ""], lambda c: text.default_text(c, "UNKNOWN")) == [
        "UNKNOWN", "UNKNOWN", "SP", "UNKNOWN",
    ]


def test_default_ts_and_stamps(spark):
    got = eval_all(spark, ["2024-01-01 10:00:00", "bad", None], lambda c: time.default_ts(c, "2024-02-01 00:00:00"))
    assert [str(v) for v in got] == ["2024-01-01 10:00:00", "2024-02-01 00:00:00", "2024-02-01 00:00:00"]
    assert eval_all(spark, ["2024-01-02 03:04:05"], lambda c: time.version_stamp(c.cast("timestamp_ntz"))) == ["v20240102030405"]
    assert eval_all(spark, ["2024-02-28"], lambda c: time.add_days(c.cast("timestamp_ntz"), 2).cast("string")) == ["2024-03-01 00:00:00"]
    stamped = time.stamp(spark.range(1), "at", "2024-01-01 00:00:00")
    assert str(stamped.first()["at"]) == "2024-01-01 00:00:00"
    assert time.stamp(spark.range(1), "at").first()["at"] is not None


def test_json_and_text_helpers(spark):
    assert eval_all(spark, ["ação"], lambda c: text.as_json(c.alias("v"))) == ['{"v":"ação"}']
    assert eval_all(spark, ['{"k": 3}', "{bad"], lambda c: text.parse_json(c, "k int")["k"]) == [3, None]
    assert eval_all(spark, ["a - b - c", "x"], lambda c: text.before_first(c, " - ")) == ["a", "x"]
    assert eval_all(spark, ["write"], text.prefixed_upper) == ["OP_WRITE"]
    long_text = "ÿ>?" * 60
    assert eval_all(spark, [long_text], lambda c: text.unb64url(text.b64url(c)).cast("string")) == [long_text]
    assert "\n" not in eval_all(spark, [long_text], text.b64url)[0]
    assert eval_all(spark, [1048576 * 3], text.as_mb, "bigint") == [3.0]


def test_first_element_of_empty_array(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (None,)], "a array<int>")
    assert column(df.select(text.first_element(F.col("a")))) == [1, None, None]


def test_classify_is_strict(spark):
    got = eval_all(spark, [100.0, 100.1, 80.0, 80.1], lambda c: text.classify(c, [100, 80], ["EX", "HIGH"], "OK"), "double")
    assert got == ["HIGH", "EX", "OK", "HIGH"]
    with pytest.raises(ValueError):
        text.classify(F.lit(1), [1], [], "x")


def test_not_equal_keeps_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert set(column(filters.filter_not_equal(df, "v", "a"))) == {"b", None}


def test_time_range_is_closed(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-31 00:00:00",), ("2024-01-31 00:00:01",)], "t string")
    df = df.select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert filters.between_ts(df, "t", "2024-01-01 00:00:00", "2024-01-31 00:00:00").count() == 2
    assert filters.last_days(df, "t", 30, "2024-01-31 00:00:00").count() == 3
    assert filters.last_days(df, "t", 30, "2024-01-31 00:00:01").count() == 2


def test_age_split_boundary(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00",), ("2023-12-31 23:59:59.999999",), (None,)], "t string"
    ).select(F.col("t").cast("timestamp_ntz").alias("t"))
    hot, cold = filters.split_by_age(df, "t", as_of="2024-01-31 00:00:00")
    assert hot.count() == 2 and str(cold.first()[0]) == "2023-12-31 23:59:59.999999"
    dated = df.withColumn("day", F.to_date("t"))
    parts = filters.split_by_age(dated, "t", as_of="2024-01-31 12:00:00", day_column="day")
    assert [p.count() for p in parts] == [1, 2]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ages=st.lists(st.one_of(st.none(), st.integers(0, 90)), min_size=1, max_size=30), days=st.integers(0, 60))
def test_age_split_covers_the_input(spark, ages, days):
    df = spark.createDataFrame([(a,) for a in ages], "age int").select(
        "age", (F.lit("2024-06-01").cast("timestamp_ntz") - F.make_interval(days=F.col("age"))).alias("t")
    )
    hot, cold = filters.split_by_age(df, "t", days, as_of="2024-06-01 00:00:00")
    key = lambda a: (a is None, a)
    assert sorted(column(hot) + column(cold), key=key) == sorted(ages, key=key)
    assert all(a is not None and a > days for a in column(cold))


def test_out_of_range_bounds(spark):
    df = spark.createDataFrame([(-10.0,), (50.0,), (-10.1,), (50.1,), (None,)], "v double")
    assert sorted(column(filters.out_of_range(df, "v", -10, 50))) == [-10.1, 50.1]


def test_normalise_na_only_touches_text(spark):
    df = spark.createDataFrame([("N/A", 1), ("nan", 2), ("ok", 3), ("", None), ("Null", 4)], "s string, n int")
    assert column(filters.normalise_na(df).select("s")) == [None, None, "ok", None, "Null"]


def test_map_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert filters.map_columns(df, {"x": "a", "y": "b"}, {"y": "N/A"}).first() == (1, "N/A")
    with pytest.raises(ValueError):
        filters.map_columns(df, {"y": "b"})


def test_contains_is_case_sensitive(spark):
    df = spark.createDataFrame([("LOGIN_FAILURE",), ("login_failure",)], "v string")
    assert column(filters.filter_contains(df, "v", "login")) == ["login_failure"]


def test_dedupe_first(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, "c"), (None, 1, "n"), (None, 0, "m")], "k int, o int, v string")
    got = {r["k"]: r["v"] for r in dedupe_first(df, ["k"], ["o"]).collect()}
    assert got == {1: "a", 2: "c", None: "m"}


def test_sequence_over_many_partitions(spark):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("v"))
    numbered = with_sequence(df, ["k"], "n", partitions=13)
    assert numbered.columns == ["k", "v", "n"]
    assert numbered.where("n <> k + 1").count() == 0 and numbered.count() == 5_000


def test_sequence_when_one_value_dominates(spark):
    df = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("k"), "id")
    numbered = with_sequence(df, ["k", "id"], "n", partitions=8)
    assert sorted(column(numbered.select("n"))) == list(range(1, 3_001))


def test_top_k_ties_and_null(spark):
    values = ["a"] * 3 + ["b"] * 3 + ["c"] * 2 + ["d", "e", "f", None, None, None, None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [tuple(r) for r in ranking.top_k_values(df, "v", 4).collect()] == [("a", 3), ("b", 3), ("c", 2), ("d", 1)]


def test_limits(spark):
    df = spark.range(50)
    assert ranking.limit_events(df, ["id"]).count() == 30
    assert ranking.limit_events(df, ["id"], 0).count() == ranking.limit_events(df, ["id"], None).count() == 50
    assert column(ranking.sample_rows(df, [F.col("id").desc()])) == [49, 48, 47]


def test_null_fraction(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert tuple(aggregates.null_fraction(df).first()) == (3, 4, 0.75)
    assert tuple(aggregates.null_fraction(df.where("1 = 0")).first()) == (0, 0, None)


def test_compliance_rate_of_nothing(spark):
    df = spark.createDataFrame([("x",)], "v string")
    assert aggregates.compliance_rate(df.where("1 = 0"), F.col("v") == "x").first()["rate"] == 0.0
    assert aggregates.compliance_rate(df, F.col("v") == "x").first()["rate"] == 100.0
