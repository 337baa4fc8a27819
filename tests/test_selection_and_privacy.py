"""Exact quantiles, permuted pseudonyms, private totals, bounded examples."""

from __future__ import annotations

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakestrata.functions import masking
from lakestrata.functions.permute import halves, permuted, permuted_digits
from lakestrata.operators import quality
from lakestrata.operators.private import bounded_rows, private_totals, show_threshold
from lakestrata.operators.quantiles import exact_quantiles

SHARES = [0, 0.01, 0.25, 0.5, 0.75, 0.999, 1]


def plain_quantiles(values, shares):
    known = sorted(v for v in values if v is not None and not math.isnan(v))
    return [known[max(1, math.ceil(round(s * len(known), 9))) - 1] if known else None for s in shares]


@pytest.mark.parametrize("bins,few", [(4096, 10_000), (3, 2), (2, 1)])
def test_quantiles_of_odd_values(spark, bins, few):
    rng = random.Random(bins)
    cases = [
        [], [None, float("nan")], [5.0], [1.0] * 50 + [2.0] * 50, [float(i) for i in range(101)],
        [rng.choice([0.0, -0.0, 1e-300, 1e300, -1e300, 3.5, float("inf"), float("-inf"), None, float("nan")]) for _ in range(200)],
        [rng.lognormvariate(0, 5) for _ in range(300)], [7.25] * 1000 + [rng.random() for _ in range(9)],
    ]
    for values in cases:
        df = spark.createDataFrame([(v,) for v in values], "v double")
        assert exact_quantiles(df, "v", SHARES, bins=bins, few=few) == plain_quantiles(values, SHARES)
    with pytest.raises(ValueError):
        exact_quantiles(spark.range(1), "id", [1.5])


def test_quantiles_sort_and_collect_nothing(spark, monkeypatch):
    """Passes over many distinct values end in small aggregates."""
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    got = exact_quantiles(df, "v", [0.25, 0.75])
    want = df.stat.approxQuantile("v", [0.25, 0.75], 0.0)
    assert all(abs(a - b) <= 2 for a, b in zip(got, want))
    assert df.where(F.col("v") <= got[0]).count() == 50_000 and df.where(F.col("v") < got[0]).count() == 49_999


def test_iqr_with_nan_and_ties(spark):
    values = [10.0] * 40 + [11.0] * 40 + [12.0] * 20 + [100.0, -50.0, float("nan"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    bad = quality.quarantine(df, [{"type": "iqr", "column": "v"}])[1]
    assert sorted(r["i"] for r in bad.collect()) == [100, 101, 102]
    nothing = quality.quarantine(df.where("v is null"), [{"type": "iqr", "column": "v"}])[1]
    assert nothing.count() == 0


def test_permutation_of_every_number(spark):
    """No two of all 10 ** 5 numbers meet, and none leaves the range."""
    size = 10 ** 5
    out = spark.range(size).select(permuted(F.col("id"), size, "key").alias("p"), "id")
    seen = out.agg(F.count_distinct("p").alias("n"), F.min("p").alias("low"), F.max("p").alias("high"), F.count_if(F.col("p") == F.col("id")).alias("same"))
    assert seen.first()[:3] == (size, 0, size - 1) and seen.first()["same"] < 20
    other = spark.range(100).select(permuted(F.col("id"), size, "other").alias("p")).collect()
    assert other != out.orderBy("id").select("p").limit(100).collect()


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(2, 3_000), st.text(min_size=1, max_size=5))
def test_permutation_of_ranges_of_any_size(spark, size, key):
    a, b = halves(size)
    assert size <= a * b < size + 2 * a + 1
    got = {r[0] for r in spark.range(size).select(permuted(F.col("id"), size, key)).collect()}
    assert got == set(range(size))


def test_permutation_refuses_what_it_cannot_do(spark):
    with pytest.raises(ValueError):
        permuted(F.lit(1), 10, "")
    with pytest.raises(ValueError):
        permuted(F.lit(1), 1, "key")
    with pytest.raises(Exception, match="outside"):
        spark.range(1).select(permuted(F.lit(10), 10, "key")).collect()
    assert spark.range(1).select(permuted(F.lit(None).cast("long"), 10, "key")).first()[0] is None


def test_permuted_pseudonyms_are_distinct_and_keep_their_form(spark):
    rows = [(f"{i:09d}00", f"Customer#{i:04d}", f"+55 11 9{i:04d}-{i % 7:04d}") for i in range(2_000)]
    df = spark.createDataFrame(rows + [(None, None, None), ("no cpf", "a1b2", "123")], "cpf string, code string, phone string")
    out = df.select(*[masking.mask_permuted(F.col(c), k, "key").alias(c) for c, k in (("cpf", "cpf"), ("code", "numbered"), ("phone", "phone"))])
    got = out.collect()
    for c, form in (("cpf", r"\d{3}\.\d{3}\.\d{3}-\d{2}"), ("code", r"Customer#\d{4}"), ("phone", r"\+55 11 9\d{4}-\d{4}")):
        values = [r[c] for r in got]
        assert len(set(values)) == 2_002 and values.count(None) == 1
        assert out.where(F.col(c).rlike(f"^{form}$")).count() == 2_000
        assert out.where(F.length(c) == 64).count() == 1
    # Punctuation does not make another person of a CPF, and check digits fit.
    same = spark.createDataFrame([("123.456.789-09",), ("12345678909",)], "c string").select(masking.mask_permuted(F.col("c"), "cpf", "k")).collect()
    assert same[0] == same[1]
    digits = [int(d) for d in same[0][0] if d.isdigit()]
    for n in (9, 10):
        assert digits[n] == sum(d * (n + 1 - i) for i, d in enumerate(digits[:n])) * 10 % 11 % 10
    with pytest.raises(ValueError, match="kind"):
        masking.mask_permuted(F.col("c"), "word", "k")


def test_numbers_of_any_width_are_permuted_once(spark):
    """All widths share one permutation a row, with the result of each width's own."""
    rows = [(w, n) for w in range(1, 16) for n in {0, 1, 10 ** w - 1, 10 ** w // 3}] + [(None, None), (3, None)]
    df = spark.createDataFrame(rows, "w int, n long")
    out = df.select("w", "n", permuted_digits(F.col("n"), F.col("w"), "key").alias("p"))
    single = F.coalesce(*[permuted(F.when(F.col("w") == w, F.col("n")), 10 ** w, f"key|{w}") for w in range(1, 16)])
    assert sorted(map(str, out.collect())) == sorted(map(str, df.select("w", "n", single.alias("p")).collect()))
    with pytest.raises(Exception, match="outside"):
        spark.range(1).select(permuted_digits(F.lit(100), F.lit(2), "key")).collect()
    with pytest.raises(ValueError):
        permuted_digits(F.lit(1), F.lit(1), "")
    masked = df.select(masking.mask_permuted(F.lpad(F.col("n").cast("string"), 5, "0"), "numbered", "key").alias("m"))
    plan = masked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1


def test_masking_of_a_one_task_table_uses_all_cores(spark):
    from lakestrata.workload.registry import load_all

    out = load_all()["mask_permuted"].run(spark, "/root/testdata/sf0.001")
    assert out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


ORDERS = "person string, grp string, v double, id int"


def test_one_person_counts_for_a_bounded_number_of_rows(spark):
    rows = [("hot", f"g{i % 50}", 1e9, i) for i in range(5_000)] + [(f"p{i}", "g0", 2.0, 10_000 + i) for i in range(3_000)] + [(None, "g0", 5.0, -1)]
    df = spark.createDataFrame(rows, ORDERS).repartition(8)
    kept = bounded_rows(df, "person", 3, ["id"], "s")
    counts = {r["person"]: r["count"] for r in kept.groupBy("person").count().collect()}
    assert counts["hot"] == 3 and set(counts.values()) == {1, 3} and None not in counts
    args = dict(epsilon=4.0, secret="s", row_id=["id"], low=0.0, high=10.0, most_rows=3, delta=1e-6)
    total = lambda d: {r["grp"]: (r["n_rows"], r["total"]) for r in private_totals(d, "grp", "person", "v", **args).collect()}
    with_hot, without = total(df), total(df.where("person <> 'hot'"))
    # Groups that one person makes are not shown; the noise is the same, so the
    # difference is what that person may change.
    assert set(with_hot) == set(without) == {"g0"}
    assert abs(with_hot["g0"][0] - without["g0"][0]) <= 3 and abs(with_hot["g0"][1] - without["g0"][1]) <= 30
    assert abs(without["g0"][0] - 3_000) < 60 and abs(without["g0"][1] - 6_000) < 600


def test_one_person_reaches_the_threshold_seldom(spark):
    epsilon, delta = 0.5, 0.05
    limit = show_threshold(epsilon, 1, delta)
    noise = spark.range(20_000).select((1 + masking.laplace(masking.keyed_unit(["id"], "x"), 1 / epsilon)).alias("n"))
    assert noise.where(F.col("n") >= limit).count() / 20_000 == pytest.approx(delta, rel=0.2)


def test_a_hot_person_is_cut_before_the_shuffle(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 3).alias("person"), F.col("id"))
    bounded_rows(df, "person", 2, ["id"], "s").explain()
    plan = capsys.readouterr().out
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


@pytest.mark.parametrize("wrong", [{"epsilon": 0}, {"most_rows": 0}, {"low": 2.0, "high": 1.0}, {"secret": ""}, {"delta": 0}])
def test_private_totals_refuse(spark, wrong):
    args = dict(epsilon=1.0, secret="s", row_id=["id"], low=0.0, high=1.0, most_rows=1, delta=1e-6) | wrong
    with pytest.raises(ValueError):
        private_totals(spark.createDataFrame([], ORDERS), "grp", "person", "v", **args)


def test_null_and_nan_values_are_rows(spark):
    rows = [(f"p{i}", "g", [None, float("nan"), 5.0, -5.0][i % 4], i) for i in range(4_000)]
    out = private_totals(spark.createDataFrame(rows, ORDERS), "grp", "person", "v", epsilon=8.0, secret="s", row_id=["id"], low=1.0, high=4.0)
    row = out.first()
    assert abs(row["n_rows"] - 4_000) < 20 and abs(row["total"] - (3 * 1_000 + 4 * 1_000)) < 80


def test_examples_are_the_smallest_values_without_a_shuffle_of_them(spark, capsys):
    rng = random.Random(1)
    rows = [(rng.choice(["ok", "bad", None, f"x{rng.randrange(400):03d}"]), rng.randrange(-500, 500)) for _ in range(3_000)]
    df = spark.createDataFrame(rows, "a string, b int")
    suite = [{"type": "in_set", "column": "a", "values": ["ok"]}, {"type": "between", "column": "b", "min": 0}, {"type": "not_null", "column": "a"}]
    for n in (1, 5, 40):
        got = {r["rule_id"]: r["examples"] for r in quality.validate(df, suite, examples=n).collect()}
        assert got[0] == sorted({a for a, _ in rows if a not in (None, "ok")})[:n]
        assert got[1] == sorted({str(b) for _, b in rows if b < 0})[:n]
        assert got[2] is None
    same = spark.range(100).select(F.lit("same").alias("a"))
    assert quality.validate(same, suite[:1], examples=3).first()["examples"] == ["same"]
