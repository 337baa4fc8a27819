from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakestrata.functions import crypto, masking
from lakestrata.functions.masking import MaskRule, laplace_noise, mask_columns
from lakestrata.operators.aggregates import masking_stats

KEY = "k3y"
RELAXED = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
TEXT = st.text(st.characters(exclude_categories=["Cs", "Cc"]), max_size=12)


def one(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_hash_matches_hashlib(spark):
    values = ["São Paulo", "", "x", None, "😀"]
    want = [None if v is None else hashlib.sha256((v + KEY).encode()).hexdigest() for v in values]
    assert one(spark, values, lambda c: masking.mask_hash(c, KEY)) == want
    assert one(spark, [12], lambda c: masking.mask_hash(c, KEY), "int") == [hashlib.sha256(b"12" + KEY.encode()).hexdigest()]


def test_key_is_required(spark):
    for build in (lambda: masking.mask_hash(F.lit("x"), ""), lambda: masking.mask_pseudonym(F.lit("x"), "cpf", "")):
        with pytest.raises(ValueError):
            build()
    with pytest.raises(ValueError):
        mask_columns(spark.range(1), {}, key="")


def test_static_keeps_null(spark):
    assert one(spark, ["a", "", None], masking.mask_static) == ["[DADO_MASCARADO]", "[DADO_MASCARADO]", None]


def partial(value, start, end, ch="*"):
    if value is None:
        return None
    n = len(value)
    return ch * n if start + end >= n else value[:start] + ch * (n - start - end) + value[n - end:]


@pytest.mark.parametrize("start,end", [(0, 0), (2, 2), (3, 0), (0, 3), (1, 4)])
def test_partial(spark, start, end):
    values = [None, "", "a", "abcd", "abcde", "abcdef", "ação😀é"]
    got = one(spark, values, lambda c: masking.mask_partial(c, start, end, "#"))
    assert got == [partial(v, start, end, "#") for v in values]


@RELAXED
@given(values=st.lists(TEXT, min_size=1, max_size=20), start=st.integers(0, 4), end=st.integers(0, 4))
def test_partial_keeps_length(spark, values, start, end):
    got = one(spark, values, lambda c: masking.mask_partial(c, start, end))
    assert got == [partial(v, start, end) for v in values]


def test_partial_rejects_bad_lengths():
    for bad in ((-1, 0), (0, -1), (1.5, 0), (True, 0)):
        with pytest.raises(ValueError):
            masking.mask_partial(F.lit("x"), *bad)


SHAPES = {
    "nome": r"[A-Z][a-z]+ [A-Z][a-z]+",
    "email": r"[a-z]+\.[a-z]+\d{6}@example\.com\.br",
    "endereco": r".+, \d+ - \d{8}",
    "telefone": r"\+55 \d\d 9\d{4}-\d{4}",
    "cpf": r"\d{3}\.\d{3}\.\d{3}-\d\d",
    "anything": r"[a-z]+",
}


@pytest.mark.parametrize("column,shape", SHAPES.items())
def test_pseudonym_shape_and_determinism(spark, column, shape):
    values = [f"person {i}" for i in range(200)] + [None, "person 1"]
    got = one(spark, values, lambda c: masking.mask_pseudonym(c, column, KEY))
    assert got[200] is None and got[1] == got[201]
    assert all(re.fullmatch(shape, v) for v in got if v is not None)
    assert got != one(spark, values, lambda c: masking.mask_pseudonym(c, column, "other"))


def cpf_digit(digits):
    weights = range(len(digits) + 1, 1, -1)
    return sum(d * w for d, w in zip(digits, weights)) * 10 % 11 % 10


def test_cpf_check_digits(spark):
    for text in one(spark, [str(i) for i in range(300)], lambda c: masking.mask_pseudonym(c, "cpf", KEY)):
        digits = [int(d) for d in text if d.isdigit()]
        assert len(digits) == 11
        assert digits[9] == cpf_digit(digits[:9]) and digits[10] == cpf_digit(digits[:10])


def test_policy_unknown_method_and_absent_column(spark):
    df = spark.createDataFrame([("sp", "SP", 1)], "customer_city string, customer_state string, n int")
    masked = mask_columns(df, key=KEY).first()
    assert masked["customer_city"] == "[CIDADE_REMOVIDA_LGPD]" and len(masked["customer_state"]) == 64
    assert mask_columns(df, {"absent": MaskRule("hash")}, key=KEY, lenient=True).columns == df.columns
    with pytest.raises(ValueError, match="absent"):
        mask_columns(df, {"absent": MaskRule("hash")}, key=KEY)
    with pytest.raises(ValueError, match="rot13"):
        mask_columns(df, {"n": MaskRule("rot13")}, key=KEY)


def test_registered_mask(spark):
    masking.register_mask("upper", lambda col, name, key: F.upper(col))
    df = spark.createDataFrame([("a",)], "v string")
    assert mask_columns(df, {"v": MaskRule("upper")}, key=KEY).first()["v"] == "A"


def test_masking_stats_counts_honestly(spark):
    df = spark.createDataFrame([("a", None), ("b", None), ("a", None)], "v string, w string")
    after = mask_columns(df, {"v": MaskRule("static"), "w": MaskRule("static")}, key=KEY)
    stats = {r["column"]: (r["original_unique"], r["masked_unique"]) for r in masking_stats(df, after, ["v", "w"]).collect()}
    assert stats == {"v": (2, 1), "w": (0, 0)}


def test_noise(spark):
    df = spark.range(40_000).select("id", F.lit(10.0).alias("x"))
    for options in ({"seed": 3}, {"noise_key": ("id", "s")}):
        got = laplace_noise(df, "x", 0.5, 1.0, **options).agg(F.avg("x"), F.var_samp("x")).first()
        assert abs(got[0] - 10) < 0.1 and abs(got[1] - 8) < 0.8  # variance 2 * scale ** 2
    assert laplace_noise(df, "x", 1.0, 0).where("x <> 10").count() == 0
    nulls = spark.createDataFrame([(1, None)], "id int, x double")
    assert laplace_noise(nulls, "x", 1.0, 1.0).first()["x"] is None
    for bad in (("x", 0, 1), ("x", -1, 1), ("x", 1, -1), ("none", 1, 1), ("x", "1", 1), ("x", float("nan"), 1)):
        with pytest.raises(ValueError):
            laplace_noise(df, *bad)
    with pytest.raises(ValueError):
        laplace_noise(df.select(F.col("id").cast("string").alias("x")), "x", 1, 1)


@pytest.fixture(scope="module")
def keys(spark):
    empty = spark.createDataFrame([], "version string, key_value binary, created_at timestamp_ntz, expires_at timestamp_ntz")
    first = crypto.rotate_key(empty, "v1", b"0" * 32, "2024-01-01 00:00:00")
    return crypto.rotate_key(first, "v2", b"1" * 32, "2024-03-01 00:00:00")


def test_encrypt_decrypt_rekey(spark, keys):
    df = spark.createDataFrame([(1, "ação"), (2, None), (3, "")], "id int, v string")
    secret = crypto.encrypt_column(df, "v", keys, "v1")
    assert secret.where("v is not null").first()["v"] not in (b"", "ação".encode())
    plain = crypto.decrypt_column(secret, "v", keys)
    assert [tuple(r) for r in plain.orderBy("id").collect()] == [(1, "ação", "v1"), (2, None, "v1"), (3, "", "v1")]
    moved = crypto.rekey(secret, "v", keys, "v2", "v1")
    assert [tuple(r) for r in crypto.decrypt_column(moved, "v", keys).orderBy("id").collect()] == [
        (1, "ação", "v2"), (2, None, "v2"), (3, "", "v2"),
    ]
    untouched = crypto.rekey(secret, "v", keys, "v2", "v0")
    assert untouched.select("key_version").distinct().collect()[0][0] == "v1"


def test_unknown_versions(spark, keys):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(Exception, match="no key"):
        crypto.encrypt_column(df, "v", keys, "v9").collect()
    lost = crypto.encrypt_column(df, "v", keys, "v1").withColumn("key_version", F.lit("v9"))
    assert crypto.decrypt_column(lost, "v", keys).first()["v"] is None
    with pytest.raises(Exception, match="no key"):
        crypto.decrypt_column(lost, "v", keys, on_missing="error").collect()
    wrong = crypto.encrypt_column(df, "v", keys, "v1").withColumn("key_version", F.lit("v2"))
    assert crypto.decrypt_column(wrong, "v", keys).first()["v"] is None


def test_masking_key_stays_out_of_plans(spark, capsys):
    df = spark.createDataFrame([("a", "b")], "customer_city string, customer_state string")
    masked = mask_columns(df, key="very-private")
    masked.explain(True)
    masked.withColumn("nome", masking.mask_pseudonym(F.col("customer_city"), "nome", "very-private")).explain("formatted")
    assert "very-private" not in capsys.readouterr().out


def test_key_bytes_stay_out_of_plans(spark, keys, capsys):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    crypto.encrypt_column(df, "v", keys, "v1").explain(True)
    assert "0" * 16 not in capsys.readouterr().out


def test_key_lifetime_and_retention(keys):
    v1 = keys.where("version = 'v1'").first()
    assert str(v1["expires_at"]) == "2024-03-31 00:00:00"
    gone = crypto.expired_keys(keys, 30, "2024-03-15 00:00:00", active="v2").collect()
    assert [r["version"] for r in gone] == ["v1"]
    assert crypto.expired_keys(keys, 30, "2024-01-31 00:00:00", active="v2").count() == 0  # exactly 30 days


def test_noise_differs_between_rows_of_an_order(spark):
    df = spark.createDataFrame([("o", k, v) for k, v in enumerate((1.0, 5.0, 9.0))], "id string, line int, v double")
    out = masking.laplace_noise(df, "v", 0.5, 1.0, noise_key=(["id", "line"], "s"))
    shifts = [r["v"] - (1, 5, 9)[r["line"]] for r in out.collect()]
    assert len({round(x, 9) for x in shifts}) == 3
    again = masking.laplace_noise(df.repartition(3), "v", 0.5, 1.0, noise_key=(["id", "line"], "s"))
    assert {r["line"]: r["v"] for r in out.collect()} == {r["line"]: r["v"] for r in again.collect()}


def test_repeated_key_version_does_not_multiply_rows(spark, keys):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    secret = crypto.encrypt_column(df, "v", keys, "v1")
    assert [r["v"] for r in crypto.decrypt_column(secret, "v", keys.unionByName(keys)).collect()] == ["a"]
    clash = crypto.rotate_key(keys, "v1", b"2" * 32, "2024-04-01 00:00:00")
    with pytest.raises(Exception, match="several keys"):
        crypto.decrypt_column(secret, "v", clash).collect()
