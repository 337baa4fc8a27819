from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakestrata import schemas
from lakestrata.operators.load import insert_if_absent, new_rows, upsert
from lakestrata.plans import gold, star
from lakestrata.sinks import files
from lakestrata.sinks.jdbc import jdbc_full_refresh
from lakestrata.sinks.star import current_version, load_star, read_star
from lakestrata.sources import tables as sources

WIDE = (
    "order_id string, customer_id string, product_id string, price double, order_purchase_timestamp string, "
    "order_item_id int, customer_unique_id string, customer_city string, customer_state string, "
    "product_category_name string, product_weight_g int"
)


@pytest.fixture(scope="module")
def wide(spark):
    def row(order, customer, product, price, ts="2024-01-05 10:00:00", item=1):
        return (order, customer, product, price, ts, item, "u", "city", "ST", "toys", 5)

    return spark.createDataFrame([
        row("o1", "c1", "p1", 10.0), row("o1", "c1", "p1", 10.0), row("o1", "c1", "p2", 20.0, item=2),
        row(None, "c1", "p1", 1.0), row("o2", None, "p1", 1.0), row("o2", "c2", None, 1.0),
        row("o2", "c2", "p1", None), row("o2", "c2", "p1", 1.0, ts=None), row("o3", "c3", "p1", 3.0, item=None),
    ], WIDE)


def test_fact_drops_incomplete_rows_and_dedupes(wide):
    fact = star.build_fato_vendas(wide)
    assert sorted((r["order_id"], r["produto_id"], r["quantidade"]) for r in fact.collect()) == [
        ("o1", "p1", 1), ("o1", "p2", 1), ("o3", "p1", 1),
    ]
    assert fact.columns == ["order_id", "cliente_id", "produto_id", "data_venda", "valor_total", "quantidade"]


def test_fact_quantity_and_losses(wide):
    fact = star.build_fato_vendas(wide, quantity=star.LEGACY_QUANTITY)
    assert sorted(r["quantidade"] for r in fact.collect()) == [1, 1, 2]
    assert tuple(star.fact_losses(wide).first()) == (9, 5, 1, 3)


def test_legacy_grain_keeps_one_row_per_order(wide):
    assert star.build_fato_vendas(wide, star.LEGACY_GRAIN).count() == 2


def test_dimensions(wide):
    tables = star.build_star(wide)
    assert sorted(r["cliente_id"] for r in tables["dim_cliente"].collect()) == ["c1", "c2", "c3"]
    client = tables["dim_cliente"].first()
    assert (client["segmento"], client["nome"]) == ("N/A", "u")
    assert tables["dim_produto"].count() == 2


def test_gold_levels(wide):
    tables = star.build_star(wide)
    out = gold.gold_sales(tables["fato_vendas"], tables["dim_cliente"], tables["dim_produto"])
    total = out.where("nivel = 7").first()
    assert (float(total["valor_total"]), total["linhas"]) == (33.0, 3)
    with pytest.raises(ValueError):
        gold.gold_sales(*[tables[t] for t in ("fato_vendas", "dim_cliente", "dim_produto")], how="grid")


def test_correlation_lag(spark):
    months = [("2024-01-01", 1.0), ("2024-02-01", 2.0), ("2024-03-01", 4.0)]
    sales = spark.createDataFrame(months, "mes string, valor_total double").withColumn("mes", F.to_date("mes"))
    feed = spark.createDataFrame(
        [("15/12/2023", "1"), ("01/01/2024", "2"), ("31/01/2024", "2"), ("10/02/2024", "4"), ("xx", "9"), ("01/02/2024", "bad")],
        schemas.INDICATOR,
    )
    monthly = gold.indicator_by_month(feed)
    assert monthly.count() == 3
    lagged = gold.indicator_correlation(sales, monthly, lag_months=1).first()
    assert (lagged["months"], lagged["correlation"]) == (3, 1.0)
    assert gold.indicator_correlation(sales, monthly).first()["months"] == 2


def test_publish_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "star")
    assert current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        read_star(spark, root)
    one = {"dim_a": spark.range(2), "fato_b": spark.range(3)}
    load_star(spark, one, root, "v20240101000000")

    broken = {"dim_a": spark.range(5), "fato_b": spark.range(3).select(F.raise_error(F.lit("lost")).cast("int").alias("id"))}
    with pytest.raises(Exception, match="lost"):
        load_star(spark, broken, root, "v20240102000000")
    assert current_version(spark, root) == "v20240101000000"
    assert read_star(spark, root)["dim_a"].count() == 2

    # The failed version may be loaded again; an old one may not.
    load_star(spark, {"dim_a": spark.range(5), "fato_b": spark.range(1)}, root, "v20240102000000")
    assert {n: t.count() for n, t in read_star(spark, root).items()} == {"dim_a": 5, "fato_b": 1}
    with pytest.raises(ValueError):
        load_star(spark, one, root, "v20240101000000")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_insert_and_upsert(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    batch = spark.createDataFrame([(2, "new", 2), (2, "newer", 1), (3, "b", 2), (3, "a", 1)], "k int, v string, o int")
    assert rows(insert_if_absent(target, batch, ["k"], ["o"])) == [(1, "old"), (2, "old"), (3, "a")]
    assert rows(upsert(target, batch, ["k"], ["o"])) == [(1, "old"), (2, "newer"), (3, "a")]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=st.sets(st.integers(0, 20)), batch=st.lists(st.integers(0, 20), min_size=1, max_size=20))
def test_insert_if_absent_is_idempotent(spark, old, batch):
    target = spark.createDataFrame([(k, "t") for k in old], "k int, v string")
    new = spark.createDataFrame([(k, "b") for k in batch], "k int, v string")
    once = insert_if_absent(target, new, ["k"], ["v"])
    assert rows(insert_if_absent(once, new, ["k"], ["v"])) == rows(once)
    assert new_rows(once, new, ["k"], ["v"]).isEmpty()
    assert {r["k"] for r in once.collect()} == old | set(batch)


def test_a_known_batch_moves_no_rows(spark, tmp_path, capsys):
    old = spark.range(50).selectExpr("id AS k", "'old' AS v").union(spark.createDataFrame([(7, "copy")], "k bigint, v string"))
    spark.range(40).selectExpr("id AS k", "'new' AS v").write.parquet(str(tmp_path / "b"))
    batch = spark.read.parquet(str(tmp_path / "b"))
    old.write.parquet(str(tmp_path / "t"))
    added = new_rows(spark.read.parquet(str(tmp_path / "t")), batch, ["k"], ["v"])
    assert added.isEmpty()
    capsys.readouterr()
    added.explain("formatted")
    plan = capsys.readouterr().out
    # Keys were compared when the plan was made: the target's rows are only
    # read for those without a key, and keys meet the batch by a broadcast.
    assert "LeftSemi BuildRight" in plan and "fresh" in plan
    more = batch.union(spark.createDataFrame([(90, "b"), (90, "a"), (None, "n"), (None, "n")], "k bigint, v string"))
    assert rows(new_rows(old, more, ["k"], ["v"])) == [(90, "a"), (None, "n")]


def test_append_and_upsert_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    for _ in range(2):
        files.append_new(spark, path, batch, ["k"], ["v"])
    assert rows(spark.read.parquet(path)) == [(1, "a")]

    path = str(tmp_path / "p")
    spark.createDataFrame([(1, "a", 10), (2, "b", 10), (3, "c", 20)], "k int, v string, day int").write.partitionBy("day").parquet(path)
    untouched = {f: f.stat().st_mtime_ns for f in (tmp_path / "p" / "day=20").iterdir()}
    change = spark.createDataFrame([(2, "B", 10), (4, "d", 30)], "k int, v string, day int")
    for _ in range(2):
        files.upsert_partitions(spark, path, change, ["k"], ["v"], ["day"])
    assert rows(spark.read.parquet(path)) == [(1, "a", 10), (2, "B", 10), (3, "c", 20), (4, "d", 30)]
    assert untouched == {f: f.stat().st_mtime_ns for f in (tmp_path / "p" / "day=20").iterdir()}


def test_layer_of_csv_files(spark, tmp_path):
    root = str(tmp_path)
    files.write_csv(spark.createDataFrame([("o1", 5), ("NA", 1)], schemas.REVIEWS), f"{root}/bronze/reviews")
    back = sources.read_layer(spark, root, "bronze", "reviews", fmt="csv", schema=schemas.REVIEWS)
    assert rows(back) == [("o1", 5), (None, 1)] and back.schema == schemas.REVIEWS


def test_csv_round_trip_and_na(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.createDataFrame([("a,b", 1, "ação"), ('q"q', None, "N/A"), ("back\\slash", 3, "x")], "s string, n int, t string")
    files.write_csv(df, path)
    back = sources.read_csv(spark, path, df.schema)
    assert rows(back) == [("a,b", 1, "ação"), ("back\\slash", 3, "x"), ('q"q', None, None)]
    assert sources.read_csv(spark, path, "s string, n int, t string", normalise=False).where("t = 'N/A'").count() == 1
    assert dict(sources.read_csv(spark, path).dtypes)["n"] == "string"
    assert dict(sources.explore_csv(spark, path).dtypes)["n"] == "int"


def test_load_tables_fails_early(spark, tmp_path):
    base = str(tmp_path)
    files.write_csv(spark.createDataFrame([("o1", 5)], schemas.REVIEWS), f"{base}/reviews.csv")
    spark.range(3).write.parquet(f"{base}/ids.parquet")
    spark.range(0).write.parquet(f"{base}/none.parquet")
    loaded = sources.load_tables(spark, base, {"reviews": "reviews.csv", "ids": "ids.parquet"}, required={"ids": ["id"]})
    assert loaded["reviews"].schema == schemas.REVIEWS and loaded["ids"].count() == 3
    for mapping, required in (
        ({"x": "gone.csv"}, {}), ({"x": "none.parquet"}, {}), ({"ids": "ids.parquet"}, {"ids": ["other"]}),
    ):
        with pytest.raises(sources.MissingTableError):
            sources.load_tables(spark, base, mapping, required=required)


def test_bronze_skips_missing_and_goes_on(spark, tmp_path):
    bad = spark.range(2).select(F.raise_error(F.lit("broken")).cast("int").alias("id"))
    status = files.land_bronze(
        {"a": spark.range(4), "gone": f"{tmp_path}/gone", "none": None, "bad": bad, "b": spark.range(1)},
        str(tmp_path), spark,
    )
    assert rows(status) == [
        ("a", "LANDED", 4), ("b", "LANDED", 1), ("bad", "FAILED", None), ("gone", "SKIPPED", None), ("none", "SKIPPED", None),
    ]


def test_promote_and_partition_overwrite(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(sources.MissingTableError):
        files.promote(spark, f"{root}/gone", root, "silver", "t")
    rows_ = spark.range(10).select("id", (F.col("id") % 2).alias("part"))
    files.write_gold(rows_, root, "t", ["part"])
    files.write_gold(rows_.where("part = 1 and id > 5"), root, "t", ["part"])
    back = sources.read_layer(spark, root, "gold", "t")
    assert back.where("part = 0").count() == 5 and back.where("part = 1").count() == 2
    with pytest.raises(ValueError):
        sources.layer_path(root, "platinum", "t")


def test_avro_is_gated(spark, tmp_path):
    if sources.avro_available(spark):
        df = spark.createDataFrame([("2024-01-01", "0.42")], schemas.INDICATOR)
        fields = ", ".join('{"name": "%s", "type": "string"}' % n for n in ("data", "valor"))
        files.write_avro(df, str(tmp_path / "a"), '{"type": "record", "name": "ipca", "fields": [%s]}' % fields)
        assert rows(sources.read_avro(spark, str(tmp_path / "a"))) == rows(df)
        return
    with pytest.raises(RuntimeError, match="Avro"):
        sources.read_avro(spark, str(tmp_path))
    with pytest.raises(RuntimeError, match="Avro"):
        files.write_avro(spark.range(1), str(tmp_path), "{}")


class FakeWriter:
    """Records what the refresh asks of Spark's JDBC writer."""

    def __init__(self):
        self.calls = {}

    def mode(self, value):
        self.calls["mode"] = value
        return self

    def option(self, name, value):
        self.calls[name] = value
        return self

    def jdbc(self, url, table, properties):
        self.calls |= {"url": url, "table": table, "properties": properties}


class FakeFrame:
    def __init__(self):
        self.write = FakeWriter()


def test_jdbc_refresh_options():
    frame, swapped = FakeFrame(), []
    jdbc_full_refresh(frame, "jdbc:x", "vendas", {"user": "u"}, publish=lambda a, b: swapped.append((a, b)))
    calls = frame.write.calls
    assert (calls["table"], calls["mode"], calls["truncate"], calls["batchsize"]) == ("vendas__staging", "overwrite", True, 10_000)
    assert swapped == [("vendas__staging", "vendas")]
    direct = FakeFrame()
    jdbc_full_refresh(direct, "jdbc:x", "vendas")
    assert direct.write.calls["table"] == "vendas"


def test_rows_without_a_key_load_once(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([(None, "a"), (None, "b"), (None, "b"), (2, "c")], "k int, v string")
    for _ in range(3):
        files.append_new(spark, path, batch, ["k"], ["v"])
    assert rows(spark.read.parquet(path)) == [(2, "c"), (None, "a"), (None, "b")]
    target = spark.createDataFrame([(None, "a"), (2, "old")], "k int, v string")
    once = upsert(target, batch, ["k"], ["v"])
    assert rows(once) == rows(upsert(once, batch, ["k"], ["v"])) == [(2, "c"), (None, "a"), (None, "b")]
    twice = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    assert rows(new_rows(twice, batch, ["k"], ["v"])) == [(None, "a"), (None, "b")]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    old=st.lists(st.tuples(st.none() | st.integers(0, 3), st.sampled_from("ab")), max_size=6),
    new=st.lists(st.tuples(st.none() | st.integers(0, 3), st.sampled_from("ab")), min_size=1, max_size=8),
)
def test_null_and_repeated_keys_are_idempotent(spark, old, new):
    target = spark.createDataFrame(old, "k int, v string")
    batch = spark.createDataFrame(new, "k int, v string")
    for load in (insert_if_absent, upsert):
        once = load(target, batch, ["k"], ["v"])
        assert rows(load(once, batch, ["k"], ["v"])) == rows(once)
        assert {r for r in new if r[0] is None} <= {tuple(r) for r in once.collect()}


def test_unreadable_table_is_not_an_empty_one(spark, tmp_path):
    path = tmp_path / "t"
    path.mkdir()
    (path / "part-0.parquet").write_bytes(b"no parquet")
    batch = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(Exception):
        files.append_new(spark, str(path), batch, ["k"], ["v"])
    assert [f.name for f in path.iterdir()] == ["part-0.parquet"]


def test_full_replace_removes_old_partitions(spark, tmp_path):
    two = spark.createDataFrame([(1, "x"), (2, "y")], "v int, mes string")
    files.write_layer(two, str(tmp_path), "silver", "t", ["mes"])
    path = files.write_layer(two.where("v = 1"), str(tmp_path), "silver", "t", ["mes"], replace="table")
    assert rows(spark.read.parquet(path)) == [(1, "x")]


def test_csv_is_read_by_column_name(spark, tmp_path):
    wider = tmp_path / "customers.csv"
    wider.write_text("customer_state,extra,customer_id,customer_city\nSP,1,c1,sao paulo\nRJ,2,c2,NA\n")
    schema = "customer_id string, customer_city string, customer_state string, customer_unique_id string"
    out = sources.read_csv(spark, str(wider), schema)
    assert rows(out) == [("c1", "sao paulo", "SP", None), ("c2", None, "RJ", None)]
    with pytest.raises(sources.MissingTableError, match="customer_unique_id"):
        sources.load_tables(
            spark, str(tmp_path), {"customers": "customers.csv"}, required={"customers": ["customer_unique_id"]}
        )
    assert sources.csv_header(spark, str(wider)) == ["customer_state", "extra", "customer_id", "customer_city"]


def test_star_is_not_published_if_the_check_fails(spark, tmp_path):
    def refuse(written):
        assert written["fato_b"].count() == 3
        raise ValueError("orphans")

    with pytest.raises(ValueError, match="orphans"):
        load_star(spark, {"dim_a": spark.range(2), "fato_b": spark.range(3)}, str(tmp_path), "v1", refuse)
    assert current_version(spark, str(tmp_path)) is None
