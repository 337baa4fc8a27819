"""As-of join, tables stored by order, day summaries, rescued CSV rows, pruned upserts."""

from __future__ import annotations

import random
from contextlib import redirect_stdout
from datetime import datetime, timedelta
from io import StringIO

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import audit, summaries
from lakestrata.operators.asof import asof_join
from lakestrata.plans import bucketed, pipelines
from lakestrata.plans.consolidate import consolidate
from lakestrata.plans.pipelines import Lake
from lakestrata.sinks import files
from lakestrata.sources import tables as sources
from lakestrata.sources.domain import domain_tables

SF = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)


@pytest.mark.parametrize("seconds,strict", [(86_400, False), (60, False), (3600, True), (10**9, True)])
def test_asof_equals_a_walk_over_all_readings(spark, seconds, strict):
    rng = random.Random(seconds)
    moment = lambda: START + timedelta(minutes=rng.randrange(20_000))
    rows = [(i, rng.choice(["a", "b", "lonely", None]), rng.choice([moment(), moment(), None])) for i in range(200)] + [(7, "a", START)] * 2
    readings = [(rng.choice(["a", "b", None]), moment(), rng.choice([1.5, 2.5, None])) for _ in range(60)]
    readings += [("a", START + timedelta(minutes=5), 9.0), ("a", START + timedelta(minutes=5), 8.0), ("c", None, 1.0)]

    def last(key, at):
        if key is None or at is None:
            return None, None
        met = [r for r in readings if r[0] == key and r[1] is not None and (r[1] < at if strict else r[1] <= at)]
        best = max(met, key=lambda r: (r[1], r[2] is not None, r[2] or 0), default=None)
        return (best[1], best[2]) if best else (None, None)

    left = spark.createDataFrame(rows, "id int, k string, sold timestamp_ntz")
    right = spark.createDataFrame(readings, "k string, read timestamp_ntz, v double")
    out = asof_join(left.repartition(4), right, ["k"], "sold", "read", ["v"], seconds, strict)
    assert out.columns == ["id", "k", "sold", "read", "v"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(((*r, *last(r[1], r[2])) for r in rows), key=repr)


def test_asof_refuses_clashing_names(spark):
    df = spark.createDataFrame([], "k string, t timestamp_ntz, v int")
    with pytest.raises(ValueError, match="v"):
        asof_join(df, df, ["k"], "t", "t2", ["v"])


def test_a_key_with_most_rows_is_split_by_its_buckets(spark, capsys):
    df = spark.createDataFrame([], "k string, t timestamp_ntz")
    readings = spark.createDataFrame([], "k string, r timestamp_ntz, v int")
    asof_join(df, readings, ["k"], "t", "r", ["v"]).explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(k" in plan and "_bucket" in plan and "CartesianProduct" not in plan


def test_stored_tables_join_without_an_exchange_on_the_order(spark, tmp_path, capsys):
    tables = domain_tables(spark, SF)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bucketed.store_by_order(spark, tables, str(tmp_path), "t_by_order", 4)
        wide = bucketed.consolidate_stored(bucketed.read_by_order(spark, "t_by_order"))
        wide.explain()
        plan = capsys.readouterr().out
        assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan
        plain = consolidate(tables, driving="orders")
        assert wide.columns == plain.columns
        assert wide.exceptAll(plain).count() == 0 == plain.exceptAll(wide).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        bucketed.forget(spark, "t_by_order")
    assert wide.count() == plain.count()  # the files stay


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    orders = spark.range(30).select(F.col("id").alias("order_id"))
    items = spark.range(95).select((F.col("id") % 30).alias("order_id"))
    tables = {"orders": orders, "payments": orders, "items": items, "reviews": orders.limit(0)}
    assert bucketed.buckets_for(tables) == 8
    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 10)
    assert bucketed.buckets_for(tables) == 10
    assert bucketed.buckets_for(tables | {"items": items.unionByName(items)}) == 19


def test_the_stored_consolidation_has_as_many_tasks_as_its_rows_need(spark, monkeypatch):
    from lakestrata.workload.registry import load_all

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 500)
    try:
        queries = load_all()
        wide, plain = (queries[f"consolidate_{name}"].run(spark, SF) for name in ("bucketed", "order_first"))
        lines = domain_tables(spark, SF, "items")["items"].count()
        assert wide.rdd.getNumPartitions() >= lines / 500 > 8
        assert wide.exceptAll(plain).count() == 0 == plain.exceptAll(wide).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def audited(spark):
    rng = random.Random(3)
    rows = [
        (START + timedelta(hours=rng.randrange(240)), f"u{rng.randrange(60)}", rng.choice(["error", "info", "warning"]), f"m{int(rng.expovariate(0.2))}")
        for _ in range(2_000)
    ]
    happened = spark.createDataFrame(rows, "timestamp timestamp_ntz, user string, level string, message string")
    return audit.audit_rows(happened, preset=True)


def test_day_summaries_merge_into_the_report(spark, audited, tmp_path):
    path = str(tmp_path / "days")
    for day in range(10):  # day by day, the last one twice
        own = audited.where(F.to_date("timestamp") == F.lit(f"2024-01-{day + 1:02d}").cast("date"))
        summaries.write_day_summaries(own, path)
    summaries.write_day_summaries(own, path)
    for start, end in (("2024-01-01", "2024-01-10"), ("2024-01-03", "2024-01-04"), ("2025-01-01", "2025-01-02")):
        days = summaries.read_days(spark, path, start, end)
        report = audit.audit_report(audited, f"{start} 00:00:00", f"{end} 23:59:59")
        assert summaries.merged_summary(days).first().asDict() == report["resumo"].first().asDict()
        assert {tuple(r) for r in summaries.merged_top(days, "acoes", 9).collect()} == {tuple(r) for r in report["distribuicao_acoes"].collect()}
        assert [tuple(r) for r in summaries.merged_top(days, "violacoes", 5).collect()] == [tuple(r) for r in report["principais_violacoes"].collect()]
    with pytest.raises(ValueError):
        summaries.merged_top(days, "users", 3)


def test_a_report_reads_day_rows_alone(spark, audited, tmp_path, capsys):
    path = str(tmp_path / "days")
    summaries.write_day_summaries(audited, path)
    assert spark.read.parquet(path).count() == 10
    summaries.merged_summary(summaries.read_days(spark, path, "2024-01-02", "2024-01-05")).explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1 and "days" in plan and "PartitionFilters: [isnotnull(event_date" in plan


def test_many_users_stay_within_the_stated_error(spark, tmp_path):
    rows = spark.range(120_000).select(
        F.lit(START).alias("timestamp"), F.concat(F.lit("u"), F.col("id") % 50_000).alias("user"), F.lit("info").alias("level"), F.lit("m").alias("message")
    )
    path = str(tmp_path / "days")
    summaries.write_day_summaries(audit.audit_rows(rows, preset=True), path)
    found = summaries.merged_summary(summaries.read_days(spark, path, "2024-01-01", "2024-01-01")).first()
    assert abs(found["usuarios_ativos"] / 50_000 - 1) < 3 * 1.04 / 2 ** (summaries.HLL_BITS / 2) and found["total_eventos"] == 120_000


def test_csv_names_of_another_case_and_doubled_ones(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("Customer_ID,b,B,other\n1,x,y,2\n")
    assert sources.read_csv(spark, str(path), "customer_id int, OTHER string, none date").collect() == [(1, "2", None)]
    assert sources.csv_header(spark, str(path)) == ["Customer_ID", "b", "B", "other"]
    with pytest.raises(ValueError, match="2 times"):
        sources.read_csv(spark, str(path), "b string")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert sources.read_csv(spark, str(path), "b string, customer_id int").collect()[0][1] is None
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    loaded = sources.load_tables(spark, str(tmp_path), {"c": "c.csv"}, {"c": None}, {"c": ["CUSTOMER_id"]})
    assert loaded["c"].count() == 1


def test_rescued_rows(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('id,price,day\n1,10.5,2024-01-01\n2,x1,2024-13-01\n3,NA,\n4,"1,5",2024-01-02\n5,6\n7,8,2024-01-03,9\n')
    schema = "id int, price double, day date, gone int"
    with pytest.raises(Exception):
        sources.read_csv(spark, str(path), schema).collect()
    rows = sources.read_csv(spark, str(path), schema, rescue="lost")
    good, rescued = sources.split_rescued(rows, "lost")
    assert {r["id"] for r in good.collect()} == {1, 3} and good.columns == ["id", "price", "day", "gone"]
    lost = {r["id"]: [tuple(x) for x in r["lost"]] for r in rescued.collect()}
    assert lost[2] == [("price", "x1", "no double"), ("day", "2024-13-01", "no date")]
    assert lost[4] == [("price", "1,5", "no double")]
    assert [x[::2] for x in lost[5]] == [(None, "wrong number of fields")] == [x[::2] for x in lost[7]]
    assert good.count() + rescued.count() == 6
    with pytest.raises(ValueError, match="already"):
        sources.read_csv(spark, str(path), schema, rescue="price")
    table = sources.load_tables(spark, str(tmp_path), {"r": "r.csv"}, {"r": schema}, rescue="lost")["r"]
    assert table.where("lost is not null").count() == 4


def test_upsert_scans_only_the_partitions_it_touches(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(40).select("id", (F.col("id") % 8).cast("int").alias("day"), F.lit("old").alias("v")).write.partitionBy("day").parquet(path)
    batch = spark.createDataFrame([(1, 1, "new"), (50, 3, "new"), (60, None, "new")], "id long, day int, v string")
    plans = []
    plain = files.upsert
    monkeypatch.setattr(files, "upsert", lambda target, *rest: (plans.append(target), plain(target, *rest))[1])
    for most in (files.NAMED_PARTITIONS, 1):
        monkeypatch.setattr(files, "NAMED_PARTITIONS", most)
        files.upsert_partitions(spark, path, batch, ["id"], ["v"], ["day"])
        rows = {r["id"]: (r["day"], r["v"]) for r in spark.read.parquet(path).collect()}
        assert len(rows) == 42 and rows[1] == (1, "new") and rows[50] == (3, "new") and rows[60] == (None, "new") and rows[9] == (1, "old")
    out = StringIO()
    with redirect_stdout(out):
        plans[0].explain()
    assert "day" in out.getvalue().split("PartitionFilters: [")[1].split("]")[0]


def test_a_rebuild_that_fails_leaves_the_old_table(spark, tmp_path):
    old = spark.createDataFrame([(1, "x"), (2, "y")], "v int, mes string")
    path = files.write_layer(old, str(tmp_path), "silver", "t", ["mes"], replace="table")
    broken = spark.range(10).select(
        F.when(F.col("id") == 9, F.raise_error(F.lit("half-way"))).otherwise(F.col("id").cast("int")).alias("v"), F.lit("z").alias("mes")
    )
    with pytest.raises(Exception, match="half-way"):
        files.write_layer(broken, str(tmp_path), "silver", "t", ["mes"], replace="table")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "x"), (2, "y")]


def test_a_rebuild_of_the_same_months_is_written_once(spark, tmp_path, monkeypatch):
    staged = []
    monkeypatch.setattr(files, "work_path", lambda spark, name: staged.append(name) or str(tmp_path / f"{name}{len(staged)}"))
    schema = "v int, mes string"
    write = lambda df, *months: files.write_layer(
        df, str(tmp_path), "silver", "t", ["mes"], replace="table", values=spark.createDataFrame([(m,) for m in months], "mes string")
    )
    path = write(spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], schema), "x", "y", None)
    write(spark.createDataFrame([(4, "x"), (5, "y"), (6, None), (7, "z")], schema), "x", "y", None, "z")
    rows = lambda: sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert rows() == [(4, "x"), (5, "y"), (6, None), (7, "z")] and not staged
    broken = spark.range(10).select(
        F.when(F.col("id") == 9, F.raise_error(F.lit("half-way"))).otherwise(F.col("id").cast("int")).alias("v"),
        F.element_at(F.array(*[F.lit(m) for m in ("x", "y", None, "z")]), (F.col("id") % 4 + 1).cast("int")).alias("mes"),
    )
    with pytest.raises(Exception, match="half-way"):
        write(broken, "x", "y", None, "z")
    assert rows() == [(4, "x"), (5, "y"), (6, None), (7, "z")] and not staged
    # A month that is gone, the NULL one too, is removed by the staged rebuild.
    write(spark.createDataFrame([(8, "x"), (9, "y")], schema), "x", "y")
    assert rows() == [(8, "x"), (9, "y")] and staged == ["rebuild"]


def test_batch_counts_losses_at_the_item_grain(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    tables = domain_tables(spark, SF)
    pipelines.consolidate_and_mask(spark, tables, lake, "key", "2024-02-01 00:00:00", mode="preaggregate")
    lost = pipelines.fact_losses(sources.read_layer(spark, lake.root, "silver", "vendas")).first()
    items = tables["items"]
    assert lost["merged"] == items.count() - items.select("order_id", "product_id", "order_item_id").distinct().count()
    # One file of audit rows for the whole stage.
    assert len(spark.read.parquet(lake.audit).inputFiles()) == 1
