from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakestrata.plans import pipelines
from lakestrata.plans.pipelines import Lake
from lakestrata.operators.quality import QualityGateError
from lakestrata.sinks.star import current_version, read_star
from lakestrata.sources.logs import read_audit
from lakestrata.streaming import alerts, batches, sales

AS_OF = "2024-02-01 00:00:00"
EVENT = "timestamp string, customer_state string, price string, order_id string, event_sequence_id bigint"
PRICES = ["100", "100.01", "abc", "", None, "NaN", "Infinity", " 150 ", "1_000", "-3"]


@pytest.fixture(scope="module")
def events(spark):
    states = ["SP", None, " ", " RJ "]
    return spark.createDataFrame([
        (f"2024-01-{i + 1:02d} 10:00:00", states[i % 4], p, f"o{i}", i) for i, p in enumerate(PRICES)
    ], EVENT)


def test_transform(events):
    out = sales.transform_sales(events, AS_OF)
    assert out.columns == ["customer_state", "price", "timestamp", "processed_at"]
    got = {r["price"]: r["customer_state"] for r in out.collect()}
    assert got == {100.01: "UNKNOWN", float("inf"): "UNKNOWN", 150.0: "RJ"}
    assert sales.transform_sales(events.withColumn("timestamp", F.lit(None).cast("string")), AS_OF).first()["timestamp"] == AS_OF


def test_every_event_is_counted_once(events):
    n = events.agg(*sales.stream_counts(events)).first()
    assert (n["consumed"], n["processed"], n["skipped"], n["invalid"]) == (10, 3, 4, 3)
    good, bad = sales.split_invalid(events)
    assert {r["price"] for r in bad.collect()} == {"abc", "", "1_000"} and good.count() == 7


def test_required_columns():
    with pytest.raises(ValueError, match="price"):
        sales.check_columns(["customer_state", "order_id", "timestamp"])


def test_stream_equals_batch_and_replays_nothing(spark, events, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events.write.parquet(source)

    def drain():
        stream = sales.read_event_stream(spark, source, max_files=1)
        query = sales.process_sales_stream(stream, out, f"{out}-checkpoint", AS_OF)
        query.awaitTermination()
        return query

    drain()
    names = ("consumed", "processed", "skipped", "invalid")
    assert batches.totals(spark, out, names) == {"consumed": 10, "processed": 3, "skipped": 4, "invalid": 3}
    key = ["customer_state", "price", "timestamp", "processed_at"]
    batch = sales.transform_sales(events, AS_OF)
    written = sales.read_processed(spark, out)
    assert sorted(written.select(key).collect()) == sorted(batch.select(key).collect())
    assert {str(r["event_date"]) for r in written.select("event_date").collect()} == {"2024-01-02", "2024-01-07", "2024-01-08"}
    assert sorted(sales.read_invalid(spark, out).collect()) == sorted(sales.split_invalid(events)[1].collect())
    drain()  # nothing new: the checkpoint remembers
    assert sales.read_processed(spark, out).count() == 3
    last = batches.last_batch(spark, out)
    events.limit(2).write.mode("append").parquet(source)
    drain()
    assert sales.read_processed(spark, out).count() == 4
    assert batches.totals(spark, out, names, after=last) == {"consumed": 2, "processed": 1, "skipped": 1, "invalid": 0}


@pytest.mark.parametrize("killed_after", ["rows", "counters"])
def test_a_killed_batch_is_repeated_whole(spark, events, tmp_path, monkeypatch, killed_after):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events.repartition(3).write.parquet(source)
    plain, calls = batches.write_batch, []

    def dies_once(batch, root, batch_id, counters, shape, partition_by):
        calls.append(batch_id)
        if len(calls) == 2 and killed_after == "rows":
            shape(batch).write.partitionBy(*partition_by).parquet(f"{root}/rows/batch_id={batch_id}")
            raise RuntimeError("killed")
        plain(batch, root, batch_id, counters, shape, partition_by)
        if len(calls) == 2:
            raise RuntimeError("killed")

    monkeypatch.setattr(batches, "write_batch", dies_once)
    run = lambda: sales.process_sales_stream(
        sales.read_event_stream(spark, source, max_files=1), out, f"{out}-checkpoint", AS_OF
    ).awaitTermination()
    with pytest.raises(Exception):
        run()
    published = batches.read_counters(spark, out).count()
    assert published == (1 if killed_after == "rows" else 2)
    run()
    assert len(calls) > len(set(calls))
    assert sales.read_processed(spark, out).count() == 3 and sales.read_invalid(spark, out).count() == 3
    assert batches.totals(spark, out, ("consumed",)) == {"consumed": 10}


def test_counters_outlive_the_progress(spark, events, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    name = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    try:
        events.repartition(5).write.parquet(source)
        query = sales.process_sales_stream(sales.read_event_stream(spark, source, max_files=1), out, f"{out}-c", AS_OF)
        query.awaitTermination()
    finally:
        spark.conf.set(name, before)
    assert len(query.recentProgress) <= 2 < batches.read_counters(spark, out).count()
    assert batches.totals(spark, out, ("consumed", "invalid")) == {"consumed": 10, "invalid": 3}


def test_one_scan_feeds_both_outputs(spark, events, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events.write.parquet(source)
    query = sales.process_sales_stream(sales.read_event_stream(spark, source), out, f"{out}-c", AS_OF)
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [10]


def test_kept_repeated_and_late_events(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id string, at timestamp_ntz, note string"
    waves = [
        [("a", "10:00", "1"), ("a", "10:01", "2"), ("b", "10:30", "3"), (None, "10:00", "x"), (None, "10:00", "y"), ("n", None, "t")],
        # a is before the watermark of 10:20, b is known, the row without id is late.
        [("a", "10:02", "4"), ("b", "10:31", "5"), ("c", "11:00", "6"), ("n", None, "t")],
        # b is forgotten and so kept again, c is known.
        [("b", "10:55", "7"), ("c", "10:52", "8"), ("c", "10:20", "9"), ("d", "10:50", "10")],
    ]
    for wave in waves:
        rows = [(i, datetime.fromisoformat(f"2024-01-01 {t}:00") if t else None, n) for i, t, n in wave]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = sales.read_event_stream(spark, source, schema, required=["id", "at"])
        batches.deduplicate_stream(stream, out, f"{out}-c", ["id"], "at").awaitTermination()
    notes = lambda outcome: {r["note"] for r in batches.read_events(spark, out, outcome).collect()}
    assert notes(batches.KEPT) == {"1", "3", "x", "y", "t", "6", "7", "10"}
    assert notes(batches.LATE) == {"4", "9"}
    n = batches.totals(spark, out, batches.EVENT_COUNTERS)
    assert n == {"consumed": 14, "kept": 9, "repeated": 3, "late": 2}
    assert batches.totals(spark, f"{out}-none", ("kept",)) == {"kept": 0} and batches.read_rows(spark, f"{out}-none") is None


def test_redelivered_events(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(50).select(
        F.col("id").alias("order_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(mins=F.col("id"))).alias("ts"),
    )
    rows.unionByName(rows).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    once = sales.dedupe_stream(stream, ["order_id"], "ts", "2 hours")
    sales.write_stream_partitioned(once, out, f"{out}-c", partition_by=None).awaitTermination()
    assert spark.read.parquet(out).count() == 50


@pytest.fixture(scope="module")
def log(spark):
    rows = [
        ("2024-01-01 11:55:00", "EVENT: LOGIN_FAILURE"),  # exactly five minutes old: out
        ("2024-01-01 11:55:01", "EVENT: LOGIN_FAILURE"), ("2024-01-01 11:59:00", "EVENT: LOGIN_FAILURE"),
        ("2024-01-01 11:59:00", "EVENT: login_failure"),
    ]
    return spark.createDataFrame(rows, "t string, line string").select(F.col("t").cast("timestamp_ntz").alias("log_time"), "line")


def test_unusual_activity(spark, log):
    two = alerts.unusual_activity(log, "LOGIN_FAILURE", as_of="2024-01-01 12:00:00").first()
    assert (two["occurrences"], two["unusual"]) == (2, False)
    three = alerts.unusual_activity(log.unionByName(log.where("log_time > '2024-01-01 11:56:00'")), "LOGIN_FAILURE", as_of="2024-01-01 12:00:00")
    assert (three.first()["occurrences"], three.first()["unusual"]) == (3, True)
    assert alerts.recent_activity_sample(log, "LOGIN_FAILURE", n=1, as_of="2024-01-01 12:00:00").count() == 1


def test_windows(spark, log):
    typed = log.withColumn("kind", F.lit("x"))
    out = alerts.activity_windows(typed, "log_time", "kind", threshold=3)
    got = {(str(r["window_start"])[11:16], r["occurrences"]) for r in out.collect()}
    assert got == {("11:55", 4)}


@pytest.mark.parametrize("value,status", [(100.0, "HIGH"), (100.1, "EXCEEDED"), (80.0, "OK"), (80.1, "HIGH")])
def test_threshold(spark, value, status):
    df = spark.createDataFrame([(value,)], "used double")
    assert alerts.threshold_alert(df, "used", 100.0).first()["status"] == status


SUITE = [{"type": "not_null", "column": "customer_id"}, {"type": "between", "column": "price", "min": 0, "max": 1e6}]


def small_tables(spark):
    from lakestrata.sources.domain import domain_tables

    return domain_tables(spark, "/root/testdata/sf0.001")


def test_batch_pipeline(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    tables = small_tables(spark)
    counts = pipelines.run_batch(spark, tables, lake, "key", SUITE, "v20240201000000", AS_OF)
    n = {r["table"]: r["n_rows"] for r in counts.collect()}
    items = tables["items"].select("order_id", "product_id", "order_item_id").distinct().count()
    assert n["fato_vendas"] == items and n["dim_cliente"] == tables["customers"].count()
    # Only masked places reach the silver and gold layers.
    dim = read_star(spark, lake.star)["dim_cliente"]
    assert dim.select("cidade").distinct().collect()[0][0] == "[CIDADE_REMOVIDA_LGPD]"
    assert dim.where(F.length("estado") != 64).count() == 0
    actions = {r["action"] for r in read_audit(spark, lake.audit).select("action").collect()}
    assert actions == {
        "DATA_MASKED_STATIC", "DATA_MASKED_HASH", "CONSOLIDATION_WRITTEN", "VALIDATION_SUCCESS", "STAR_PUBLISHED",
    }

    totals = pipelines.finish_stream(spark, lake, pipelines.run_stream(spark, lake, AS_OF), AS_OF)
    silver = spark.read.parquet(f"{lake.root}/silver/vendas")
    lines = silver.select("order_id", "product_id", "order_item_id").where("order_item_id is not null").distinct()
    emitted = lambda: sales.read_processed(spark, lake.stream).count()
    assert totals["processed"] == emitted() > 0
    assert totals["consumed"] >= lines.count() and sum(totals.values()) == 2 * totals["consumed"]
    actions = {r["action"] for r in read_audit(spark, lake.audit).select("action").collect()}
    assert "STREAM_FINISHED" in actions

    # A rebuild from fewer orders drops the months that are gone, and a second
    # stream run emits no sale again.
    before = emitted()
    few = {**tables, "orders": tables["orders"].where("order_purchase_timestamp < '1993-01-01'")}
    pipelines.consolidate_and_mask(spark, few, lake, "key", AS_OF)
    months = {r["mes"] for r in spark.read.parquet(f"{lake.root}/silver/vendas").select("mes").distinct().collect()}
    assert all(m is None or m.startswith("1992") or m == "__HIVE_DEFAULT_PARTITION__" for m in months)
    assert pipelines.finish_stream(spark, lake, pipelines.run_stream(spark, lake, AS_OF), AS_OF)["consumed"] == 0
    assert emitted() == before


def test_gate_stops_the_pipeline(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    with pytest.raises(QualityGateError):
        pipelines.run_batch(spark, small_tables(spark), lake, "key", [{"type": "between", "column": "price", "max": 1}], "v1", AS_OF)
    assert current_version(spark, lake.star) is None
    written = {r["action"] for r in read_audit(spark, lake.audit).select("action").collect()}
    assert written >= {"VALIDATION_FAILURE", "VALIDATION_THRESHOLD_BREACH"}
