"""JSON feeds, logs and object inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestrata.settings import work_path
from lakestrata.sources import feeds, inventory
from lakestrata.sources.domain import table
from lakestrata.sources.logs import parse_monitor_log
from lakestrata.workload.registry import query


def weather_documents(spark, sf_dir):
    """One weather document per event; error events land broken, and view
    events lack the wind."""
    kind = F.col("event_type")
    main = F.struct(
        F.col("value").alias("temp"), F.col("user_id").cast("int").alias("humidity"),
        (F.lit(1000) + F.col("user_id").cast("int")).alias("pressure"),
    )
    weather = F.array(F.struct(kind.alias("description")))
    wind = F.when(kind != "view", F.struct((F.col("value") / 2).alias("speed")))
    whole = F.to_json(F.struct(main.alias("main"), weather.alias("weather"), wind.alias("wind")))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("cidade_"), F.col("user_id").cast("string")).alias("cidade"),
        F.col("ts").alias("data_coleta"),
        F.when(kind == "error", F.concat(F.lit("{broken "), whole)).otherwise(whole).alias("json"),
    )


@query("flatten_weather", """
SELECT event_id, 'cidade_' || user_id AS cidade, value AS temperatura, event_type AS condicao,
       CAST(user_id AS INTEGER) AS umidade, CAST(1000 + user_id AS INTEGER) AS pressao, value / 2 AS velocidade_vento,
       ts AS data_coleta FROM events WHERE event_type NOT IN ('error', 'view')""")
def flatten_weather(spark, sf_dir):
    good, _ = feeds.split_malformed(weather_documents(spark, sf_dir))
    return feeds.flatten_weather(good, 7)


@query("flatten_weather_short", """
SELECT event_id, 'cidade_' || user_id AS cidade, value AS temperatura, event_type AS condicao
FROM events WHERE event_type <> 'error'""")
def flatten_weather_short(spark, sf_dir):
    rows = feeds.flatten_weather(weather_documents(spark, sf_dir), 3)
    return rows.where("temperatura is not null")


@query("flatten_weather_collected", """
SELECT event_id, 'cidade_' || user_id AS cidade, value AS temperatura, event_type AS condicao, ts AS data_coleta
FROM events WHERE event_type <> 'error'""")
def flatten_weather_collected(spark, sf_dir):
    rows = feeds.flatten_weather(weather_documents(spark, sf_dir), 4)
    return rows.where("temperatura is not null")


@query("flatten_weather_pressure", """
SELECT event_id, 'cidade_' || user_id AS cidade, value AS temperatura, event_type AS condicao,
       CAST(user_id AS INTEGER) AS umidade, CAST(1000 + user_id AS INTEGER) AS pressao
FROM events WHERE event_type <> 'error'""")
def flatten_weather_pressure(spark, sf_dir):
    rows = feeds.flatten_weather(weather_documents(spark, sf_dir), 5)
    return rows.where("temperatura is not null")


@query("malformed_documents", """
SELECT event_id, 'cidade_' || user_id AS cidade FROM events WHERE event_type IN ('error', 'view')""")
def malformed_documents(spark, sf_dir):
    return feeds.split_malformed(weather_documents(spark, sf_dir))[1].select("event_id", "cidade")


@query("flatten_indicator", """
SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS data, o_orderpriority AS valor FROM orders
UNION ALL SELECT o_orderkey, '01/01/2000', o_orderstatus FROM orders""")
def flatten_indicator(spark, sf_dir):
    element = F.struct(F.date_format("o_orderdate", "dd/MM/yyyy").alias("data"), F.col("o_orderpriority").alias("valor"))
    second = F.struct(F.lit("01/01/2000").alias("data"), F.col("o_orderstatus").alias("valor"))
    documents = table(spark, sf_dir, "orders").select("o_orderkey", F.to_json(F.array(element, second)).alias("json"))
    return feeds.flatten_indicator(documents)


def log_lines(spark, sf_dir):
    """Monitor-log lines of the events; view events lack the timestamp."""
    line = F.concat(
        F.when(F.col("event_type") == "view", F.lit("sem data"))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(",123"))),
        F.lit(" - monitor - INFO - EVENT: "), F.upper("event_type"), F.lit(" - usuario "),
        F.col("user_id").cast("string"), F.lit(" - Details: "), F.col("props"),
    )
    return table(spark, sf_dir, "events").select(line.alias("value"))


@query("parse_monitor_log", """
SELECT date_trunc('second', ts) AS log_time, 'monitor' AS logger, 'INFO' AS level, upper(event_type) AS event_type,
       'usuario ' || user_id AS message, props AS details,
       strftime(ts, '%Y-%m-%d %H:%M:%S') || ',123 - monitor - INFO - EVENT: ' || upper(event_type) || ' - usuario '
         || user_id || ' - Details: ' || props AS line
FROM events WHERE event_type <> 'view'""")
def parse_log(spark, sf_dir):
    return parse_monitor_log(log_lines(spark, sf_dir))


@query("inventory_verify", """
SELECT source || '/' || d.doc_id AS path, CASE WHEN l.doc_id IS NULL THEN 'NOT_FOUND' ELSE 'OK' END AS status,
       CASE WHEN l.doc_id IS NOT NULL THEN round(n_chars * 1000 / 1048576.0, 2) END AS size_mb
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id""")
def inventory_verify(spark, sf_dir):
    """Documents are the expected objects; the labelled ones are in store."""
    path = F.concat_ws("/", F.col("source"), F.col("doc_id").cast("string"))
    documents = table(spark, sf_dir, "documents")
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct()
    stored = documents.join(labelled, "doc_id", "left_semi").select(
        path.alias("path"), (F.col("n_chars") * 1000).alias("length")
    )
    return inventory.verify_objects(stored, documents.select(path.alias("path")))


@query("inventory_summary", """
SELECT count(*) AS objects, CAST(sum(n_chars) AS BIGINT) AS bytes, round(sum(n_chars) / 1048576, 2) AS mb FROM documents""")
def inventory_summary(spark, sf_dir):
    return inventory.inventory_summary(
        table(spark, sf_dir, "documents").select(F.col("n_chars").alias("length"))
    )


@query("object_inventory", """
SELECT source, count(*) AS n_rows, true AS stored FROM documents GROUP BY source""")
def object_inventory(spark, sf_dir):
    """Documents stored by source: every source's rows beside whether its
    folder holds objects, each of some size."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    path = work_path(spark, "inventory")
    rows.write.partitionBy("source").parquet(path)
    objects = inventory.list_objects(spark, path, "*.parquet").select(
        F.regexp_extract("path", r"/source=([^/]+)/", 1).alias("source"), "length"
    )
    held = objects.groupBy("source").agg((F.min("length") > 0).alias("stored"))
    counted = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.join(held, "source", "left").select("source", "n_rows", "stored")
