"""Projections, filters, scalar functions, ranking, numbering."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestrata import constants as K
from lakestrata.functions import text, time
from lakestrata.operators import aggregates, filters, ranking
from lakestrata.operators.dedupe import dedupe_first, with_sequence
from lakestrata.sources.domain import domain_tables, table
from lakestrata.workload.registry import query, with_domain


@query("project_columns", with_domain("""
SELECT order_id, customer_id, order_status, order_purchase_timestamp FROM d_orders"""))
def project_columns(spark, sf_dir):
    return filters.project(domain_tables(spark, sf_dir, "orders")["orders"], K.ORDER_FIRST_COLUMNS["orders"])


@query("map_columns", """
SELECT p_partkey AS produto_id, p_type AS categoria, 'N/A' AS marca, p_size * 2 AS tamanho FROM part""")
def map_columns(spark, sf_dir):
    mapping = {
        "produto_id": "p_partkey", "categoria": "p_type", "marca": "brand_name", "tamanho": F.col("p_size") * 2,
    }
    return filters.map_columns(table(spark, sf_dir, "part"), mapping, {"marca": "N/A"})


@query("drop_if_present", "SELECT event_id, ts, user_id, event_type, value FROM events")
def drop_if_present(spark, sf_dir):
    return filters.drop_if_present(table(spark, sf_dir, "events"), ["props", "no_such_column"])


@query("normalise_na", """
SELECT o_orderkey, nullif(nullif(CASE o_orderstatus WHEN 'P' THEN 'N/A' WHEN 'F' THEN 'nan' ELSE o_orderstatus END,
       'N/A'), 'nan') AS status, o_orderpriority FROM orders""")
def normalise_na(spark, sf_dir):
    spelled = F.when(F.col("o_orderstatus") == "P", F.lit("N/A")).when(
        F.col("o_orderstatus") == "F", F.lit("nan")
    ).otherwise(F.col("o_orderstatus"))
    raw = table(spark, sf_dir, "orders").select("o_orderkey", spelled.alias("status"), "o_orderpriority")
    return filters.normalise_na(raw)


@query("filter_min_price", with_domain("""
SELECT order_id, order_item_id, product_id, CAST(price AS DOUBLE) AS price FROM d_items WHERE price > 40000"""))
def filter_min_price(spark, sf_dir):
    items = domain_tables(spark, sf_dir, "items")["items"].select("order_id", "order_item_id", "product_id", "price")
    return filters.filter_min(items, "price", 40_000)


@query("drop_null_keys", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""")
def drop_null_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"),
    )
    return filters.drop_null(orders, ["o_orderstatus", "o_orderpriority"]).drop("o_orderpriority")


@query("between_ts", """
SELECT event_id, ts, event_type FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00'""")
def between_ts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return filters.between_ts(events, "ts", "2024-01-05 00:00:00", "2024-01-12 12:00:00")


@query("last_days", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 7 DAY")
def last_days(spark, sf_dir):
    return filters.last_days(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", 7, "2024-01-30 00:00:00")


@query("filter_in", "SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'purchase')")
def filter_in(spark, sf_dir):
    return filters.filter_in(
        table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type", ["error", "purchase"]
    )


@query("filter_not_equal", """
SELECT event_id, nullif(event_type, 'view') AS event_type FROM events
WHERE nullif(event_type, 'view') IS DISTINCT FROM 'click'""")
def filter_not_equal(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.nullif(F.col("event_type"), F.lit("view")).alias("event_type")
    )
    return filters.filter_not_equal(events, "event_type", "click")


@query("out_of_range", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 5 OR l_quantity > 45")
def out_of_range(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return filters.out_of_range(lines, "l_quantity", 5, 45)


@query("filter_contains", "SELECT doc_id, source FROM documents WHERE contains(text, 'tion')")
def filter_contains(spark, sf_dir):
    return filters.filter_contains(table(spark, sf_dir, "documents"), "text", "tion").select("doc_id", "source")


@query("split_hot", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE NOT o_orderdate < TIMESTAMP '1998-01-31 00:00:00' - INTERVAL 30 DAY""")
def split_hot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return filters.split_by_age(orders, "o_orderdate", as_of="1998-01-31 00:00:00")[0]


@query("split_cold", """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-31 00:00:00' - INTERVAL 30 DAY""")
def split_cold(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return filters.split_by_age(orders, "o_orderdate", as_of="1998-01-31 00:00:00")[1]


# Ranking and numbering ---------------------------------------------------------

@query("dedupe_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS rn FROM lineitem) WHERE rn = 1""")
def dedupe(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    order = ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    first = dedupe_first(lines, ["l_orderkey", "l_linenumber"], order)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("sequence_ids", """
SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS event_sequence_id FROM orders""")
def sequence_ids(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return with_sequence(orders, ["o_orderdate", "o_orderkey"])


@query("top_k_values", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 5")
def top_k_values(spark, sf_dir):
    return ranking.top_k_values(table(spark, sf_dir, "lineitem"), "l_partkey", 5)


@query("sample_rows", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 3")
def sample_rows(spark, sf_dir):
    return ranking.sample_rows(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), ["doc_id"])


@query("limit_events", "SELECT event_id, ts, event_type FROM events ORDER BY ts, event_id LIMIT 30")
def limit_events(spark, sf_dir):
    return ranking.limit_events(table(spark, sf_dir, "events").select("event_id", "ts", "event_type"), ["ts", "event_id"])


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark, sf_dir):
    return aggregates.value_counts(table(spark, sf_dir, "events"), "event_type")


@query("conditional_counts", """
SELECT count(*) FILTER (WHERE value > 100) AS above_100, count(*) FILTER (WHERE event_type = 'error') AS errors
FROM events""")
def conditional_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(
        aggregates.count_if(F.col("value") > 100).alias("above_100"),
        aggregates.count_if(F.col("event_type") == "error").alias("errors"),
    )


@query("compliance_rate", """
SELECT count(*) AS total, count(*) FILTER (WHERE event_type <> 'error') AS ok,
       round(count(*) FILTER (WHERE event_type <> 'error') / count(*) * 100, 2) AS rate FROM events""")
def compliance_rate(spark, sf_dir):
    return aggregates.compliance_rate(table(spark, sf_dir, "events"), F.col("event_type") != "error")


@query("null_fraction", """
WITH t AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS a, nullif(o_orderpriority, '1-URGENT') AS b FROM orders)
SELECT CAST(sum((a IS NULL)::INT + (b IS NULL)::INT) AS BIGINT) AS null_cells, count(*) * 3 AS cells,
       sum((a IS NULL)::INT + (b IS NULL)::INT) / (count(*) * 3) AS null_fraction FROM t""")
def null_fraction(spark, sf_dir):
    return aggregates.null_fraction(table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("a"),
        F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("b"),
    ))


# Scalar functions -----------------------------------------------------------------

@query("scalar_text", """
SELECT event_id,
       TRY_CAST(CASE event_type WHEN 'error' THEN 'abc' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS number,
       coalesce(nullif(trim(CASE event_type WHEN 'view' THEN '  ' ELSE ' ' || event_type || ' ' END), ''),
                'UNKNOWN') AS state,
       'OP_' || upper(event_type) AS action,
       split_part(event_type || ' - ' || user_id, ' - ', 1) AS head,
       printf('%s spent %.2f', event_type, value) AS message
FROM events""")
def scalar_text(spark, sf_dir):
    kind, value = F.col("event_type"), F.col("value")
    raw = F.when(kind == "error", F.lit("abc")).otherwise(value.cast("string"))
    padded = F.when(kind == "view", F.lit("  ")).otherwise(F.concat(F.lit(" "), kind, F.lit(" ")))
    return table(spark, sf_dir, "events").select(
        "event_id",
        text.safe_number(raw).alias("number"),
        text.default_text(padded, K.UNKNOWN_STATE).alias("state"),
        text.prefixed_upper(kind).alias("action"),
        text.before_first(F.concat_ws(" - ", kind, F.col("user_id").cast("string")), " - ").alias("head"),
        text.message("%s spent %.2f", kind, value).alias("message"),
    )


@query("scalar_time", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS formatted, strftime(ts, '%Y-%m-%d') AS day_key,
       'v' || strftime(ts, '%Y%m%d%H%M%S') AS version, ts + INTERVAL 90 DAY AS expires_at,
       coalesce(TRY_CAST(CASE event_type WHEN 'error' THEN 'not a time' ELSE CAST(ts AS VARCHAR) END AS TIMESTAMP),
                TIMESTAMP '2024-02-01 00:00:00') AS event_ts
FROM events""")
def scalar_time(spark, sf_dir):
    raw = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(F.col("ts").cast("string"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        time.reformat_ts(F.col("ts")).alias("formatted"),
        time.date_key(F.col("ts")).alias("day_key"),
        time.version_stamp(F.col("ts")).alias("version"),
        time.add_days(F.col("ts"), 90).alias("expires_at"),
        time.default_ts(raw, "2024-02-01 00:00:00").alias("event_ts"),
    )


@query("processing_stamp", """
SELECT event_id, event_type, TIMESTAMP '2024-02-01 08:00:00' AS processed_at FROM events""")
def processing_stamp(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return time.stamp(events, "processed_at", "2024-02-01 08:00:00")


@query("scalar_json", """
SELECT event_id, '{"event_type":"' || event_type || '","user_id":' || user_id || '}' AS as_json,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def scalar_json(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        text.as_json(F.col("event_type"), F.col("user_id")).alias("as_json"),
        text.parse_json(F.col("props"), "k bigint")["k"].alias("k"),
    )


@query("scalar_sizes", """
SELECT doc_id, round(n_chars * 1000 / 1048576.0, 2) AS mb,
       CASE WHEN n_chars > 5000 THEN 'large' WHEN n_chars > 1000 THEN 'medium' ELSE 'small' END AS size_class,
       round(n_chars / 7.0, 2) AS weeks FROM documents""")
def scalar_sizes(spark, sf_dir):
    size = F.col("n_chars")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.as_mb(size * 1000).alias("mb"),
        text.classify(size, [5000, 1000], ["large", "medium"], "small").alias("size_class"),
        text.round_to(size / 7).alias("weeks"),
    )


@query("scalar_base64", """
SELECT doc_id, translate(to_base64(encode(text)), '+/', '-_') AS encoded, text AS decoded FROM documents""")
def scalar_base64(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.b64url(F.col("text")).alias("encoded")).withColumn(
        "decoded", text.unb64url(F.col("encoded")).cast("string")
    )


@query("scalar_first_element", "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first_value FROM embeddings")
def scalar_first_element(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", text.first_element(F.col("embedding")).cast("double").alias("first_value")
    )
