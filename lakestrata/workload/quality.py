"""Rule suites, gate, quarantine and feed checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestrata.operators import quality
from lakestrata.operators.quantiles import exact_quantiles
from lakestrata.plans.consolidate import consolidate
from lakestrata.settings import cut_lineage
from lakestrata.sources.domain import domain_tables, table
from lakestrata.workload.registry import query, with_domain

SUITE = [
    {"type": "not_null", "column": "order_id"},
    {"type": "between", "column": "price", "min": 0, "max": 10000},
    {"type": "in_set", "column": "order_status", "values": ["O", "F"]},
    {"type": "between", "column": "freight_value", "min": 0},
    {"type": "of_type", "column": "customer_id", "as": "int"},
    {"type": "not_null", "column": "order_item_id"},
    {"type": "in_set", "column": "payment_type", "values": ["1-URGENT", "2-HIGH"], "mostly": 0.5},
]

WIDE = """
w AS (SELECT o.order_id, c.customer_id, order_status, payment_type, order_item_id, price, freight_value
      FROM d_customers c LEFT JOIN d_orders o ON c.customer_id = o.customer_id
      LEFT JOIN d_payments p ON o.order_id = p.order_id LEFT JOIN d_items i ON o.order_id = i.order_id)"""

RESULTS = """
counted AS (
  SELECT 0 AS rule_id, 'not_null' AS rule_type, 'order_id' AS column_name, count(*) AS tested,
         count(*) FILTER (WHERE order_id IS NULL) AS unexpected, 1.0 AS mostly FROM w
  UNION ALL SELECT 1, 'between', 'price', count(price), count(*) FILTER (WHERE price < 0 OR price > 10000), 1.0 FROM w
  UNION ALL SELECT 2, 'in_set', 'order_status', count(order_status),
         count(*) FILTER (WHERE order_status NOT IN ('O', 'F')), 1.0 FROM w
  UNION ALL SELECT 3, 'between', 'freight_value', count(freight_value), count(*) FILTER (WHERE freight_value < 0), 1.0 FROM w
  UNION ALL SELECT 4, 'of_type', 'customer_id', count(customer_id),
         count(*) FILTER (WHERE customer_id IS NOT NULL AND TRY_CAST(customer_id AS INTEGER) IS NULL), 1.0 FROM w
  UNION ALL SELECT 5, 'not_null', 'order_item_id', count(*), count(*) FILTER (WHERE order_item_id IS NULL), 1.0 FROM w
  UNION ALL SELECT 6, 'in_set', 'payment_type', count(payment_type),
         count(*) FILTER (WHERE payment_type NOT IN ('1-URGENT', '2-HIGH')), 0.5 FROM w),
results AS (
  SELECT rule_id, rule_type, column_name, tested, unexpected,
         round(unexpected * 100.0 / tested, 2) AS unexpected_percent,
         (tested - unexpected) / tested >= mostly AS success FROM counted)"""


def _wide(spark, sf_dir):
    return consolidate(domain_tables(spark, sf_dir)).select(
        "order_id", "customer_id", "order_status", "payment_type", "order_item_id", "price", "freight_value"
    )


@query("suite_results", with_domain("""
SELECT rule_id, rule_type, column_name, tested, unexpected, CAST(unexpected_percent AS DOUBLE) AS unexpected_percent,
       success FROM results""", WIDE, RESULTS))
def suite_results(spark, sf_dir):
    """Seven rules over the consolidated table, counted in one scan."""
    return quality.validate(_wide(spark, sf_dir), SUITE)


@query("suite_examples", with_domain("""
SELECT rule_id, unexpected, array_to_string(examples, '|') AS examples FROM results LEFT JOIN (
  SELECT 1 AS rule_id, list(v ORDER BY v) AS examples FROM (
    SELECT DISTINCT CAST(price AS VARCHAR) AS v FROM w WHERE price < 0 OR price > 10000 ORDER BY v LIMIT 5)
  UNION ALL SELECT 2, list(v ORDER BY v) FROM (
    SELECT DISTINCT order_status AS v FROM w WHERE order_status NOT IN ('O', 'F') ORDER BY v LIMIT 5)
  UNION ALL SELECT 6, list(v ORDER BY v) FROM (
    SELECT DISTINCT payment_type AS v FROM w WHERE payment_type NOT IN ('1-URGENT', '2-HIGH') ORDER BY v LIMIT 5)
) USING (rule_id)""", WIDE, RESULTS))
def suite_examples(spark, sf_dir):
    """Examples take a second scan, so the suite runs on the stored table."""
    stored = cut_lineage(_wide(spark, sf_dir), "silver")
    results = quality.validate(stored, SUITE, examples=5)
    return results.select("rule_id", "unexpected", F.array_join("examples", "|").alias("examples"))


@query("suite_summary", with_domain("""
SELECT count(*) AS evaluated, count(*) FILTER (WHERE success) AS successful,
       count(*) FILTER (WHERE success) / count(*) AS success_rate,
       count(*) FILTER (WHERE success) = count(*) AS success,
       count(*) FILTER (WHERE success) / count(*) < 0.95 AS below_threshold FROM results""", WIDE, RESULTS))
def suite_summary(spark, sf_dir):
    return quality.suite_summary(quality.validate(_wide(spark, sf_dir), SUITE))


@query("failed_rule_summary", with_domain("""
SELECT string_agg(DISTINCT rule_type, ', ' ORDER BY rule_type) AS failed_rules FROM results WHERE NOT success""",
WIDE, RESULTS))
def failed_rule_summary(spark, sf_dir):
    return quality.failed_rule_summary(quality.validate(_wide(spark, sf_dir), SUITE))


ROW_SUITE = [
    {"type": "between", "column": "l_quantity", "min": 2, "max": 48},
    {"type": "in_set", "column": "l_returnflag", "values": ["A", "N"]},
    {"type": "not_null", "column": "l_partkey"},
]


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")


@query("quarantine_rejected", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag,
       concat_ws(',', CASE WHEN l_quantity < 2 OR l_quantity > 48 THEN '0' END,
                 CASE WHEN l_returnflag NOT IN ('A', 'N') THEN '1' END) AS failed_rules
FROM lineitem WHERE l_quantity < 2 OR l_quantity > 48 OR l_returnflag NOT IN ('A', 'N')""")
def quarantine_rejected(spark, sf_dir):
    rejected = quality.quarantine(_lines(spark, sf_dir), ROW_SUITE)[1]
    return rejected.withColumn("failed_rules", F.array_join(F.col("failed_rules").cast("array<string>"), ","))


@query("quarantine_accepted", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM lineitem
WHERE NOT (l_quantity < 2 OR l_quantity > 48 OR l_returnflag NOT IN ('A', 'N'))""")
def quarantine_accepted(spark, sf_dir):
    return quality.quarantine(_lines(spark, sf_dir), ROW_SUITE)[0]


@query("check_collected", """
WITH ind AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS valor FROM orders),
     cli AS (SELECT event_id, value - 20 AS temperatura, event_type FROM events)
SELECT 'ipca' AS source, CASE WHEN count(*) FILTER (WHERE valor IS NULL) / (count(*) * 2) > 0.01 THEN 'NULLS' ELSE 'OK' END AS status,
       round(count(*) FILTER (WHERE valor IS NULL) / (count(*) * 2) * 100, 2) AS null_percent, CAST(NULL AS BIGINT) AS extreme_rows FROM ind
UNION ALL SELECT 'clima', 'OK', 0.0, count(*) FILTER (WHERE temperatura < -10 OR temperatura > 50) FROM cli
UNION ALL SELECT 'vento', 'MISSING', NULL, NULL""")
def check_collected(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("valor")
    )
    weather = table(spark, sf_dir, "events").select(
        "event_id", (F.col("value") - 20).alias("temperatura"), "event_type"
    )
    return quality.check_collected({"ipca": orders, "clima": weather, "vento": None})


@query("zscore_outliers", """
SELECT event_id, value FROM events
WHERE abs(value - (SELECT avg(value) FROM events)) > 3 * (SELECT stddev_samp(value) FROM events)""")
def zscore_outliers(spark, sf_dir):
    return quality.zscore_outliers(table(spark, sf_dir, "events").select("event_id", "value"), "value", 3.0)


@query("iqr_outliers", """
WITH q AS (SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM events)
SELECT event_id, value FROM events, q WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def iqr_outliers(spark, sf_dir):
    rule = {"type": "iqr", "column": "value"}
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return quality.quarantine(events, [rule])[1].drop("failed_rules")


@query("exact_quantiles", """
SELECT CAST(unnest([1, 5, 25, 50, 75, 99, 100]) AS INTEGER) AS percent,
       unnest(quantile_disc(l_extendedprice, [0.01, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0])) AS value FROM lineitem""")
def exact_quantiles_(spark, sf_dir):
    """Exact quantiles of the line prices, many ties among them."""
    percents = [1, 5, 25, 50, 75, 99, 100]
    found = exact_quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", [p / 100 for p in percents])
    return spark.createDataFrame(list(zip(percents, found)), "percent int, value double")
