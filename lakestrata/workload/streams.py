"""Sales stream and alerts; streams run to the end of the given data."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestrata.settings import work_path
from lakestrata.sources.domain import table
from lakestrata.sources.logs import parse_monitor_log
from lakestrata.streaming import alerts, batches, sales
from lakestrata.workload.feeds import log_lines
from lakestrata.workload.registry import query

AS_OF = "2024-02-01 00:00:00"

EVENT_CTE = """
s AS (SELECT event_id, ts AS event_ts, CAST(ts AS VARCHAR) AS ts, CASE event_type WHEN 'view' THEN ' ' ELSE ' ' || event_type END AS customer_state,
             CASE event_type WHEN 'error' THEN 'abc' ELSE CAST(value * 3 AS VARCHAR) END AS price FROM events)"""


def _as_sales(events):
    """Events as sales: price text, padded or blank state, text timestamp."""
    kind = F.col("event_type")
    return events.select(
        F.col("ts").alias("event_ts"),
        F.col("ts").cast("string").alias("timestamp"),
        F.when(kind == "view", F.lit(" ")).otherwise(F.concat(F.lit(" "), kind)).alias("customer_state"),
        F.when(kind == "error", F.lit("abc")).otherwise((F.col("value") * 3).cast("string")).alias("price"),
        F.col("event_id").cast("string").alias("order_id"),
    )


def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    required = ["ts", "event_type", "value", "event_id"]
    return sales.read_event_stream(spark, sf_dir, schema, pattern="events.parquet", required=required)


PROCESSED = f"""
WITH {EVENT_CTE} SELECT coalesce(nullif(trim(customer_state), ''), 'UNKNOWN') AS customer_state,
  CAST(price AS DOUBLE) AS price, CAST(ts AS TIMESTAMP) AS timestamp, TIMESTAMP '{AS_OF}' AS processed_at
FROM s WHERE price <> 'abc' AND CAST(price AS DOUBLE) > 100"""


def _typed(df):
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("sales_transform", PROCESSED)
def sales_transform(spark, sf_dir):
    return _typed(sales.transform_sales(_as_sales(table(spark, sf_dir, "events")), AS_OF))


@query("sales_stream", PROCESSED)
def sales_stream(spark, sf_dir):
    """The same through Structured Streaming and the sink by batch."""
    out = work_path(spark, "sales-stream")
    sales.process_sales_stream(
        _as_sales(_event_stream(spark, sf_dir)), f"{out}/sales", f"{out}/checkpoint", AS_OF
    ).awaitTermination()
    return _typed(sales.read_processed(spark, f"{out}/sales").drop("event_date"))


def _feed(df, path, files):
    """``df`` dealt over a number of files, for a stream that takes few at a time."""
    df.repartition(files).write.mode("append").parquet(path)


@query("sales_stream_outputs", f"""
WITH {EVENT_CTE}, t AS (SELECT TRY_CAST(price AS DOUBLE) AS p FROM s)
SELECT count(*) AS consumed, count(*) FILTER (WHERE p > 100) AS processed, count(*) FILTER (WHERE p <= 100) AS skipped,
  count(*) FILTER (WHERE p IS NULL) AS invalid, count(*) FILTER (WHERE p > 100) AS processed_rows,
  count(*) FILTER (WHERE p IS NULL) AS invalid_rows, round(sum(p) FILTER (WHERE p > 100), 2) AS price_total FROM t""")
def sales_stream_outputs(spark, sf_dir):
    """Both outputs of one stream and its counters, over 24 micro-batches and
    a restart."""
    out = work_path(spark, "outputs")
    rows = _as_sales(table(spark, sf_dir, "events")).drop("event_ts")
    for part in (0, 1):
        _feed(rows.where(F.pmod(F.xxhash64("order_id"), F.lit(2)) == part), f"{out}/in", 12)
        stream = sales.read_event_stream(spark, f"{out}/in", rows.schema, max_files=1)
        sales.process_sales_stream(stream, f"{out}/sales", f"{out}/checkpoint", AS_OF).awaitTermination()
    names = ("consumed", "processed", "skipped", "invalid")
    counted = batches.totals(spark, f"{out}/sales", names)
    good, bad = sales.read_processed(spark, f"{out}/sales"), sales.read_invalid(spark, f"{out}/sales")
    written = good.agg(F.count(F.lit(1)).alias("processed_rows"), F.round(F.sum("price"), 2).alias("price_total"))
    return written.select(
        *[F.lit(counted[n]).cast("long").alias(n) for n in names], "processed_rows",
        bad.agg(F.count(F.lit(1)).alias("n")).scalar().alias("invalid_rows"), "price_total",
    )


# Three waves by event time. A wave delivers every fifth event twice, and every
# seventh event of the wave before it once more.
WAVE_CTE = """
b AS (SELECT min(ts) AS low, max(ts) - min(ts) AS width FROM events),
e AS (SELECT event_id, ts, CAST(least(floor(3 * (epoch_us(ts) - epoch_us(low)) / (epoch_us(low + width) - epoch_us(low))), 2) AS INT) AS wave
      FROM events, b),
late AS (SELECT wave + 1 AS wave, max(ts) - INTERVAL 10 MINUTE AS watermark FROM e GROUP BY wave)"""


@query("stream_events_classified", f"""
WITH {WAVE_CTE}, again AS (SELECT e.ts < l.watermark AS late FROM e JOIN late l ON l.wave = e.wave + 1 WHERE e.event_id % 7 = 0 AND e.wave < 2)
SELECT (SELECT count(*) + count(*) FILTER (WHERE event_id % 5 = 0) FROM e) + (SELECT count(*) FROM again) AS consumed,
  (SELECT count(DISTINCT event_id) FROM e) AS kept,
  (SELECT count(*) FILTER (WHERE event_id % 5 = 0) FROM e) + (SELECT count(*) FROM again WHERE NOT late) AS repeated,
  (SELECT count(*) FROM again WHERE late) AS late, (SELECT count(*) FROM events) AS kept_rows""")
def stream_events_classified(spark, sf_dir):
    """Repeated and late deliveries over three waves, each in a run of its own."""
    out = work_path(spark, "classified")
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    low, high = (events.agg(f("ts")).scalar() for f in (F.min, F.max))
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    share = F.floor(3 * (micros(F.col("ts")) - micros(low)) / (micros(high) - micros(low)))
    waves = events.withColumn("wave", F.least(share, F.lit(2)).cast("int"))
    for wave in range(3):
        own = waves.where(F.col("wave") == wave)
        twice = own.where("event_id % 5 = 0")
        before = waves.where((F.col("wave") == wave - 1) & (F.col("event_id") % 7 == 0))
        own.unionByName(twice).unionByName(before).select("event_id", "ts").write.mode("append").parquet(f"{out}/in")
        stream = sales.read_event_stream(spark, f"{out}/in", events.schema, required=["event_id", "ts"])
        batches.deduplicate_stream(stream, f"{out}/events", f"{out}/checkpoint", ["event_id"], "ts").awaitTermination()
    counted = batches.totals(spark, f"{out}/events", batches.EVENT_COUNTERS)
    kept = batches.read_events(spark, f"{out}/events", batches.KEPT)
    return kept.agg(F.count(F.lit(1)).alias("kept_rows")).select(
        *[F.lit(counted[n]).cast("long").alias(n) for n in batches.EVENT_COUNTERS], "kept_rows"
    )


@query("sales_invalid", f"WITH {EVENT_CTE} SELECT event_ts, price, CAST(event_id AS VARCHAR) AS order_id FROM s WHERE price = 'abc'")
def sales_invalid(spark, sf_dir):
    invalid = sales.split_invalid(_as_sales(table(spark, sf_dir, "events")))[1]
    return invalid.select("event_ts", "price", "order_id")


@query("sales_audit_rows", f"""
WITH {EVENT_CTE}, t AS (SELECT *, TRY_CAST(price AS DOUBLE) AS p FROM s)
SELECT TIMESTAMP '{AS_OF}' AS timestamp, CASE WHEN p IS NULL THEN 'WARNING' ELSE 'INFO' END AS level,
  'system' AS dag_id, 'system' AS task_id, 'airflow_process' AS user,
  CASE WHEN p IS NULL THEN 'STREAM_EVENT_INVALID_PRICE' WHEN p > 100 THEN 'STREAM_EVENT_PROCESSED' ELSE 'STREAM_EVENT_SKIPPED_RULE' END AS action,
  CASE WHEN p IS NULL THEN 'Evento com ''price'' invalido: ' || price || '. Pulando processamento.'
       WHEN p > 100 THEN 'State: ' || coalesce(nullif(trim(customer_state), ''), 'UNKNOWN') || ', Value: R$ ' || printf('%.2f', p)
       ELSE 'Evento de venda ignorado (preco <= R$ 100): R$ ' || printf('%.2f', p) END AS details,
  CASE WHEN p IS NULL THEN 'LGPD_WARNING' WHEN p > 100 THEN 'LGPD_PROCESSED' ELSE 'LGPD_NA' END AS compliance_status,
  CASE WHEN p IS NULL THEN 'MEDIUM' ELSE 'INFO' END AS risk_level, 'N/A' AS service, '' AS error_message,
  false AS stack_trace_needed FROM t""")
def sales_audit_rows(spark, sf_dir):
    return sales.sales_audit(_as_sales(table(spark, sf_dir, "events")), AS_OF)


@query("sales_stream_counts", f"""
WITH {EVENT_CTE} SELECT count(*) AS consumed, count(*) FILTER (WHERE TRY_CAST(price AS DOUBLE) > 100) AS processed,
  count(*) FILTER (WHERE TRY_CAST(price AS DOUBLE) <= 100) AS skipped,
  count(*) FILTER (WHERE TRY_CAST(price AS DOUBLE) IS NULL) AS invalid FROM s""")
def sales_stream_counts(spark, sf_dir):
    events = _as_sales(table(spark, sf_dir, "events"))
    return events.agg(*sales.stream_counts(events))


@query("stream_deduplicated", "SELECT event_id, ts, event_type FROM events")
def stream_deduplicated(spark, sf_dir):
    """Every event is delivered twice; the stream keeps one of each."""
    events = _event_stream(spark, sf_dir).select("event_id", "ts", "event_type")
    twice = events.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    once = sales.dedupe_stream(twice, ["event_id"], "ts", "10 minutes")
    out = work_path(spark, "dedupe-stream")
    sales.write_stream_partitioned(
        once.withColumn("ts", F.col("ts").cast("timestamp_ntz")), f"{out}/rows", f"{out}/checkpoint", partition_by=None
    ).awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def _window_sql(where=""):
    return f"""
WITH e AS (SELECT event_type, ts, date_trunc('minute', ts) - to_minutes(CAST(k AS INTEGER)) AS window_start
           FROM events, range(5) r(k))
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type AS activity_type, count(*) AS occurrences
FROM e {where} GROUP BY 1, 2, 3 HAVING count(*) >= 2"""


@query("activity_windows", _window_sql())
def activity_windows(spark, sf_dir):
    return alerts.activity_windows(table(spark, sf_dir, "events"), "ts", "event_type", threshold=2)


@query("activity_windows_stream", _window_sql())
def activity_windows_stream(spark, sf_dir):
    """Streaming windows, those the watermark has not passed included."""
    out = work_path(spark, "windows-stream")
    alerts.follow_activity_windows(_event_stream(spark, sf_dir), f"{out}/rows", f"{out}/checkpoint", "ts", "event_type").awaitTermination()
    return alerts.read_activity_windows(spark, f"{out}/rows", threshold=2)


@query("unusual_activity", """
SELECT 'ERROR' AS activity_type, count(*) AS occurrences, count(*) >= 3 AS unusual
FROM events WHERE event_type = 'error' AND date_trunc('second', ts) > TIMESTAMP '2024-01-10 12:00:00' - INTERVAL 600 MINUTE""")
def unusual_activity(spark, sf_dir):
    log = parse_monitor_log(log_lines(spark, sf_dir))
    return alerts.unusual_activity(log, "ERROR", 3, 600, as_of="2024-01-10 12:00:00")


@query("recent_activity_sample", """
SELECT date_trunc('second', ts) AS log_time, upper(event_type) AS event_type, 'usuario ' || user_id AS message FROM events
WHERE event_type = 'error' AND date_trunc('second', ts) > TIMESTAMP '2024-01-10 12:00:00' - INTERVAL 600 MINUTE
ORDER BY log_time, strftime(ts, '%Y-%m-%d %H:%M:%S') || ',123 - monitor - INFO - EVENT: ' || upper(event_type) || ' - usuario '
         || user_id || ' - Details: ' || props LIMIT 5""")
def recent_activity_sample(spark, sf_dir):
    log = parse_monitor_log(log_lines(spark, sf_dir))
    rows = alerts.recent_activity_sample(log, "ERROR", 600, as_of="2024-01-10 12:00:00")
    return rows.select("log_time", "event_type", "message")


@query("threshold_alert", """
SELECT event_id, value, CASE WHEN value > 50 THEN 'EXCEEDED' WHEN value > 40 THEN 'HIGH' ELSE 'OK' END AS status FROM events""")
def threshold_alert(spark, sf_dir):
    return alerts.threshold_alert(table(spark, sf_dir, "events").select("event_id", "value"), "value", 50)
