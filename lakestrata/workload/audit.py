"""Audit rows and reports, built from the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestrata.operators import audit, quality, summaries
from lakestrata.plans import pipelines
from lakestrata.settings import work_path
from lakestrata.sinks.files import append_audit
from lakestrata.sources.domain import table
from lakestrata.sources.logs import read_audit
from lakestrata.workload.registry import query

LEVEL = "CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'warning' ELSE 'info' END"

# The audit table every report below reads.
AUDIT_CTE = f"""
a AS (
  SELECT ts AS timestamp, upper({LEVEL}) AS level, 'system' AS dag_id, 'system' AS task_id,
         coalesce(nullif('user_' || user_id, 'user_1'), 'airflow_process') AS user,
         CASE event_type WHEN 'error' THEN 'ERROR_EVENT' WHEN 'purchase' THEN 'WARNING_EVENT' ELSE 'INFO_EVENT' END AS action,
         event_type || ' ' || props AS details,
         CASE event_type WHEN 'error' THEN 'LGPD_BREACH' WHEN 'purchase' THEN 'LGPD_WARNING' ELSE 'LGPD_OK' END AS compliance_status,
         CASE event_type WHEN 'error' THEN 'HIGH' WHEN 'purchase' THEN 'MEDIUM' ELSE 'INFO' END AS risk_level,
         'N/A' AS service, '' AS error_message, false AS stack_trace_needed
  FROM events),
p AS (SELECT * FROM a WHERE timestamp BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-20 23:59:59')"""

START, END = "2024-01-03 00:00:00", "2024-01-20 23:59:59"


def _happenings(spark, sf_dir):
    kind = F.col("event_type")
    user = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"),
        F.when(kind == "error", "error").when(kind == "purchase", "warning").otherwise("info").alias("level"),
        F.nullif(user, F.lit("user_1")).alias("user"),
        F.concat_ws(" ", kind, "props").alias("message"),
    )


def audit_table(spark, sf_dir):
    return audit.audit_rows(_happenings(spark, sf_dir), preset=True)


def _report(spark, sf_dir):
    return audit.audit_report(audit_table(spark, sf_dir), START, END)


@query("audit_rows", f"""
SELECT ts AS timestamp, upper({LEVEL}) AS level, 'system' AS dag_id, 'system' AS task_id,
       coalesce(nullif('user_' || user_id, 'user_1'), 'airflow_process') AS user, 'GENERIC_EVENT' AS action,
       event_type || ' ' || props AS details, 'LGPD_NA' AS compliance_status, upper({LEVEL}) AS risk_level,
       'N/A' AS service, '' AS error_message, false AS stack_trace_needed FROM events""")
def audit_rows(spark, sf_dir):
    return audit.audit_rows(_happenings(spark, sf_dir))


@query("audit_rows_preset", f"WITH {AUDIT_CTE} SELECT * FROM a")
def audit_rows_preset(spark, sf_dir):
    return audit_table(spark, sf_dir)


@query("audit_operations", """
SELECT o_orderdate AS timestamp, 'INFO' AS level, 'sales' AS dag_id, o_orderstatus AS task_id,
       'airflow_process' AS user, 'OP_' || upper(lower(o_orderpriority)) AS action,
       'Operação: ' || lower(o_orderpriority) || CASE WHEN o_orderstatus <> 'P' THEN ' | Metadados: {"pedido":' || o_orderkey || '}' ELSE '' END AS details,
       'LGPD_OK' AS compliance_status, 'INFO' AS risk_level, 'N/A' AS service, '' AS error_message,
       false AS stack_trace_needed FROM orders""")
def audit_operations(spark, sf_dir):
    metadata = F.to_json(F.struct(F.col("o_orderkey").alias("pedido")))
    return audit.audit_operations(table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("timestamp"), F.lit("sales").alias("dag_id"), F.col("o_orderstatus").alias("task_id"),
        F.lower("o_orderpriority").alias("operation"),
        F.when(F.col("o_orderstatus") != "P", metadata).alias("metadata"),
    ))


@query("audit_incidents", """
SELECT o_orderdate AS timestamp, upper(substr(o_orderpriority, 3)) AS level, 'N/A' AS dag_id, 'N/A' AS task_id,
       'security_system' AS user, 'SECURITY_INCIDENT' AS action,
       'INCIDENTE DETECTADO: pedido ' || o_orderkey AS details,
       CASE WHEN substr(o_orderpriority, 3) IN ('CRITICAL', 'URGENT', 'HIGH') THEN 'LGPD_BREACH' ELSE 'LGPD_WARNING' END AS compliance_status,
       upper(substr(o_orderpriority, 3)) AS risk_level, 'SECURITY_SYSTEM' AS service,
       'pedido ' || o_orderkey AS error_message, o_orderstatus = 'F' AS stack_trace_needed FROM orders""")
def audit_incidents(spark, sf_dir):
    return audit.audit_incidents(table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("timestamp"),
        F.lower(F.substring("o_orderpriority", 3, 100)).alias("severity"),
        F.concat(F.lit("pedido "), F.col("o_orderkey").cast("string")).alias("error"),
        (F.col("o_orderstatus") == "F").alias("stack_trace"),
    ))


@query("audit_transfers", """
SELECT l_shipdate AS timestamp, 'INFO' AS level, 'N/A' AS dag_id, 'N/A' AS task_id, 'airflow_process' AS user,
       CASE WHEN l_returnflag = 'A' THEN 'FILE_UPLOAD' ELSE 'OBJECT_TRANSFER' END AS action,
       CASE WHEN l_returnflag = 'A' THEN 'Arquivo enviado de ''bronze'' para ''silver''.'
            ELSE 'Objeto ''' || l_orderkey || ''' transferido de ''bronze'' para ''silver''.' END AS details,
       'LGPD_OK' AS compliance_status, 'INFO' AS risk_level,
       CASE WHEN l_returnflag = 'A' THEN 'MinIO/S3' ELSE 'MinIO/S3_Lifecycle' END AS service,
       '' AS error_message, false AS stack_trace_needed FROM lineitem""")
def audit_transfers(spark, sf_dir):
    key = F.when(F.col("l_returnflag") != "A", F.col("l_orderkey").cast("string"))
    return audit.audit_transfers(table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("timestamp"), key.alias("object_key"),
        F.lit("bronze").alias("source"), F.lit("silver").alias("destination"),
    ))


@query("audit_validation_rows", """
WITH r AS (SELECT 'between' AS rule_type, count(*) FILTER (WHERE value < 0 OR value > 100) = 0 AS success FROM events
           UNION ALL SELECT 'not_null', count(*) FILTER (WHERE user_id IS NULL) = 0 FROM events),
t AS (SELECT count(*) AS evaluated, count(*) FILTER (WHERE success) AS successful,
             coalesce(string_agg(DISTINCT '"' || rule_type || '"', ',') FILTER (WHERE NOT success), '') AS failed FROM r)
SELECT TIMESTAMP '2024-02-01 00:00:00' AS timestamp,
       CASE WHEN evaluated = successful THEN 'INFO' ELSE 'ERROR' END AS level, 'system' AS dag_id, 'system' AS task_id,
       'airflow_process' AS user,
       CASE WHEN evaluated = successful THEN 'VALIDATION_SUCCESS' ELSE 'VALIDATION_FAILURE' END AS action,
       '{"success":' || CASE WHEN evaluated = successful THEN 'true' ELSE 'false' END || ',"evaluated":' || evaluated
         || ',"successful":' || successful || ',"failed_rules":[' || failed || '],"source":"events"}' AS details,
       CASE WHEN evaluated = successful THEN 'LGPD_OK' ELSE 'LGPD_VIOLATION' END AS compliance_status,
       CASE WHEN evaluated = successful THEN 'LOW' ELSE 'HIGH' END AS risk_level,
       'Data_Validation' AS service, '' AS error_message, false AS stack_trace_needed FROM t""")
def audit_validation_rows(spark, sf_dir):
    suite = [
        {"type": "between", "column": "value", "min": 0, "max": 100},
        {"type": "not_null", "column": "user_id"},
    ]
    results = quality.validate(table(spark, sf_dir, "events"), suite)
    return audit.audit_validations(results, "events", "2024-02-01 00:00:00")


@query("audit_summary", f"""
WITH {AUDIT_CTE} SELECT count(*) AS total_eventos, count(*) FILTER (WHERE risk_level = 'HIGH') AS eventos_risco_alto,
  count(DISTINCT user) AS usuarios_ativos,
  round(count(*) FILTER (WHERE compliance_status = 'LGPD_OK') / count(*) * 100, 2) AS taxa_conformidade_lgpd FROM p""")
def audit_summary(spark, sf_dir):
    return _report(spark, sf_dir)["resumo"]


@query("audit_action_counts", f"WITH {AUDIT_CTE} SELECT action, count(*) AS n FROM p GROUP BY 1")
def audit_action_counts(spark, sf_dir):
    return _report(spark, sf_dir)["distribuicao_acoes"]


@query("audit_top_violations", f"""
WITH {AUDIT_CTE} SELECT details, count(*) AS n FROM p WHERE compliance_status <> 'LGPD_OK'
GROUP BY 1 ORDER BY n DESC, details LIMIT 5""")
def audit_top_violations(spark, sf_dir):
    return _report(spark, sf_dir)["principais_violacoes"]


@query("audit_critical_rows", f"WITH {AUDIT_CTE} SELECT * FROM p WHERE level IN ('ERROR', 'CRITICAL')")
def audit_critical_rows(spark, sf_dir):
    return _report(spark, sf_dir)["detalhes_eventos_criticos"]


@query("authority_report", f"""
WITH {AUDIT_CTE} SELECT timestamp, level, dag_id, task_id, action, details, compliance_status FROM p""")
def authority_report(spark, sf_dir):
    return _report(spark, sf_dir)["autoridade"]


@query("authority_report_written", f"""
WITH {AUDIT_CTE} SELECT level, compliance_status, count(*) AS n_rows FROM p GROUP BY ALL""")
def authority_report_written(spark, sf_dir):
    """The restricted copy, written from the stored audit table and read back."""
    lake = pipelines.Lake(work_path(spark, "authority"))
    append_audit(audit_table(spark, sf_dir), lake.audit)
    path = pipelines.write_authority_report(spark, lake, START, END, "2024-02-01 00:00:00")
    return spark.read.parquet(path).groupBy("level", "compliance_status").agg(F.count(F.lit(1)).alias("n_rows"))


@query("audit_last_days", f"""
WITH {AUDIT_CTE} SELECT * FROM a WHERE timestamp >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 7 DAY""")
def audit_last_days(spark, sf_dir):
    return audit.audit_last_days(audit_table(spark, sf_dir), 7, as_of="2024-01-30 00:00:00")


@query("audit_append_and_read", f"WITH {AUDIT_CTE} SELECT *, strftime(timestamp, '%Y-%m-%d') AS event_date FROM a")
def audit_append_and_read(spark, sf_dir):
    """Append to the partitioned audit table, then read it with its schema."""
    path = work_path(spark, "audit")
    append_audit(audit_table(spark, sf_dir), path)
    return read_audit(spark, path)


def _day_summaries(spark, sf_dir):
    """Summaries of all days, the last ones written again when they are whole."""
    path = work_path(spark, "audit-days")
    rows = audit_table(spark, sf_dir)
    summaries.write_day_summaries(rows.where("timestamp < '2024-01-10 12:00:00'"), path)
    summaries.write_day_summaries(rows.where("timestamp >= '2024-01-10 00:00:00'"), path)
    return summaries.read_days(spark, path, START, END)


@query("audit_summary_merged", f"""
WITH {AUDIT_CTE} SELECT count(*) AS total_eventos, count(*) FILTER (WHERE risk_level = 'HIGH') AS eventos_risco_alto,
  round(count(*) FILTER (WHERE compliance_status = 'LGPD_OK') / count(*) * 100, 2) AS taxa_conformidade_lgpd,
  true AS usuarios_dentro_do_erro FROM p""")
def audit_summary_merged(spark, sf_dir):
    """The report's totals from day summaries; users within three standard errors."""
    merged = summaries.merged_summary(_day_summaries(spark, sf_dir))
    exact = _report(spark, sf_dir)["resumo"].select("usuarios_ativos").scalar()
    near = F.abs(F.col("usuarios_ativos") - exact) <= 3 * 1.04 / 2 ** (summaries.HLL_BITS / 2) * exact
    return merged.withColumn("usuarios_dentro_do_erro", near).drop("usuarios_ativos")


@query("audit_action_counts_merged", f"WITH {AUDIT_CTE} SELECT action AS item, count(*) AS n FROM p GROUP BY 1")
def audit_action_counts_merged(spark, sf_dir):
    return summaries.merged_top(_day_summaries(spark, sf_dir), "acoes", 10)
