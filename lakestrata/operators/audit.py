"""Audit rows and reports over the 12-column audit table.

Builders are column expressions over a DataFrame of happenings, so a batch of
any size is one narrow pass.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata import constants as K, schemas
from lakestrata.functions.text import as_json, percent, prefixed_upper
from lakestrata.operators.filters import between_ts, drop_if_present, filter_in, filter_not_equal, last_days
from lakestrata.operators.ranking import top_k_values
from lakestrata.operators.aggregates import value_counts


def _rows(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """The 12 audit columns: given values first, then defaults."""
    level = F.upper(values["level"])
    defaults = {name: F.lit(value) for name, value in K.AUDIT_DEFAULTS.items()}
    defaults |= {"risk_level": level, "stack_trace_needed": F.lit(False)}
    out = []
    for field in schemas.AUDIT:
        if field.name == "level":
            col = level
        elif field.name in values and field.name in defaults:
            col = F.coalesce(values[field.name], defaults[field.name])
        else:
            col = values.get(field.name, defaults.get(field.name))
        out.append(col.cast(field.dataType).alias(field.name))
    return df.select(*out)


def audit_rows(events: DataFrame, preset: bool = False) -> DataFrame:
    """Audit rows for events (timestamp, level, message, and any audit column).

    Missing columns and NULLs take the defaults. With ``preset`` the level
    picks the default action, compliance status and risk (info, warning and
    error records).
    """
    values = {c: F.col(c) for c in events.columns if c in schemas.AUDIT_COLUMNS}
    values["details"] = F.col("message")
    if preset:
        level = F.upper(F.col("level"))
        for position, name in enumerate(["action", "compliance_status", "risk_level"]):
            chosen = None
            for key, defaults in K.AUDIT_PRESETS.items():
                default = F.lit(defaults[position]) if defaults[position] else level
                chosen = F.when(level == key, default) if chosen is None else chosen.when(level == key, default)
            values[name] = F.coalesce(values[name], chosen) if name in values else chosen
    return _rows(events, values)


def audit_operations(operations: DataFrame) -> DataFrame:
    """Rows for pipeline operations (timestamp, dag_id, task_id, operation, metadata JSON text)."""
    details = F.concat(
        F.lit(K.OPERATION_TEXT), F.col("operation"),
        F.coalesce(F.concat(F.lit(K.METADATA_TEXT), F.col("metadata")), F.lit("")),
    )
    values = {c: F.col(c) for c in ("timestamp", "dag_id", "task_id", "user") if c in operations.columns}
    return _rows(operations, values | {
        "level": F.lit("INFO"),
        "action": prefixed_upper(F.col("operation")),
        "details": details,
        "compliance_status": F.lit("LGPD_OK"),
    })


def audit_incidents(incidents: DataFrame) -> DataFrame:
    """Rows for incidents (timestamp, severity, error, optional dag_id, task_id, user, service, stack_trace)."""
    severity = F.upper(F.col("severity"))
    given = {c: F.col(c) for c in ("timestamp", "dag_id", "task_id", "user", "service") if c in incidents.columns}
    fallback = {
        "dag_id": "N/A", "task_id": "N/A", "user": K.INCIDENT_USER, "service": K.INCIDENT_SERVICE,
    }
    values = given | {
        name: F.coalesce(given[name], F.lit(text)) if name in given else F.lit(text)
        for name, text in fallback.items()
    }
    if "stack_trace" in incidents.columns:
        values["stack_trace_needed"] = F.col("stack_trace")
    return _rows(incidents, values | {
        "level": severity,
        "action": F.lit("SECURITY_INCIDENT"),
        "details": F.concat(F.lit(K.INCIDENT_TEXT), F.coalesce(F.col("error"), F.lit(""))),
        "compliance_status": F.when(severity.isin(K.BREACH_SEVERITIES), F.lit("LGPD_BREACH")).otherwise(
            F.lit("LGPD_WARNING")
        ),
        "risk_level": severity,
        "error_message": F.col("error"),
    })


def audit_transfers(moves: DataFrame) -> DataFrame:
    """Rows for moved objects (timestamp, object_key, source, destination).

    Without an object key the row is an upload of a local file, with one it is
    a transfer between buckets.
    """
    is_upload = F.col("object_key").isNull()
    upload = F.format_string(K.UPLOAD_TEXT, "source", "destination")
    transfer = F.format_string(K.TRANSFER_TEXT, "object_key", "source", "destination")
    values = {c: F.col(c) for c in ("timestamp", "user") if c in moves.columns}
    for name in ("dag_id", "task_id"):
        values[name] = F.coalesce(F.col(name), F.lit("N/A")) if name in moves.columns else F.lit("N/A")
    return _rows(moves, values | {
        "level": F.lit("INFO"),
        "action": F.when(is_upload, F.lit("FILE_UPLOAD")).otherwise(F.lit("OBJECT_TRANSFER")),
        "details": F.when(is_upload, upload).otherwise(transfer),
        "compliance_status": F.lit("LGPD_OK"),
        "service": F.when(is_upload, F.lit(K.UPLOAD_SERVICE)).otherwise(F.lit(K.TRANSFER_SERVICE)),
    })


def audit_validations(results: DataFrame, source: str, as_of: datetime | str) -> DataFrame:
    """One audit row for a rule-suite result (one row per rule)."""
    totals = results.agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if(F.col("success")).alias("successful"),
        F.sort_array(F.collect_set(F.when(~F.col("success"), F.col("rule_type")))).alias("failed_rules"),
    )
    passed = F.col("evaluated") == F.col("successful")

    def pick(yes: str, no: str) -> Column:
        return F.when(passed, F.lit(yes)).otherwise(F.lit(no))

    details = as_json(
        passed.alias("success"), F.col("evaluated"), F.col("successful"), F.col("failed_rules"),
        F.lit(source).alias("source"),
    )
    return _rows(totals, {
        "timestamp": F.lit(str(as_of)),
        "level": pick("INFO", "ERROR"),
        "action": pick("VALIDATION_SUCCESS", "VALIDATION_FAILURE"),
        "details": details,
        "compliance_status": pick("LGPD_OK", "LGPD_VIOLATION"),
        "risk_level": pick("LOW", "HIGH"),
        "service": F.lit(K.VALIDATION_SERVICE),
    })


# Reports ---------------------------------------------------------------------

def audit_summary(period: DataFrame) -> DataFrame:
    """One row of totals for a period, all in one scan."""
    return period.agg(
        F.count(F.lit(1)).alias("total_eventos"),
        F.count_if(F.col("compliance_status") == "LGPD_OK").alias("eventos_ok"),
        F.count_if(F.col("risk_level") == "HIGH").alias("eventos_risco_alto"),
        F.count_distinct("user").alias("usuarios_ativos"),
    ).withColumn("taxa_conformidade_lgpd", percent(F.col("eventos_ok"), F.col("total_eventos"))).drop("eventos_ok")


def _day_column(audit: DataFrame) -> str | None:
    return "event_date" if "event_date" in audit.columns else None


def audit_report(audit: DataFrame, start: datetime | str, end: datetime | str) -> dict[str, DataFrame]:
    """The report of a closed period as named DataFrames.

    On the stored audit table only the period's days are read.
    """
    period = between_ts(audit, "timestamp", start, end, _day_column(audit)).drop("event_date")
    return {
        "resumo": audit_summary(period),
        "distribuicao_acoes": value_counts(period, "action"),
        "principais_violacoes": top_k_values(
            filter_not_equal(period, "compliance_status", "LGPD_OK"), "details", 5
        ),
        "detalhes_eventos_criticos": filter_in(period, "level", ["ERROR", "CRITICAL"]),
        "autoridade": authority_report(period),
    }


def audit_last_days(audit: DataFrame, days: int = 7, *, as_of: datetime | str) -> DataFrame:
    return last_days(audit, "timestamp", days, as_of, _day_column(audit))


def authority_report(audit: DataFrame) -> DataFrame:
    """The audit rows without the columns authorities do not need."""
    return drop_if_present(audit, K.AUTHORITY_DROPPED)
