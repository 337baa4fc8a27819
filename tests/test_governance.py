"""Audit, feeds, logs, inventory."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lakestrata import schemas
from lakestrata.operators import audit, quality
from lakestrata.sinks.files import append_audit
from lakestrata.sources import feeds, inventory
from lakestrata.sources.logs import parse_monitor_log, read_audit, read_monitor_log


def first(df):
    return df.first().asDict()


def events(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def test_defaults(spark):
    row = first(audit.audit_rows(events(spark, [("2024-01-01", "info", "hello")], "timestamp string, level string, message string")))
    assert row | {"timestamp": None} == {
        "timestamp": None, "level": "INFO", "dag_id": "system", "task_id": "system", "user": "airflow_process",
        "action": "GENERIC_EVENT", "details": "hello", "compliance_status": "LGPD_NA", "risk_level": "INFO",
        "service": "N/A", "error_message": "", "stack_trace_needed": False,
    }


@pytest.mark.parametrize("level,want", [
    ("info", ("INFO_EVENT", "LGPD_OK", "INFO")),
    ("warning", ("WARNING_EVENT", "LGPD_WARNING", "MEDIUM")),
    ("error", ("ERROR_EVENT", "LGPD_BREACH", "HIGH")),
    ("critical", ("GENERIC_EVENT", "LGPD_NA", "CRITICAL")),
])
def test_presets(spark, level, want):
    df = events(spark, [("2024-01-01", level, "m", None)], "timestamp string, level string, message string, action string")
    row = first(audit.audit_rows(df, preset=True))
    assert (row["action"], row["compliance_status"], row["risk_level"]) == want
    given = first(audit.audit_rows(df.withColumn("action", F.lit("MINE")), preset=True))
    assert given["action"] == "MINE"


@pytest.mark.parametrize("severity,status", [("urgent", "LGPD_BREACH"), ("HIGH", "LGPD_BREACH"), ("medium", "LGPD_WARNING")])
def test_incidents(spark, severity, status):
    row = first(audit.audit_incidents(events(spark, [("2024-01-01", severity, "boom")], "timestamp string, severity string, error string")))
    assert (row["compliance_status"], row["risk_level"], row["level"]) == (status, severity.upper(), severity.upper())
    assert (row["user"], row["service"], row["dag_id"]) == ("security_system", "SECURITY_SYSTEM", "N/A")
    assert row["details"] == "INCIDENTE DETECTADO: boom" and row["error_message"] == "boom"


def test_operations_and_transfers(spark):
    op = first(audit.audit_operations(events(
        spark, [("2024-01-01", "d", "t", "data_write", '{"n":1}')],
        "timestamp string, dag_id string, task_id string, operation string, metadata string",
    )))
    assert (op["action"], op["details"]) == ("OP_DATA_WRITE", 'Operação: data_write | Metadados: {"n":1}')
    moves = events(
        spark, [("2024-01-01", None, "/tmp/a", "b/a"), ("2024-01-02", "k", "hot", "cold")],
        "timestamp string, object_key string, source string, destination string",
    )
    upload, transfer = [r.asDict() for r in audit.audit_transfers(moves).orderBy("timestamp").collect()]
    assert (upload["action"], upload["details"]) == ("FILE_UPLOAD", "Arquivo enviado de '/tmp/a' para 'b/a'.")
    assert (transfer["action"], transfer["service"]) == ("OBJECT_TRANSFER", "MinIO/S3_Lifecycle")


def test_validation_rows(spark):
    suite = [{"type": "between", "column": "id", "max": 1}, {"type": "not_null", "column": "id"}]
    row = first(audit.audit_validations(quality.validate(spark.range(3), suite), "ids", "2024-01-01 00:00:00"))
    assert (row["action"], row["level"], row["compliance_status"], row["risk_level"]) == (
        "VALIDATION_FAILURE", "ERROR", "LGPD_VIOLATION", "HIGH",
    )
    assert json.loads(row["details"]) == {
        "success": False, "evaluated": 2, "successful": 1, "failed_rules": ["between"], "source": "ids",
    }
    good = first(audit.audit_validations(quality.validate(spark.range(2), suite), "ids", "2024-01-01 00:00:00"))
    assert (good["action"], good["risk_level"], good["compliance_status"]) == ("VALIDATION_SUCCESS", "LOW", "LGPD_OK")


@pytest.fixture(scope="module")
def trail(spark):
    def row(ts, level, user, details, status, risk):
        return (ts, level, "d", "t", user, "ACT", details, status, risk, "N/A", "", False)

    data = [
        row("2024-01-01 00:00:00", "INFO", "u1", "start", "LGPD_OK", "LOW"),
        row("2024-01-31 23:59:59", "ERROR", "u1", "end", "LGPD_BREACH", "HIGH"),
        row("2024-01-10 00:00:00", "CRITICAL", None, "null status", None, "HIGH"),
        row("2024-02-01 00:00:00", "INFO", "u9", "outside", "LGPD_OK", "HIGH"),
    ] + [row("2024-01-15 00:00:00", "INFO", "u2", f"v{i}", "LGPD_WARNING", "LOW") for i in range(5)]
    ddl = ", ".join(f"{f.name} {'string' if f.name == 'timestamp' else f.dataType.simpleString()}" for f in schemas.AUDIT)
    return events(spark, data, ddl)


def test_report(trail):
    report = audit.audit_report(trail, "2024-01-01 00:00:00", "2024-01-31 23:59:59")
    assert first(report["resumo"]) == {
        "total_eventos": 8, "eventos_risco_alto": 2, "usuarios_ativos": 2, "taxa_conformidade_lgpd": 12.5,
    }
    top = [(r["details"], r["n"]) for r in report["principais_violacoes"].collect()]
    assert top == [("end", 1), ("null status", 1), ("v0", 1), ("v1", 1), ("v2", 1)]
    assert {r["details"] for r in report["detalhes_eventos_criticos"].collect()} == {"end", "null status"}
    assert report["autoridade"].columns == [
        "timestamp", "level", "dag_id", "task_id", "action", "details", "compliance_status",
    ]
    empty = audit.audit_report(trail, "2030-01-01 00:00:00", "2030-01-02 00:00:00")
    assert first(empty["resumo"])["taxa_conformidade_lgpd"] == 0.0
    assert audit.audit_last_days(trail, 7, as_of="2024-02-07 23:59:59").count() == 2


def test_audit_table_is_pruned_by_day(spark, trail, tmp_path, capsys):
    path = str(tmp_path / "audit")
    append_audit(trail, path)
    append_audit(trail.limit(0), path)
    back = read_audit(spark, path)
    assert back.drop("event_date").schema.simpleString() == schemas.AUDIT.simpleString() and back.count() == 9
    back.where("event_date = date'2024-01-15'").explain("formatted")
    assert "PartitionFilters: [isnotnull(event_date" in capsys.readouterr().out
    report = audit.audit_report(back, "2024-01-01 00:00:00", "2024-01-31 23:59:59")
    report["resumo"].explain("formatted")
    assert "PartitionFilters: [isnotnull(event_date" in capsys.readouterr().out
    assert first(report["resumo"])["total_eventos"] == 8 and "event_date" not in report["autoridade"].columns
    assert audit.audit_last_days(back, 7, as_of="2024-02-07 23:59:59").count() == 2


GOOD = '{"main":{"temp":21.5,"humidity":60,"pressure":1013},"weather":[{"description":"céu limpo"}],"wind":{"speed":3.2}}'


def test_weather(spark):
    docs = spark.createDataFrame([
        (1, GOOD), (2, GOOD.replace('"wind"', '"other"')), (3, GOOD.replace('[{"description":"céu limpo"}]', "[]")),
        (4, "{broken"), (5, None), (6, GOOD.replace("21.5", '"hot"')),
    ], "id int, json string").select("id", F.lit("SP").alias("cidade"), F.lit("2024-01-01").alias("data_coleta"), "json")
    good, bad = feeds.split_malformed(docs)
    assert [r["id"] for r in good.collect()] == [1]
    assert sorted(r["id"] for r in bad.collect()) == [2, 3, 4, 5, 6]
    assert first(feeds.flatten_weather(good)) == {
        "id": 1, "cidade": "SP", "temperatura": 21.5, "condicao": "céu limpo", "umidade": 60, "pressao": 1013,
        "velocidade_vento": 3.2, "data_coleta": "2024-01-01",
    }
    for variant, fields in feeds.WEATHER_VARIANTS.items():
        assert feeds.flatten_weather(good, variant).columns == ["id", *fields]
    with pytest.raises(KeyError):
        feeds.flatten_weather(good, 6)


def test_indicator(spark, tmp_path):
    (tmp_path / "ipca.json").write_text('[{"data": "01/01/2024", "valor": "0.42"},\n {"data": "01/02/2024", "valor": "0.83"}]')
    assert [tuple(r) for r in feeds.read_indicator(spark, str(tmp_path)).collect()] == [("01/01/2024", "0.42"), ("01/02/2024", "0.83")]
    docs = spark.createDataFrame([('[{"data":"a","valor":"1"},{"data":"b"}]',), ("[]",), ("bad",)], "json string")
    assert [tuple(r) for r in feeds.flatten_indicator(docs).where("data is not null").collect()] == [("a", "1"), ("b", None)]


def test_monitor_log(spark, tmp_path):
    lines = [
        '2025-06-10 10:30:00,123 - SecurityMonitor - INFO - EVENT: LOGIN_FAILURE - bad password - Details: {"user": "x - y"}',
        "2025-06-10 10:31:00,000 - SecurityMonitor - WARNING - EVENT: RESOURCE_ALERT - no details",
        "not a log line - at all", "", "2025-13-45 99:00:00,1 - a - INFO - EVENT: X - y",
    ]
    (tmp_path / "m.log").write_text("\n".join(lines))
    rows = [r.asDict() for r in read_monitor_log(spark, str(tmp_path)).orderBy("log_time").collect()]
    assert len(rows) == 2
    assert (rows[0]["event_type"], rows[0]["message"], rows[0]["details"], rows[0]["level"]) == (
        "LOGIN_FAILURE", "bad password", '{"user": "x - y"}', "INFO",
    )
    assert str(rows[0]["log_time"]) == "2025-06-10 10:30:00"
    assert (rows[1]["message"], rows[1]["details"]) == ("no details", None)
    assert parse_monitor_log(spark.createDataFrame([], "value string")).count() == 0


def test_inventory(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_bytes(b"x" * 1048576)
    (tmp_path / "sub" / "b.csv").write_bytes(b"xy")
    found = inventory.list_objects(spark, str(tmp_path))
    assert found.count() == 2 and inventory.list_objects(spark, str(tmp_path), "a*").count() == 1
    assert first(inventory.inventory_summary(found)) == {"objects": 2, "bytes": 1048578, "mb": 1.0}
    assert first(inventory.inventory_summary(found.where("1 = 0")))["bytes"] == 0
    wanted = found.select("path").unionByName(spark.createDataFrame([("file:/gone",)], "path string"))
    status = {r["path"].rsplit("/", 1)[1]: (r["status"], r["size_mb"]) for r in inventory.verify_objects(found, wanted).collect()}
    assert status == {"a.csv": ("OK", 1.0), "b.csv": ("OK", 0.0), "gone": ("NOT_FOUND", None)}
    hot, cold = inventory.split_inventory(found, as_of="2200-01-01 00:00:00")
    assert (hot.count(), cold.count()) == (0, 2)
