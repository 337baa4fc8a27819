"""Monitor-log and audit-table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata import schemas
from lakestrata.functions.text import before_first

LOG_TIME = "yyyy-MM-dd HH:mm:ss"


def parse_monitor_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Structured log events; lines without a leading timestamp are skipped.

    Line form: ``2025-06-10 10:30:00,123 - NAME - LEVEL - EVENT: TYPE - message
    - Details: {json}``. Columns: log_time, logger, level, event_type, message,
    details, line.
    """
    line = F.col(column)
    parts = F.split(line, " - ", 5)
    time = F.try_to_timestamp(before_first(F.get(parts, F.lit(0)), ","), F.lit(LOG_TIME))
    event, body = F.get(parts, F.lit(3)), F.get(parts, F.lit(4))
    mark = " - Details: "
    return lines.select(
        time.cast("timestamp_ntz").alias("log_time"),
        F.get(parts, F.lit(1)).alias("logger"),
        F.get(parts, F.lit(2)).alias("level"),
        F.when(event.startswith("EVENT: "), F.substring_index(event, "EVENT: ", -1)).alias("event_type"),
        F.substring_index(body, mark, 1).alias("message"),
        F.when(body.contains(mark), F.substring_index(body, mark, -1)).alias("details"),
        line.alias("line"),
    ).where("log_time is not null")


def read_monitor_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_monitor_log(spark.read.text(path))


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The audit table; timestamps carry no zone. Its date partition prunes."""
    return spark.read.parquet(path).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.AUDIT], "event_date"
    )
