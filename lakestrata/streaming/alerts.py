"""Activity and threshold alerts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from lakestrata.functions.text import classify
from lakestrata.functions.time import ntz
from lakestrata.streaming import batches


def unusual_activity(
    log: DataFrame,
    activity: str,
    threshold: int = 3,
    minutes: int = 5,
    *,
    as_of: datetime | str,
    time_column: str = "log_time",
    text_column: str = "line",
) -> DataFrame:
    """One row (activity_type, occurrences, unusual): matching events strictly
    younger than ``minutes``. Matching is a case-sensitive substring."""
    recent = F.col(time_column) > ntz(as_of) - F.make_interval(mins=F.lit(minutes))
    matching = log.where(recent & F.col(text_column).contains(activity))
    return matching.agg(F.count(F.lit(1)).alias("occurrences")).select(
        F.lit(activity).alias("activity_type"), "occurrences", (F.col("occurrences") >= threshold).alias("unusual")
    )


def recent_activity_sample(
    log: DataFrame, activity: str, minutes: int = 5, n: int = 5, *, as_of: datetime | str,
    time_column: str = "log_time", text_column: str = "line",
) -> DataFrame:
    """The first ``n`` matching events of the window, for the alert's text."""
    recent = F.col(time_column) > ntz(as_of) - F.make_interval(mins=F.lit(minutes))
    return log.where(recent & F.col(text_column).contains(activity)).orderBy(time_column, text_column).limit(n)


def activity_windows(
    events: DataFrame,
    time_column: str,
    type_column: str,
    threshold: int = 3,
    window: str = "5 minutes",
    slide: str = "1 minute",
    delay: str | None = None,
) -> DataFrame:
    """Sliding windows with at least ``threshold`` events of one type.

    Works on batch and stream; a stream needs ``delay``, the watermark after
    which a window is final. Counting is partial per task, so a type with most
    of the events does not concentrate on one.
    """
    counted = _counted_windows(events, time_column, type_column, window, slide, delay)
    return counted.where(F.col("occurrences") >= threshold)


def _counted_windows(
    events: DataFrame, time_column: str, type_column: str, window: str, slide: str, delay: str | None
) -> DataFrame:
    if isinstance(events.schema[time_column].dataType, T.TimestampNTZType):
        events = events.withColumn(time_column, F.col(time_column).cast("timestamp"))
    if delay:
        events = events.withWatermark(time_column, delay)
    counted = events.groupBy(F.window(time_column, window, slide), F.col(type_column)).agg(
        F.count(F.lit(1)).alias("occurrences")
    )
    return counted.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        F.col(type_column).alias("activity_type"),
        "occurrences",
    )


def follow_activity_windows(
    events: DataFrame, root: str, checkpoint: str, time_column: str, type_column: str,
    window: str = "5 minutes", slide: str = "1 minute", delay: str = "10 minutes", available_now: bool = True,
) -> StreamingQuery:
    """Write the counts of a stream's windows whenever they change, so that
    windows the watermark has not passed yet are known too."""
    counted = _counted_windows(events, time_column, type_column, window, slide, delay)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        batches.write_batch(batch, root, batch_id, [F.count(F.lit(1)).alias("changed")])

    return batches.start(counted, one_batch, checkpoint, available_now, mode="update")


def read_activity_windows(spark: SparkSession, root: str, threshold: int = 3) -> DataFrame | None:
    """The windows with at least ``threshold`` events, open ones included, by
    their latest counts."""
    rows = batches.read_rows(spark, root)
    if rows is None:
        return None
    latest = rows.groupBy("window_start", "window_end", "activity_type").agg(F.max_by("occurrences", "batch_id").alias("occurrences"))
    return latest.where(F.col("occurrences") >= threshold)


def threshold_alert(
    metrics: DataFrame, metric: str, limit: float | Column, alert_percentage: float = 80.0, status: str = "status"
) -> DataFrame:
    """Add EXCEEDED (> limit), HIGH (> percentage of the limit) or OK."""
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    high = limit * F.lit(alert_percentage / 100.0)
    label = classify(F.col(metric), [limit, high], ["EXCEEDED", "HIGH"], "OK")
    return metrics.withColumn(status, label)
