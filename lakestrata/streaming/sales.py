"""Sales-event stream: one transform for batch and stream, exactly-once sink."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from lakestrata import constants as K, schemas
from lakestrata.functions.text import default_text, safe_number
from lakestrata.functions.time import ntz
from lakestrata.operators.audit import audit_rows
from lakestrata.operators.filters import above
from lakestrata.streaming import batches


def check_columns(columns: Sequence[str], required: Sequence[str] = schemas.SALES_REQUIRED) -> None:
    missing = [c for c in required if c not in columns]
    if missing:
        raise ValueError(f"event feed lacks {', '.join(missing)}")


def read_event_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str = schemas.SALES_EVENT,
    fmt: str = "parquet",
    pattern: str | None = None,
    max_files: int | None = None,
    required: Sequence[str] = schemas.SALES_REQUIRED,
) -> DataFrame:
    """File stream with a declared schema that must hold the required columns."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    check_columns(schema.fieldNames(), required)
    reader = spark.readStream.format(fmt).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def _price() -> Column:
    return F.coalesce(F.col("price").cast("string"), F.lit("0"))


def transform_sales(
    events: DataFrame, as_of: datetime | str | None = None, minimum: float = K.MIN_PRICE
) -> DataFrame:
    """Events with a price above the minimum: customer_state, price, timestamp,
    processed_at. Unreadable prices, NaN and missing prices drop out."""
    priced = events.withColumn("_price", safe_number(_price()))
    return priced.where(above(F.col("_price"), minimum)).select(*_sale(F.col("_price"), as_of))


def _sale(price: Column, as_of: datetime | str | None) -> list[Column]:
    now = F.localtimestamp() if as_of is None else ntz(as_of)
    return [
        default_text(F.col("customer_state"), K.UNKNOWN_STATE).alias("customer_state"),
        price.alias("price"),
        F.coalesce(F.col("timestamp").cast("string"), now.cast("string")).alias("timestamp"),
        now.alias("processed_at"),
    ]


def is_invalid() -> Column:
    """The price is present but no number."""
    return safe_number(_price()).isNull()


def split_invalid(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) events by price; both are plain filters."""
    return events.where(~is_invalid()), events.where(is_invalid())


def sales_audit(events: DataFrame, as_of: datetime | str, minimum: float = K.MIN_PRICE) -> DataFrame:
    """One audit row per event: processed, skipped by the rule, or invalid."""
    price = safe_number(_price())
    shown = F.format_string("%.2f", price)
    state = default_text(F.col("customer_state"), K.UNKNOWN_STATE)
    good = above(price, minimum)

    def pick(invalid: str | Column, processed: str | Column, skipped: str | Column) -> Column:
        parts = [p if isinstance(p, Column) else F.lit(p) for p in (invalid, processed, skipped)]
        return F.when(is_invalid(), parts[0]).when(good, parts[1]).otherwise(parts[2])

    return audit_rows(events.select(
        ntz(as_of).alias("timestamp"),
        pick("WARNING", "INFO", "INFO").alias("level"),
        pick("STREAM_EVENT_INVALID_PRICE", "STREAM_EVENT_PROCESSED", "STREAM_EVENT_SKIPPED_RULE").alias("action"),
        pick("LGPD_WARNING", "LGPD_PROCESSED", "LGPD_NA").alias("compliance_status"),
        pick("MEDIUM", "INFO", "INFO").alias("risk_level"),
        pick(
            F.format_string(K.INVALID_PRICE_TEXT, F.col("price").cast("string")),
            F.format_string(K.PROCESSED_TEXT, state, shown),
            F.format_string(K.SKIPPED_TEXT, F.lit(str(minimum)), shown),
        ).alias("message"),
    ))


def stream_counts(events: DataFrame, minimum: float = K.MIN_PRICE) -> list[Column]:
    """Aggregates consumed / processed / skipped / invalid."""
    price = safe_number(_price())
    return [
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(above(price, minimum)).alias("processed"),
        F.count_if(~is_invalid() & ~above(price, minimum)).alias("skipped"),
        F.count_if(is_invalid()).alias("invalid"),
    ]


def dedupe_stream(events: DataFrame, keys: Sequence[str], event_time: str, delay: str = "10 minutes") -> DataFrame:
    """Drop re-delivered events within the watermark; state stays bounded."""
    if isinstance(events.schema[event_time].dataType, T.TimestampNTZType):
        events = events.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def write_stream_partitioned(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: str | None = "event_date",
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Exactly-once Parquet sink by event date.

    ``available_now`` drains what is there and stops; otherwise micro-batches
    run every ``interval``.
    """
    if partition_by == "event_date" and "event_date" not in stream.columns:
        stream = stream.withColumn("event_date", F.to_date(F.col("timestamp").try_cast("timestamp_ntz")))
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start(path)


PROCESSED, INVALID, SKIPPED = "processed", "invalid", "skipped"


def classify_sales(events: DataFrame, as_of: datetime | str | None = None, minimum: float = K.MIN_PRICE) -> DataFrame:
    """Each event's outcome, with the ``sale`` of a processed event and the
    ``event`` itself of an invalid one."""
    whole = F.struct(*events.columns)
    good = above(safe_number(_price()), minimum)
    outcome = F.when(is_invalid(), F.lit(INVALID)).when(good, F.lit(PROCESSED)).otherwise(F.lit(SKIPPED))
    sale = F.when(F.col("outcome") == PROCESSED, F.struct(*_sale(safe_number(_price()), as_of)))
    marked = events.withColumn("outcome", outcome)
    return marked.select(
        "outcome", F.to_date(F.col("timestamp").cast("string").try_cast("timestamp_ntz")).alias("event_date"),
        sale.alias("sale"), F.when(F.col("outcome") == INVALID, whole).alias("event"),
    )


def process_sales_stream(
    events: DataFrame, root: str, checkpoint: str, as_of: datetime | str | None = None, available_now: bool = True
) -> StreamingQuery:
    """Processed sales and invalid events of a stream, read once and written
    batch by batch under ``root`` with the batch's counters."""

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        batches.write_batch(
            batch, root, batch_id, stream_counts(batch),
            lambda df: classify_sales(df, as_of).where(F.col("outcome") != SKIPPED), ["outcome"],
        )

    return batches.start(events, one_batch, checkpoint, available_now)


def read_processed(spark: SparkSession, root: str) -> DataFrame | None:
    """The sales of all published batches, with their event date."""
    rows = batches.read_rows(spark, root)
    return None if rows is None else rows.where(F.col("outcome") == PROCESSED).select("sale.*", "event_date")


def read_invalid(spark: SparkSession, root: str) -> DataFrame | None:
    """The invalid events of all published batches, as they came."""
    rows = batches.read_rows(spark, root)
    return None if rows is None else rows.where(F.col("outcome") == INVALID).select("event.*")
