"""Micro-batches as folders: rows and counters that outlive the query.

``write_batch`` writes the rows of one micro-batch under its id and then one
row of counters, which publishes them. The engine repeats a batch that did not
finish, with the same id and the same input, and the repetition replaces both
folders: a query killed between the two writes loses and doubles nothing.
Counters are read from that table, not from the query's progress, of which
only the latest entries are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

KEPT, REPEATED, LATE = "kept", "repeated", "late"


def _rows(root: str) -> str:
    return f"{root}/rows"


def _counters(root: str) -> str:
    return f"{root}/counters"


def write_batch(
    batch: DataFrame, root: str, batch_id: int, counters: Sequence[Column],
    shape: Callable[[DataFrame], DataFrame] = lambda df: df, partition_by: Sequence[str] = (),
) -> dict:
    """Write ``shape(batch)`` and then the ``counters`` of the whole batch.

    The counters are observed while the rows are written, so the input is read
    once.
    """
    spark = batch.sparkSession
    seen = Observation(f"batch {batch_id}")
    writer = shape(batch.observe(seen, *counters)).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{_rows(root)}/batch_id={batch_id}")
    counted = seen.get
    row = spark.createDataFrame([counted], batch.agg(*counters).schema).coalesce(1)
    row.write.mode("overwrite").parquet(f"{_counters(root)}/batch_id={batch_id}")
    return counted


def start(
    stream: DataFrame, one_batch: Callable[[DataFrame, int], None], checkpoint: str,
    available_now: bool = True, interval: str = "1 minute", mode: str = "append",
) -> StreamingQuery:
    """One query for all of ``one_batch``'s outputs.

    ``available_now`` drains what is there and stops; otherwise micro-batches
    run every ``interval``.
    """
    writer = stream.writeStream.foreachBatch(one_batch).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def _existing(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``; None where there is none yet."""
    try:
        reader = spark.read
        return (reader.schema(schema) if schema else reader).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_counters(spark: SparkSession, root: str) -> DataFrame | None:
    """One row per published batch: its id and counters; None before the first."""
    return _existing(spark, _counters(root))


def last_batch(spark: SparkSession, root: str) -> int:
    """The id of the last published batch, -1 before the first."""
    counters = read_counters(spark, root)
    return -1 if counters is None else counters.agg(F.coalesce(F.max("batch_id"), F.lit(-1)).alias("b")).first()["b"]


def totals(spark: SparkSession, root: str, names: Sequence[str], after: int = -1) -> dict[str, int]:
    """Sums of the named counters over all batches after ``after``."""
    counters = read_counters(spark, root)
    if counters is None:
        return dict.fromkeys(names, 0)
    sums = counters.where(F.col("batch_id") > after).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    return sums.first().asDict()


def read_rows(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The rows of all published batches with their ``batch_id``; None before
    the first. Rows of a batch that is still being written are not among them."""
    rows, counters = _existing(spark, _rows(root), schema), read_counters(spark, root)
    if rows is None or counters is None:
        return None
    return rows.join(counters.select("batch_id"), "batch_id", "left_semi")


# --- late and repeated events -------------------------------------------------

EVENT_COUNTERS = ("consumed", "kept", "repeated", "late")


def _identity(events: DataFrame, keys: Sequence[str]) -> Column:
    """Digest of the key; of the whole row where a key column is NULL."""
    unknown = F.lit(False)
    for key in keys:
        unknown |= F.col(key).isNull()
    return F.sha2(F.when(unknown, F.to_json(F.struct(*events.columns))).otherwise(F.to_json(F.struct(*keys))), 256)


def classify_batch(
    events: DataFrame, batch_id: int, root: str, keys: Sequence[str], event_time: str, delay: str,
) -> DataFrame:
    """One micro-batch as rows of outcome, copies, key, event_time and event.

    The watermark is the latest event time of all earlier batches less
    ``delay``. An event before it is ``late`` and stays a row of its own. Of
    the others each key's first one is ``kept`` unless it was kept by an
    earlier batch, within the watermark: then it is ``repeated``. ``copies``
    counts the events a row stands for, so that nothing goes uncounted. Copies
    are merged within tasks first, so one key may hold most of a batch. An
    event without time is never late and is known in its own batch only; one
    with NULL in its key is known by the whole row.
    """
    spark = events.sparkSession
    counters = read_counters(spark, root)
    earlier = None if counters is None else counters.where(F.col("batch_id") < batch_id)
    watermark = None
    if earlier is not None:
        # One row per batch was read: a single time comes back.
        watermark = earlier.agg((F.max("latest") - F.expr(f"INTERVAL {delay}")).alias("w")).first()["w"]
    event = F.struct(*events.columns)
    typed = events.select(
        _identity(events, keys).alias("key"), F.col(event_time).cast("timestamp_ntz").alias("event_time"), event.alias("event")
    )
    is_late = F.lit(False) if watermark is None else F.coalesce(F.col("event_time") < F.lit(watermark).cast("timestamp_ntz"), F.lit(False))
    marked = typed.withColumn("late", is_late)
    late = marked.where("late").select(F.lit(LATE).alias("outcome"), F.lit(1).cast("long").alias("copies"), "key", "event_time", "event")
    first = (
        marked.where("NOT late").groupBy("key")
        .agg(F.min(F.struct("event_time", "event")).alias("first"), F.count(F.lit(1)).alias("copies"))
        .select("key", "first.event_time", "first.event", "copies")
    )
    seen = None if watermark is None else read_rows(spark, root)
    if seen is None:
        known = first.withColumn("outcome", F.lit(KEPT))
    else:
        # Batches that ended before the watermark hold no live key.
        now = F.lit(watermark).cast("timestamp_ntz")
        live = earlier.where(F.col("latest") >= now).select("batch_id")
        alive = (
            seen.where((F.col("batch_id") < batch_id) & (F.col("outcome") == KEPT) & (F.col("event_time") >= now))
            .join(live, "batch_id", "left_semi").select("key").distinct().withColumn("known", F.lit(True))
        )
        known = first.join(alive, "key", "left").withColumn(
            "outcome", F.when(F.col("known"), F.lit(REPEATED)).otherwise(F.lit(KEPT))
        )
    return known.select("outcome", "copies", "key", "event_time", "event").unionByName(late)


def deduplicate_stream(
    events: DataFrame, root: str, checkpoint: str, keys: Sequence[str], event_time: str, delay: str = "10 minutes",
) -> StreamingQuery:
    """Keep each event once and late ones apart; every event is counted as
    kept, repeated or late. The state is the table itself, as far as the
    watermark has not passed it."""
    counters = [
        F.coalesce(F.sum("copies"), F.lit(0)).alias("consumed"),
        F.count_if(F.col("outcome") == KEPT).alias("kept"),
        F.coalesce(
            F.sum(F.when(F.col("outcome") == KEPT, F.col("copies") - 1).when(F.col("outcome") == REPEATED, F.col("copies"))), F.lit(0)
        ).alias("repeated"),
        F.count_if(F.col("outcome") == LATE).alias("late"),
        F.max("event_time").alias("latest"),
    ]

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        rows = classify_batch(batch, batch_id, root, keys, event_time, delay)
        write_batch(rows, root, batch_id, counters, partition_by=["outcome"])

    return start(events, one_batch, checkpoint)


def read_events(spark: SparkSession, root: str, outcome: str) -> DataFrame | None:
    """The events of one outcome; repeated copies within a batch are counted,
    not kept."""
    rows = read_rows(spark, root)
    return None if rows is None else rows.where(F.col("outcome") == outcome).select("event.*")
