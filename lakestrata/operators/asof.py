"""As-of join: each row with the last reading at or before its time.

Both sides are put into one table and sorted once within a key and time bucket;
the last reading of earlier buckets is carried over by a table of one row per
key and bucket. So a key that holds most of the rows is spread over its
buckets, and no task sorts a whole key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def asof_join(
    rows: DataFrame, readings: DataFrame, on: Sequence[str], row_time: str, reading_time: str,
    values: Sequence[str], bucket_seconds: int = 86_400, strict: bool = False,
) -> DataFrame:
    """``rows`` with ``reading_time`` and ``values`` of the last reading of the
    same key at or before ``row_time`` (before it, if ``strict``).

    Rows without such a reading, without key or without time get NULLs; every
    row comes back once. Of several readings at one time the one with the
    largest values counts. Choose buckets so that one key and bucket fits a
    task.
    """
    clash = set(rows.columns) & {reading_time, *values}
    if clash:
        raise ValueError(f"rows already have columns {', '.join(sorted(clash))}")
    if bucket_seconds < 1:
        raise ValueError("a bucket has at least one second")
    on = list(on)
    carried = [reading_time, *values]

    def side(df: DataFrame, time: str, row, reading, is_row: bool) -> DataFrame:
        at = F.col(time).cast("timestamp_ntz")
        seconds = F.unix_micros(at.cast("timestamp")) / F.lit(1_000_000)
        return df.select(
            *on, at.alias("_at"), F.floor(seconds / F.lit(bucket_seconds)).cast("long").alias("_bucket"),
            row.alias("_row"), reading.alias("_reading"), F.lit(is_row).alias("_is_row"),
        )

    own = F.struct(*[F.col(c) for c in rows.columns])
    reading = F.struct(*[F.col(c) for c in carried])
    row_type, reading_type = rows.select(own.alias("x")).schema["x"].dataType, readings.select(reading.alias("x")).schema["x"].dataType
    complete = F.lit(True)
    for c in on:
        complete &= F.col(c).isNotNull()
    left = side(rows, row_time, own, F.lit(None).cast(reading_type), True)
    joinable = complete & F.col("_at").isNotNull()
    right = side(readings, reading_time, F.lit(None).cast(row_type), reading, False).where(joinable)

    # Strictly earlier: at one time the rows come first.
    first = F.col("_is_row").cast("int") if not strict else -F.col("_is_row").cast("int")
    within = Window.partitionBy(*on, "_bucket").orderBy("_at", first, "_reading").rowsBetween(Window.unboundedPreceding, 0)
    both = left.where(joinable).unionByName(right)
    met = both.withColumn("_last", F.last("_reading", ignorenulls=True).over(within)).where("_is_row")

    # One row per key and bucket that has readings or rows.
    last = right.groupBy(*on, "_bucket").agg(F.max(F.struct("_at", "_reading")).alias("_final"))
    asked = left.where(joinable).select(*on, "_bucket").distinct()
    earlier = Window.partitionBy(*on).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        asked.join(last, [*on, "_bucket"], "full")
        .withColumn("_before", F.last("_final", ignorenulls=True).over(earlier)["_reading"]).select(*on, "_bucket", "_before")
    )
    found = met.join(before, [*on, "_bucket"], "left").select("_row", F.coalesce("_last", "_before").alias("_reading"))
    alone = left.where(~joinable).select("_row", "_reading")
    return found.unionByName(alone).select(
        *[F.col("_row")[c].alias(c) for c in rows.columns], *[F.col("_reading")[c].alias(c) for c in carried]
    )
