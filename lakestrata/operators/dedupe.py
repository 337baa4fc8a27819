"""Keep-first deduplication and gap-free sequence numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakestrata.settings import cut_lineage


# Rows that one task of ``with_sequence`` sorts.
SEQUENCE_ROWS = 2_000_000


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key under an explicit order.

    The filter on ``row_number`` lets Spark keep one row per key and task
    before the shuffle, so a hot key moves at most one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def with_sequence(
    df: DataFrame, order: Sequence[str | Column], column: str = "event_sequence_id", partitions: int | None = None
) -> DataFrame:
    """Number all rows 1..n in ``order`` without a single-task window.

    Rows are range-partitioned and sorted by the whole order once; the row's
    place inside its partition is written with it, and shifted by the rows in
    the partitions before. The table is moved once and read back once. Unless
    given, the number of partitions grows with the rows, which are counted.
    """
    if not partitions:
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        partitions = max(least, -(-df.count() // SEQUENCE_ROWS))
    ranged = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    # The id holds the partition above bit 33 and the row number below it.
    placed = ranged.withColumn("_id", F.monotonically_increasing_id())
    placed = cut_lineage(placed, "sequence").withColumns({
        "_part": F.shiftright("_id", 33), "_local": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range partition: bounded by ``partitions``.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(column, F.col("_offset") + F.col("_local") + 1)
        .drop("_id", "_part", "_local", "_offset")
    )
