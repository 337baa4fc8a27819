"""Object inventory: listing, totals, verification and hot/cold split."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata import constants as K
from lakestrata.functions.text import as_mb
from lakestrata.operators.filters import split_by_age


def list_objects(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, length, modificationTime) of all files below a path; contents
    are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", F.col("modificationTime").cast("timestamp_ntz"))


def inventory_summary(inventory: DataFrame) -> DataFrame:
    """One row: (objects, bytes, mb)."""
    return inventory.agg(
        F.count(F.lit(1)).alias("objects"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    ).withColumn("mb", as_mb(F.col("bytes")))


def verify_objects(inventory: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected paths with status ``OK`` or ``NOT_FOUND`` and size in MB."""
    found = inventory.select("path", F.col("length").alias("_length"))
    return expected.join(found, "path", "left").select(
        *expected.columns,
        F.when(F.col("_length").isNull(), F.lit("NOT_FOUND")).otherwise(F.lit("OK")).alias("status"),
        as_mb(F.col("_length")).alias("size_mb"),
    )


def split_inventory(
    inventory: DataFrame, days: int = K.HOT_DAYS, *, as_of: datetime | str
) -> tuple[DataFrame, DataFrame]:
    """(hot, cold) objects by last modification."""
    return split_by_age(inventory, "modificationTime", days, as_of=as_of)
