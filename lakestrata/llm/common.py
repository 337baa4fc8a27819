"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakestrata.settings import cut_lineage

# Rows of one Arrow batch: long texts must fit into a worker's memory.
BATCH_ROWS = 500

__all__ = ["cut_lineage", "crc32_of", "mix64", "prepare", "record_batch", "table", "text_of", "utf32"]


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, unless the session already asks for smaller ones."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a NULL one as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))


def crc32_of(column: str) -> Column:
    """CRC-32 of a value written as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def record_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[field.name], type=field.type) for field in schema], schema=schema
    )


def mix64(values: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the bits of 64-bit hashes."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def utf32(text: str) -> np.ndarray:
    """Code points of a text; lone surrogates pass."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def pylist(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


Batches = Iterator[pa.RecordBatch]
