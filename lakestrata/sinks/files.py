"""File and layer writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakestrata import schemas
from lakestrata.operators.load import first_rows, new_rows, upsert
from lakestrata.settings import work_path
from lakestrata.sources.tables import MissingTableError, avro_available, layer_path


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, overwriting; one file per partition."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_avro(df: DataFrame, path: str, avro_schema: str) -> None:
    if not avro_available(df.sparkSession):
        raise RuntimeError("this Spark session has no Avro module (spark-avro)")
    df.write.mode("overwrite").format("avro").option("avroSchema", avro_schema).save(path)


def write_layer(
    df: DataFrame, root: str, layer: str, table: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
    replace: str = "partitions", values: DataFrame | None = None,
) -> str:
    """Write a layer table; with partitions only those in ``df`` are replaced.

    ``replace="table"`` is for a full rebuild: partitions that ``df`` no longer
    holds are removed too. The rebuild is written to the shared folder first
    and only copied over the table when it is whole, so one that fails leaves
    the old table, and a copy that fails can be repeated from there. ``values``
    are the partition values of ``df``, for a caller that can tell them with
    less work than by building ``df``. Where they cover all partitions of the
    old table, none is left to remove and there is no copy: Spark stages the
    files beside the table and puts them in place when all are written.

    Rows are clustered by partition value first, in many tasks per value, so
    a large or hot partition is written in parallel and a task does not keep
    a file open per partition value. ``REBALANCE`` splits oversized parts.
    """
    if replace not in ("partitions", "table"):
        raise ValueError("replace is 'partitions' or 'table'")
    path = layer_path(root, layer, table)
    in_place = replace == "partitions"
    if replace == "table" and mode == "overwrite" and _exists(df.sparkSession, path):
        in_place = bool(partition_by) and values is not None and _covers(values, path, partition_by)
        if not in_place:
            staged = work_path(df.sparkSession, "rebuild")
            df.write.parquet(staged)
            df = df.sparkSession.read.schema(df.schema).parquet(staged)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if in_place else "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def _covers(values: DataFrame, path: str, partition_by: Sequence[str]) -> bool:
    """Whether ``values`` holds every partition of the table at ``path``; a table
    of other partition columns is not covered."""
    old = values.sparkSession.read.parquet(path)
    if list(old.columns[-len(partition_by):]) != list(partition_by):
        return False
    names = [F.col(c).cast("string") for c in partition_by]
    return old.select(*names).distinct().subtract(values.select(*names)).isEmpty()


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``; other failures are raised."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def write_gold(df: DataFrame, root: str, table: str, partition_by: Sequence[str]) -> str:
    return write_layer(df, root, "gold", table, partition_by)


def promote(
    spark: SparkSession, source: str, root: str, layer: str, table: str, partition_by: Sequence[str] = ()
) -> str:
    """Copy one Parquet table into a layer; a missing or empty one is an error."""
    try:
        df = spark.read.parquet(source)
    except PySparkException as error:
        raise MissingTableError(f"nothing to promote at {source}") from error
    if df.isEmpty():
        raise MissingTableError(f"table at {source} is empty")
    return write_layer(df, root, layer, table, partition_by)


def land_bronze(tables: Mapping[str, DataFrame | str | None], root: str, spark: SparkSession) -> DataFrame:
    """Land many tables; status rows (table, status, n_rows).

    A table is a DataFrame or a Parquet path. Missing ones are skipped and a
    failing one does not stop the others: ``LANDED``, ``SKIPPED``, ``FAILED``.
    """
    status = []
    for name, source in tables.items():
        try:
            df = spark.read.parquet(source) if isinstance(source, str) else source
        except PySparkException:
            df = None
        if df is None:
            status.append((name, "SKIPPED", None))
            continue
        try:
            path = write_layer(df, root, "bronze", name)
            status.append((name, "LANDED", spark.read.parquet(path).count()))
        except PySparkException:
            status.append((name, "FAILED", None))
    return spark.createDataFrame(status, "table string, status string, n_rows bigint")


def append_audit(rows: DataFrame, path: str, small: bool = False) -> None:
    """Append audit rows, partitioned by day; ``small`` ones, of a single task,
    need no shuffle before."""
    dated = rows.select(*schemas.AUDIT_COLUMNS, F.to_date("timestamp").alias("event_date"))
    dealt = dated if small else dated.hint("rebalance", "event_date")
    dealt.write.mode("append").partitionBy("event_date").parquet(path)


def append_new(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> None:
    """Insert-if-absent into a Parquet table; a repeated batch adds nothing.

    Only a missing path counts as an empty table; any other failure to read it
    is raised.
    """
    try:
        target = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        first_rows(batch, keys, order).write.mode("append").parquet(path)
        return
    new_rows(target, batch, keys, order).select(*target.columns).write.mode("append").parquet(path)


# Touched partitions named one by one in the scan's filter.
NAMED_PARTITIONS = 10_000


def upsert_partitions(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
    partition_by: Sequence[str],
) -> None:
    """Upsert into a partitioned Parquet table, rewriting only the partitions
    the batch touches.

    A key must always fall into the same partition. Up to ``NAMED_PARTITIONS``
    touched partitions are named in a filter, so that the others are not even
    listed for the scan; a batch that touches more finds them by a join. The
    merged partitions are staged in the shared folder first, so a failure
    leaves the table as it was and the final overwrite can be repeated.
    """
    target = spark.read.parquet(path)
    touched = batch.select(*partition_by).distinct()
    named = touched.limit(NAMED_PARTITIONS + 1).collect()
    if not named:
        return
    if len(named) <= NAMED_PARTITIONS:
        # Each column by itself prunes; the combinations are exact below.
        for column in partition_by:
            values = {r[column] for r in named}
            among = F.col(column).isin([v for v in values if v is not None])
            target = target.where(among | F.col(column).isNull() if None in values else among)
    if len(named) > NAMED_PARTITIONS or len(partition_by) > 1:
        renamed = touched.withColumnsRenamed({c: f"_touched_{c}" for c in partition_by})
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_touched_{c}")) for c in partition_by])
        target = target.join(renamed, same, "left_semi")
    staged = work_path(spark, "upsert")
    upsert(target, batch, keys, order).write.parquet(staged)
    merged = spark.read.parquet(staged).hint("rebalance", *partition_by)
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
