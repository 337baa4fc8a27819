"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on at scale. Each is applied only where
# the cluster has not chosen a value itself.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even if that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Keyed digests carry the key as a literal: keep them out of printed plans.
    "spark.sql.redaction.string.regex": r"sha2\(.*?, 256\)",
}


def apply_scale_settings(spark: SparkSession) -> SparkSession:
    """Apply ``SCALE_SETTINGS`` where the session holds no value of its own.

    A value given at start-up or set at run time is left alone.
    """
    # Only settings somebody has given are listed; defaults are not.
    explicit = spark.conf.getAll
    for name, value in SCALE_SETTINGS.items():
        if name not in explicit:
            spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary one; a cluster
    without the setting is an error, since a machine-local folder would not
    survive the loss of an executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = tempfile.mkdtemp(prefix="lakestrata-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/lakestrata/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    A written table has a fixed order and a fixed partitioning, survives lost
    executors and, unlike an RDD checkpoint, keeps column pruning.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
