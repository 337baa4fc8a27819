"""All-or-nothing publishing of several tables.

Every load writes its tables into a new version folder; a manifest row per
version is written last. Readers take the newest version that has one, so a
load that fails half-way is never visible and the previous one stays in use.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

MANIFEST = "version string, tables array<string>"


def load_star(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    version: str,
    check: Callable[[dict[str, DataFrame]], None] | None = None,
) -> str:
    """Write dimensions, then facts, then publish ``version``.

    ``check`` gets the tables as they were written and may raise; the version
    is then not published. Versions must sort by age, as ``version_stamp``
    names do.
    """
    published = _versions(spark, root)
    if published is not None and not published.where(F.col("version") >= version).isEmpty():
        raise ValueError(f"version {version} is not newer than the published one")
    names = sorted(tables, key=lambda name: name.startswith("fato"))
    for name in names:
        tables[name].write.mode("overwrite").parquet(f"{root}/versions/{version}/{name}")
    if check is not None:
        check({name: spark.read.parquet(f"{root}/versions/{version}/{name}") for name in names})
    manifest = spark.createDataFrame([(version, names)], MANIFEST)
    manifest.coalesce(1).write.mode("append").json(f"{root}/manifest")
    return version


def _versions(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST).json(f"{root}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current_version(spark: SparkSession, root: str) -> str | None:
    versions = _versions(spark, root)
    return None if versions is None else versions.agg(F.max("version")).first()[0]


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the newest published version."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no published star under {root}")
    names = _versions(spark, root).where(F.col("version") == version).first()["tables"]
    return {name: spark.read.parquet(f"{root}/versions/{version}/{name}") for name in names}
