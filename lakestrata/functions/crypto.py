"""Versioned column encryption.

Keys live in a key-history DataFrame (version, key_value, created_at,
expires_at). Operators read the key from there with a scalar subquery or a
join, so key bytes never become plan literals.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata import constants as K, schemas
from lakestrata.functions.time import add_days, ntz
from lakestrata.operators.joins import broadcast_if_small


def _key_of(keys: DataFrame, version: str) -> Column:
    """Key bytes of one version; an unknown version fails the query."""
    found = _one_key_each(keys.where(F.col("version") == version)).agg(F.max("key_value").alias("key_value"))
    return F.coalesce(
        found.scalar(), F.raise_error(F.lit(f"no key for version {version}")).cast("binary")
    )


def _one_key_each(keys: DataFrame) -> DataFrame:
    """One row per version; two different keys under one version are an error."""
    clash = F.raise_error(F.concat(F.lit("several keys for version "), F.col("version"))).cast("binary")
    return keys.groupBy("version").agg(F.min("key_value").alias("low"), F.max("key_value").alias("high")).select(
        "version", F.when(F.col("low").eqNullSafe(F.col("high")), F.col("low")).otherwise(clash).alias("key_value")
    )


def _encrypted(col: Column, key: Column) -> Column:
    return F.aes_encrypt(col.cast("string").cast("binary"), key, F.lit("GCM"))


def encrypt_column(
    df: DataFrame, column: str, keys: DataFrame, version: str, version_column: str = "key_version"
) -> DataFrame:
    """AES-GCM encrypt a column with the key of ``version`` and tag the rows."""
    return df.withColumns({
        column: _encrypted(F.col(column), _key_of(keys, version)),
        version_column: F.lit(version),
    })


def decrypt_column(
    df: DataFrame, column: str, keys: DataFrame, version_column: str = "key_version", on_missing: str = "null"
) -> DataFrame:
    """Decrypt each row with the key of its own version.

    Rows of an unknown version, or whose bytes fail authentication, give NULL;
    ``on_missing="error"`` fails on an unknown version instead.
    """
    if on_missing not in ("null", "error"):
        raise ValueError("on_missing is 'null' or 'error'")
    lookup = _one_key_each(keys).select(F.col("version").alias(version_column), F.col("key_value").alias("_key"))
    joined = df.join(broadcast_if_small(lookup), version_column, "left")
    plain = F.try_aes_decrypt(F.col(column), F.col("_key"), F.lit("GCM")).cast("string")
    if on_missing == "error":
        missing = F.raise_error(F.lit("no key for a row's version")).cast("string")
        plain = F.when(F.col("_key").isNull(), missing).otherwise(plain)
    return joined.withColumn(column, plain).select(*df.columns)


def rekey(
    df: DataFrame,
    column: str,
    keys: DataFrame,
    new_version: str,
    old_version: str | None = None,
    version_column: str = "key_version",
) -> DataFrame:
    """Re-encrypt rows (of ``old_version``, or of any other) under ``new_version``."""
    stale = F.col(version_column) != new_version
    if old_version is not None:
        stale = F.col(version_column) == old_version
    lookup = _one_key_each(keys).select(F.col("version").alias(version_column), F.col("key_value").alias("_key"))
    joined = df.join(broadcast_if_small(lookup), version_column, "left")
    old_key = F.coalesce(
        F.col("_key"), F.raise_error(F.lit("no key for a row's version")).cast("binary")
    )
    plain = F.aes_decrypt(F.col(column), old_key, F.lit("GCM")).cast("string")
    return joined.withColumns({
        column: F.when(stale, _encrypted(plain, _key_of(keys, new_version))).otherwise(F.col(column)),
        version_column: F.when(stale, F.lit(new_version)).otherwise(F.col(version_column)),
    }).select(*df.columns)


def rotate_key(
    keys: DataFrame,
    version: str,
    key_value: bytes,
    created_at: datetime | str,
    lifetime_days: int = K.KEY_LIFETIME_DAYS,
) -> DataFrame:
    """Key history with one new version, valid for ``lifetime_days``."""
    row = keys.sparkSession.createDataFrame([(version, key_value)], "version string, key_value binary")
    row = row.withColumn("created_at", ntz(created_at))
    row = row.withColumn("expires_at", add_days(F.col("created_at"), lifetime_days))
    return keys.unionByName(row.select(*schemas.KEY_HISTORY.fieldNames()))


def expired_keys(keys: DataFrame, retain_days: int, as_of: datetime | str, active: str) -> DataFrame:
    """Versions created before the cutoff that are not the active one."""
    cutoff = add_days(ntz(as_of), -retain_days)
    return keys.where((F.col("created_at") < cutoff) & ~F.col("version").eqNullSafe(F.lit(active)))
