"""Insert-if-absent and upsert without a MERGE-capable table format.

A row with a NULL in a key has no key to conflict on. It is known by its whole
row: it is added unless the target holds an equal row, and once only. So any
load may be repeated and adds nothing the second time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.operators.dedupe import dedupe_first
from lakestrata.settings import cut_lineage

Order = Sequence[str | Column]


def _has_key(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def _fresh_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the batch that the target lacks, each once.

    Only keys are moved, and each at most once per task: target and batch may
    hold a key many times.
    """
    sides = batch.select(*keys, F.lit(0).alias("_known")).unionByName(target.select(*keys, F.lit(1).alias("_known")))
    merged = sides.where(_has_key(keys)).groupBy(*keys).agg(F.max("_known").alias("_known"))
    return merged.where("_known = 0").select(*keys)


def _new_without_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows without a key that the target does not hold, each once."""
    shared = [c for c in target.columns if c in batch.columns]
    rows = batch.where(~_has_key(keys)).dropDuplicates(shared)
    known = target.where(~_has_key(keys)).select(*[F.col(c).alias(f"_known_{c}") for c in shared]).distinct()
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in shared])
    return rows.join(known, same, "left_anti")


def new_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """Batch rows whose key the target lacks, the first per key, and rows
    without a key that it lacks.

    The keys are compared before rows are moved, and the new ones are written to
    the shared folder: a batch that is known for the most part moves few rows.
    """
    fresh = cut_lineage(_fresh_keys(target, batch, keys), "fresh")
    added = dedupe_first(batch.join(fresh, list(keys), "left_semi"), keys, order)
    return added.select(*batch.columns).unionByName(_new_without_key(target, batch, keys).select(*batch.columns))


def first_rows(batch: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """``new_rows`` where there is no target yet."""
    rows = batch.where(~_has_key(keys)).dropDuplicates(batch.columns)
    return dedupe_first(batch.where(_has_key(keys)), keys, order).unionByName(rows)


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """Target plus the new rows of the batch; existing keys win."""
    return target.unionByName(new_rows(target, batch, keys, order).select(*target.columns))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """Target with the batch's rows replacing equal keys; the first per key
    wins. Rows without a key replace nothing."""
    latest = dedupe_first(batch.where(_has_key(keys)), keys, order)
    kept = target.join(latest.select(*keys), list(keys), "left_anti").select(*target.columns)
    added = _new_without_key(target, batch, keys)
    return kept.unionByName(latest.select(*target.columns)).unionByName(added.select(*target.columns))
