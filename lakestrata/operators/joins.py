"""Left joins that stay balanced when one key holds much of the data.

Adaptive execution splits a skewed *preserved* side of an outer join, but it
cannot split the other side. ``left_join`` therefore looks for keys that are
hot on the right, salts just those, and leaves all other rows on the plain
join, which shares its partitioning with neighbouring joins on the same key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_ROWS = 10_000
# Rows of one key that a single task still joins in seconds.
HOT_ROWS = 5_000_000
HOT_KEYS = 1_000
SKETCH_GROUPS = 256
SALTS = 32


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a narrow lookup only after a bounded count of its rows;
    a larger one is left to Spark's own choice of join."""
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS, top: int = HOT_KEYS) -> list:
    """Keys that hold at least about ``min_rows`` rows, and at least one in
    ``top`` of all rows: there are never more than ``top`` of them."""
    return hot_keys_of({"": df}, key, min_rows, top)[""]


def hot_keys_of(
    tables: Mapping[str, DataFrame], key: str, min_rows: int = HOT_ROWS, top: int = HOT_KEYS
) -> dict[str, list]:
    """Hot keys of several tables that share a key column, in one job.

    One pass over the key columns with mergeable frequent-items sketches. They
    are merged in two steps, first in up to ``SKETCH_GROUPS`` tasks and then in
    one, so that hundreds of thousands of tasks do not report to a single one.
    A key counts as hot from ``min_rows`` rows on, or from one in ``top`` of
    the table's rows if that is more. No more than ``top`` keys can hold so
    many, so the list is complete. It only steers balance; results do not
    depend on it.
    """
    keys = reduce(DataFrame.unionByName, [
        df.where(F.col(key).isNotNull()).select(
            F.lit(name).alias("_table"), F.col(key).alias("_key"),
            (F.spark_partition_id() % SKETCH_GROUPS).alias("_group"),
        )
        for name, df in tables.items()
    ])
    tracked = 4 * top
    merged = (
        keys.groupBy("_table", "_group")
        .agg(F.expr(f"approx_top_k_accumulate(_key, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("rows"))
        .groupBy("_table")
        .agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("rows").alias("rows"))
    )
    estimates = merged.select("_table", "rows", F.expr(f"approx_top_k_estimate(sketch, {int(top)})").alias("items"))
    found = {
        row["_table"]: [i["item"] for i in row["items"] if i["count"] >= max(min_rows, row["rows"] / top)]
        for row in estimates.collect()
    }
    return {name: found.get(name, []) for name in tables}


def _salt(columns: Sequence[str], salts: int) -> Column:
    """Spread rows, exact copies in different tasks included.

    Content and task number do not change when a task is run again.
    """
    return F.pmod(F.xxhash64(F.spark_partition_id(), *columns), F.lit(salts)).cast("int")


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    *,
    null_keys: str = "sql",
    hot: Sequence | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Left join on one column.

    ``null_keys="match"`` joins NULL to NULL as data-frame merges do; the NULL
    key is then treated as a hot one. ``hot`` lists keys that are frequent on
    the right (see ``hot_keys``); each must occur there. Rows of such a key are
    dealt over ``salts`` partitions.
    """
    if null_keys not in ("sql", "match"):
        raise ValueError("null_keys is 'sql' or 'match'")
    match = null_keys == "match"
    if not hot and not match:
        return left.join(right, on, "left")

    is_hot = F.coalesce(F.col(on).isin(list(hot or [])), F.lit(match))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread_left = left.withColumn("_salt", F.explode(copies))
    spread_right = right.withColumns({
        "_salt": F.when(is_hot, _salt(right.columns, salts)).otherwise(F.lit(0)),
        "_hit": F.lit(True),
    })
    # A hot key always has partners, so a copy without one is an empty salt.
    if not match:
        joined = spread_left.join(spread_right, [on, "_salt"], "left")
        return joined.where(~is_hot | F.col("_hit")).drop("_salt", "_hit")
    # The NULL key may have none at all: then its first copy stays.
    nulls = right.where(F.col(on).isNull()).limit(1).agg(F.count(F.lit(1)).alias("n")).scalar()
    renamed = spread_right.withColumnsRenamed({on: "_right_key", "_salt": "_right_salt"})
    same = F.col(on).eqNullSafe(F.col("_right_key")) & (F.col("_salt") == F.col("_right_salt"))
    lonely = F.col(on).isNull() & (F.col("_salt") == 0) & (nulls == 0)
    joined = spread_left.join(renamed, same, "left").where(~is_hot | F.col("_hit") | lonely)
    return joined.drop("_salt", "_hit", "_right_key", "_right_salt")


def join_with_suffixes(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    suffixes: tuple[str, str] = ("_order", "_item"),
) -> DataFrame:
    """Join and rename the non-key columns both sides share."""
    keys = [on] if isinstance(on, str) else list(on)
    shared = (set(left.columns) & set(right.columns)) - set(keys)
    renamed_left = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    renamed_right = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return renamed_left.join(renamed_right, keys, how)


def orphan_keys(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Distinct fact keys without a dimension row, with their row counts.

    The fact is reduced to one row per key before it meets the dimension.
    """
    dim_key = dim_key or fact_key
    counted = (
        fact.where(F.col(fact_key).isNotNull())
        .groupBy(fact_key)
        .agg(F.count(F.lit(1)).alias("fact_rows"))
    )
    known = dim.select(F.col(dim_key).alias(fact_key))
    return counted.join(known, fact_key, "left_anti")
