"""Exact quantiles by distributed selection.

A histogram over the range of the values says which of its bins holds a wanted
rank; the next pass cuts that bin's own range, and so on until a bin holds one
value or few rows. Each pass is one scan with a small aggregate: the table is
not sorted, and one row per wanted quantile reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

BINS = 4096
# Distinct values of a bin that are ranked one by one.
FEW = 10_000


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float], *, bins: int = BINS, few: int = FEW) -> list[float | None]:
    """For each share the smallest value that at least that share of the
    values reaches (``quantile_disc``), as doubles.

    NULL and NaN are left out; without other values every quantile is None.
    Infinite values count at either end. Ties of any number are exact.
    """
    if any(not 0 <= s <= 1 for s in shares):
        raise ValueError("shares lie between 0 and 1")
    x = F.col(column).cast("double")
    values = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    finite = ~F.col("x").isin(float("inf"), float("-inf"))
    seen = values.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("x") == float("-inf")).alias("below"),
        F.count_if(F.col("x") == float("inf")).alias("above"),
        F.min(F.when(finite, F.col("x"))).alias("low"), F.max(F.when(finite, F.col("x"))).alias("high"),
    ).first()
    n, below, above = seen["n"], seen["below"], seen["above"]
    found: dict[int, float | None] = {}
    # Open searches: share -> (range, rank within the range counting from 1).
    searches: dict[int, tuple[float, float, int]] = {}
    for i, share in enumerate(shares):
        rank = max(1, _ceil_times(share, n))
        if not n:
            found[i] = None
        elif rank <= below:
            found[i] = float("-inf")
        elif rank > n - above:
            found[i] = float("inf")
        else:
            searches[i] = (seen["low"], seen["high"], rank - below)
    while searches:
        for i, row in _narrowed(values, searches, bins).items():
            low, high, rank = row["low"], row["high"], row["rank"]
            if low == high:
                found[i] = low
                del searches[i]
            elif row["held"] <= few:
                found[i] = _ranked(values, low, high, rank)
                del searches[i]
            else:
                searches[i] = (low, high, rank)
    return [found[i] for i in range(len(shares))]


def _ceil_times(share: float, n: int) -> int:
    """``share * n`` rounded up, the share taken as the decimal it is written as."""
    from fractions import Fraction

    return -(-Fraction(str(share)) * n // 1)


def _bin(low: float, high: float, bins: int) -> Column:
    """Number of the bin; halves keep the width of the widest ranges finite."""
    width = high / 2 - low / 2
    if not width:
        return F.when(F.col("x") == low, 0).otherwise(1)
    return F.least(F.floor((F.col("x") / 2 - F.lit(low / 2)) / F.lit(width) * F.lit(float(bins))), F.lit(bins - 1)).cast("int")


def _narrowed(values: DataFrame, searches: dict[int, tuple[float, float, int]], bins: int) -> dict:
    """For each search the bin that holds its rank: its range, rows and the
    rank within it. One scan for all searches."""
    places = F.array_compact(F.array(*[
        F.when(F.col("x").between(low, high), F.struct(F.lit(i).alias("search"), _bin(low, high, bins).alias("bin")))
        for i, (low, high, _) in searches.items()
    ]))
    counted = (
        values.select("x", F.inline(places)).groupBy("search", "bin")
        .agg(F.count(F.lit(1)).alias("held"), F.min("x").alias("low"), F.max("x").alias("high"))
    )
    # At most ``bins`` rows a search.
    upto = F.sum("held").over(Window.partitionBy("search").orderBy("bin"))
    wanted = reduce(lambda c, i: c.when(F.col("search") == i, searches[i][2]), searches, F).cast("long")
    ranked = counted.select("*", upto.alias("upto"), wanted.alias("wanted"))
    held = ranked.where((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("held") < F.col("wanted")))
    rows = held.select("search", "low", "high", "held", (F.col("wanted") - F.col("upto") + F.col("held")).alias("rank")).collect()
    return {r["search"]: r for r in rows}


def _ranked(values: DataFrame, low: float, high: float, rank: int) -> float:
    """The value of that rank among the few between ``low`` and ``high``."""
    counted = values.where(F.col("x").between(low, high)).groupBy("x").agg(F.count(F.lit(1)).alias("held"))
    upto = counted.select("x", F.sum("held").over(Window.orderBy("x")).alias("upto"))
    return upto.where(F.col("upto") >= rank).agg(F.min("x").alias("x")).first()["x"]
