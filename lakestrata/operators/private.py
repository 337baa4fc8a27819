"""Differentially private totals per group.

What one person can change is bounded first: at most so many of a person's rows
count, and each value is clipped. The noise on the totals is drawn for that
bound, and a group is shown only if its noisy number of rows reaches a
threshold, so that a group of few people does not show by being there.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import log

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakestrata.functions.masking import keyed_unit, laplace


def bounded_rows(df: DataFrame, person: str, most: int, row_id: Sequence[str], secret: str) -> DataFrame:
    """At most ``most`` rows of each person, chosen by a keyed digest of the
    row's identity; rows without person are left out.

    Each task first keeps its own ``most`` rows of a person, so one person may
    hold most of the table.
    """
    chosen = F.sha2(F.concat(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in row_id]), F.lit(secret)), 256)
    rank = F.row_number().over(Window.partitionBy(person).orderBy("_chosen", *row_id))
    known = df.where(F.col(person).isNotNull()).withColumn("_chosen", chosen)
    return known.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank", "_chosen")


def show_threshold(epsilon: float, most: int, delta: float) -> float:
    """Noisy rows from which a group is shown: one person alone reaches it
    with a chance of at most ``delta``."""
    return most + most / epsilon * log(most / (2 * delta))


def private_totals(
    df: DataFrame, group: str, person: str, value: str, *, epsilon: float, secret: str, row_id: Sequence[str],
    low: float, high: float, most_rows: int = 1, delta: float = 1e-6,
) -> DataFrame:
    """``group``, ``n_rows``, ``total`` and ``mean`` of the groups shown.

    Half of ``epsilon`` goes to the counts and half to the totals, for all
    groups together. ``secret`` keys which rows count and the noise: the same
    call gives the same answer, and asking again averages nothing out. Groups
    that would follow from few people are not among the rows. NULL and NaN
    values count as a row with the value ``low`` clipped towards zero.
    """
    if not epsilon > 0 or not 0 < delta < 1:
        raise ValueError("epsilon must be positive and delta between 0 and 1")
    if not (isinstance(most_rows, int) and most_rows >= 1):
        raise ValueError("most_rows must be a positive integer")
    if not low <= high:
        raise ValueError("low must not exceed high")
    if not secret:
        raise ValueError("a secret is required")
    x = F.col(value).cast("double")
    neutral = F.lit(min(max(0.0, float(low)), float(high)))
    clipped = F.when(x.isNull() | F.isnan(x), neutral).otherwise(F.least(F.greatest(x, F.lit(float(low))), F.lit(float(high))))
    bounded = bounded_rows(df, person, most_rows, row_id, secret).withColumn("_clipped", clipped)
    counted = bounded.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.sum("_clipped").alias("_s"))
    half = epsilon / 2

    def noisy(column: str, sensitivity: float) -> Column:
        unit = keyed_unit([group], f"{secret}|{column}")
        return F.col(column) + laplace(unit, sensitivity * most_rows / half)

    shown = counted.select(
        group, noisy("_n", 1.0).alias("n_rows"), noisy("_s", max(abs(low), abs(high))).alias("total")
    ).where(F.col("n_rows") >= show_threshold(half, most_rows, delta))
    return shown.withColumn("mean", F.col("total") / F.col("n_rows"))
