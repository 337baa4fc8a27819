"""Filter interaction audit: what each filter of a chain removes, in any order.

A document fails some of the filters; its pattern of failures is a bit mask.
Counting the documents per mask gives the removals of every coalition of
filters (a document goes when it fails a member), and from those follow

* the steps of every order of the filters: the difference of two coalitions,
* the Shapley value of each filter: the minimum of the kernel-weighted squares
  between a coalition's removals and the sum of its members' values, subject to
  the values adding up to the removals of all. The normal equations are solved
  in rationals, so the values are exact.

Defined results: a NULL text counts as empty and a NULL part as the empty
string; an empty table gives no rows. Repeated rows count each time. A row
without identifier is neither a copy nor an original, and it has no labels. A
text labelled twice has its larger label. Texts of any length are read whole.
Only the columns named are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.common import Batches, cut_lineage, text_of

# All orders are listed, so the number of filters is small.
MOST_FILTERS = 6


def shapley_weights(m: int) -> list[list[Fraction]]:
    """For each of ``m`` players the weight of every coalition's value in its
    Shapley value, coalitions numbered by bit mask.

    The least squares problem has the same matrix for all games and is linear
    in their values, so it is solved once, with a right side per coalition.
    """
    every = 2**m - 1
    kernel = {s: Fraction(m - 1, comb(m, size) * size * (m - size)) for s in range(1, every) for size in [s.bit_count()]}
    member = lambda s, i: s >> i & 1
    # Unknowns: the m values, then the multiplier of the constraint.
    rows = [[Fraction(0)] * (m + 1 + 2**m) for _ in range(m + 1)]
    for i in range(m):
        for s, weight in kernel.items():
            if not member(s, i):
                continue
            for j in range(m):
                rows[i][j] += 2 * weight * member(s, j)
            rows[i][m + 1 + s] += 2 * weight
            rows[i][m + 1] -= 2 * weight
        rows[i][m] = rows[m][i] = Fraction(1)
    rows[m][m + 1 + every], rows[m][m + 1] = Fraction(1), Fraction(-1)
    for column in range(m + 1):
        pivot = next(r for r in range(column, m + 1) if rows[r][column])
        rows[column], rows[pivot] = rows[pivot], rows[column]
        rows[column] = [x / rows[column][column] for x in rows[column]]
        for r in range(m + 1):
            if r != column and rows[r][column]:
                factor = rows[r][column]
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[column])]
    return [row[m + 1:] for row in rows[:m]]


def coalition_removals(counted: DataFrame, m: int, measures: list[str]) -> DataFrame:
    """``part`` and, per measure, an array of what each coalition removes.

    ``counted`` has the columns part, mask and the measures.
    """
    def removed(measure: str) -> Column:
        return F.array(*[
            F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(measure)).otherwise(F.lit(0))).cast("long")
            for s in range(2**m)
        ]).alias(measure)

    return counted.groupBy("part").agg(F.sum("n").cast("long").alias("total"), *[removed(c) for c in measures])


def audit(counted: DataFrame, filters: str) -> DataFrame:
    """One row per part, order of the filters and step.

    ``filters`` names each filter by a letter, the first one being the lowest
    bit of ``mask``; ``counted`` has part, mask, n, good and toxic.
    """
    m = len(filters)
    if not 2 <= m <= MOST_FILTERS:
        raise ValueError(f"2 to {MOST_FILTERS} filters can be audited, not {m}")
    every = 2**m - 1
    parts = coalition_removals(counted, m, ["n", "good", "toxic"])

    def shapley(weights: list[Fraction]) -> Column:
        exact = [w * factorial(m) for w in weights]
        assert all(w.denominator == 1 for w in exact)
        return sum((F.lit(int(w)) * F.col("n")[s] for s, w in enumerate(exact) if w), F.lit(0))

    parts = parts.withColumn("shapley", F.array(*[shapley(w) for w in shapley_weights(m)]))
    steps = []
    for order in permutations(range(m)):
        before = 0
        for step, i in enumerate(order, 1):
            name = "".join(filters[j] for j in order)
            steps.append({"filter_order": name, "step": step, "i": i, "before": before, "after": before | 1 << i})
            before |= 1 << i
    fixed = F.from_json(
        F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, i int, before int, after int>>"
    )
    rows = parts.select("*", F.inline(fixed))
    gone = lambda measure: F.col(measure)[F.col("after")] - F.col(measure)[F.col("before")]
    alone = F.col("after") - F.col("before")
    return rows.select(
        "part", "filter_order", "step",
        (F.col("total") - F.col("n")[F.col("after")]).alias("kept"),
        gone("n").alias("removed"),
        (F.col("n")[alone] - gone("n")).alias("redundant"),
        (F.col("n")[every] - F.col("n")[F.lit(every) - alone]).alias("unique_fails"),
        gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"),
        F.col("shapley")[F.col("i")].alias("shapley"),
    )


FILTERS = "ABCDE"
COPY_BIT = 16
_UPPER = bytes(range(65, 91))
_SIGNS = b"#$%&*|"
_NOT_UPPER = bytes(c for c in range(256) if c not in _UPPER)
_NOT_SIGN = bytes(c for c in range(256) if c not in _SIGNS)
_CONTINUED = bytes(range(0x80, 0xC0))


def text_failures(data: bytes) -> int:
    """Mask of the filters A to D that a UTF-8 text fails."""
    words = data.split()  # bytes are split at space and \t to \r, and nowhere else
    return (
        1 * (len(words) < 200)
        | 2 * (100 * len(set(words)) < 50 * len(words))
        | 4 * (100 * len(data.translate(None, _NOT_UPPER)) > 2 * len(data.translate(None, _CONTINUED)))
        | 8 * (len(data.translate(None, _NOT_SIGN)) > 0)
    )


def _masks(failures: Callable[[bytes], int]) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([failures(t) for t in texts], pa.int32()),
                 pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts], pa.binary())],
                names=["doc_id", "part", "mask", "digest"],
            )

    return run


def count_masks(docs: DataFrame, labels: DataFrame, part: Column, *, failures: Callable[[bytes], int] = text_failures) -> DataFrame:
    """Documents per part and mask, those labelled good or toxic beside them.

    ``failures`` gives the mask of a whole text; the bit ``COPY_BIT`` is added
    where a smaller identifier has the same text. Equal texts meet by digest
    in an aggregate only. The join back is on digest and identifier, so that a
    text with many copies is spread over all tasks.
    """
    source = docs.select("doc_id", F.coalesce(part, F.lit("")).alias("part"), text_of().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    masks = source.mapInArrow(_masks(failures), f"doc_id {kind}, part string, mask int, digest binary")
    rows = cut_lineage(masks, "masks")
    # Repeated rows fold within tasks; rows without identifier meet no join.
    known = rows.where("doc_id IS NOT NULL").groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    first = (
        rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
        .withColumn("first", F.lit(True))
    )
    marks = (
        labels.where("doc_id IS NOT NULL").groupBy("doc_id")
        .agg(F.max(F.expr("quality = 1").cast("int")).alias("good"), F.max(F.expr("toxic = 1").cast("int")).alias("toxic"))
    )
    marked = known.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left").select(
        "part", F.when(F.col("first"), F.col("mask")).otherwise(F.col("mask").bitwiseOR(COPY_BIT)).alias("mask"), "n",
        (F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), (F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )
    unknown = rows.where("doc_id IS NULL").select(
        "part", "mask", F.lit(1).alias("n"), F.lit(0).alias("good"), F.lit(0).alias("toxic")
    )
    return (
        marked.unionByName(unknown).groupBy("part", "mask")
        .agg(*[F.sum(c).cast("long").alias(c) for c in ("n", "good", "toxic")])
    )
