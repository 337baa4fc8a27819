"""Keyed permutations of number ranges: distinct pseudonyms for distinct values.

A number below ``a * b`` is a pair of halves; in turn one half is shifted by a
keyed digest of the other. Each of these rounds can be undone, so all of them
together map the range onto itself and no two numbers meet. A range that is no
such product is a part of the next larger one: a number that leaves the range
is permuted again until it is back (cycle walking).
"""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

from pyspark.sql import Column, functions as F

ROUNDS = 10
# Steps of a walk. One step leaves the range with a chance of about one in its
# root, so a walk as long as this does not occur by chance; it is an error.
WALK = 12


def halves(size: int) -> tuple[int, int]:
    """Two moduli whose product is at least ``size``; equal to it for powers
    of ten."""
    digits = len(str(size)) - 1
    if size == 10 ** digits:
        return 10 ** (digits - digits // 2), 10 ** (digits // 2)
    a = isqrt(size - 1) + 1
    return a, -(-size // a)


def round_number(half: Column, step: Column, key: Column) -> Column:
    """Digest of a half in a round, as a number below 2 ** 52."""
    text = F.concat_ws("|", key, step.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("bigint")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, however often it is
    looked at."""
    return F.transform(F.array(value), use)[0]


def _rounds(number: Column, a: Column, b: Column, key: Column) -> Column:
    pair = F.struct(F.pmod(number, a).alias("l"), F.floor(number / a).cast("bigint").alias("r"))

    def one(state: Column, step: Column) -> Column:
        left, right = state["l"], state["r"]
        return F.when(
            step % 2 == 0, F.struct(F.pmod(left + round_number(right, step, key), a).alias("l"), right.alias("r"))
        ).otherwise(F.struct(left.alias("l"), F.pmod(right + round_number(left, step, key), b).alias("r")))

    steps = F.array(*[F.lit(k) for k in range(ROUNDS)])
    return F.aggregate(steps, pair, one, lambda s: s["l"] + s["r"] * a)


def _inside(number: Column, size: Column) -> Column:
    return F.when((number >= 0) & (number < size), number).when(
        number.isNotNull(), F.raise_error(F.lit("number outside the permuted range"))
    )


def permuted(number: Column, size: int, key: str) -> Column:
    """``number`` below ``size`` mapped to another one below ``size``, each to
    its own. NULL stays NULL; a number outside the range is an error."""
    if not key:
        raise ValueError("masking key is required")
    if not 2 <= size <= 10 ** 15:
        raise ValueError("the range has 2 to 10 ** 15 numbers")
    a, b = halves(size)
    limit, sides = F.lit(size), (F.lit(a), F.lit(b), F.lit(key))
    if a * b == size:
        return once(_inside(number.cast("bigint"), limit), lambda n: _rounds(n, *sides))
    # The first step is always made, the others while the walk is outside.
    walk = F.aggregate(
        F.array(*[F.lit(k) for k in range(WALK)]),
        F.struct(F.lit(True).alias("out"), _inside(number.cast("bigint"), limit).alias("n")),
        lambda state, _: F.when(~state["out"], state).otherwise(
            once(_rounds(state["n"], *sides), lambda n: F.struct((n >= limit).alias("out"), n.alias("n")))
        ),
    )
    return once(walk, lambda w: F.when(w["out"], F.raise_error(F.lit("the walk did not come back"))).otherwise(w["n"]))


def permuted_digits(number: Column, width: Column, key: str) -> Column:
    """``number`` of up to ``width`` digits, 1 to 15, as ``permuted(number,
    10 ** width, f"{key}|{width}")`` gives it: one permutation a row, whatever
    widths there are."""
    if not key:
        raise ValueError("masking key is required")
    powers = F.array(*[F.lit(10 ** k).cast("bigint") for k in range(16)])
    right = F.floor(width / 2).cast("int")
    given = F.struct(
        _inside(number.cast("bigint"), F.get(powers, width)).alias("n"),
        F.get(powers, width - right).alias("a"), F.get(powers, right).alias("b"),
        F.concat(F.lit(f"{key}|"), width.cast("string")).alias("key"),
    )
    return once(given, lambda g: _rounds(g["n"], g["a"], g["b"], g["key"]))
