"""Filter audit against the orders one by one."""

from __future__ import annotations

import random
from fractions import Fraction
from itertools import combinations, permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

from lakestrata.llm import filter_audit as A


def test_least_squares_give_the_shapley_values():
    rng = random.Random(2)
    for m in (2, 3, 5):
        weights = A.shapley_weights(m)
        for _ in range(20):
            game = [0] + [rng.randint(-50, 50) for _ in range(2**m - 1)]
            game[0] = rng.randint(-5, 5)
            for i in range(m):
                want = Fraction(0)
                others = [j for j in range(m) if j != i]
                for size in range(m):
                    for members in combinations(others, size):
                        s = sum(1 << j for j in members)
                        want += Fraction(factorial(size) * factorial(m - size - 1), factorial(m)) * (game[s | 1 << i] - game[s])
                assert sum(w * v for w, v in zip(weights[i], game)) == want
            assert sum(sum(w * v for w, v in zip(row, game)) for row in weights) == game[-1] - game[0]


def test_text_failures():
    good = " ".join(f"w{i}" for i in range(200))
    assert A.text_failures(good.encode()) == 0
    assert A.text_failures(b"") == 1 and A.text_failures(b"a\x0bb") == 1
    assert A.text_failures(("a " * 250).encode()) == 2
    assert A.text_failures((good + " é" * 10 + " ABCD").encode()) == 0
    assert A.text_failures(("x " * 99 + good.upper()).encode()) == 4
    assert A.text_failures((good + " |").encode()) == 8
    # Exactly half distinct and exactly 2 % capitals pass.
    assert A.text_failures((" ".join(f"w{i}" for i in range(100)) + " w1" * 100).encode()) == 0
    assert A.text_failures(("AB" + "é" * 98).encode()) == 1 and A.text_failures(("ABC" + "é" * 97).encode()) == 5
    # White signs beyond ASCII are no separators.
    assert A.text_failures(("a b" * 300).encode()) == 1


def brute(rows, marks):
    """Every order walked through document by document."""
    fails = []
    for doc, text, source in rows:
        text = text or ""
        mask = A.text_failures(text.encode())
        letters = {"ABCD"[i] for i in range(4) if mask >> i & 1}
        if doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _ in rows):
            letters.add("E")
        fails.append((source or "", letters, *marks.get(doc, (0, 0))))
    out = {}
    for part in {p for p, *_ in fails}:
        own = [f for f in fails if f[0] == part]
        sums = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [f for f in left if x in f[1]]
                left = [f for f in left if x not in f[1]]
                sums[x] += len(gone)
                redundant = sum(x in f[1] for f in own) - len(gone)
                unique = sum(f[1] == {x} for f in own)
                steps.append((part, "".join(order), step, x, len(left), len(gone), redundant, unique, sum(f[2] for f in gone), sum(f[3] for f in gone)))
        for s in steps:
            out[s[:3]] = (*s[4:], sums[s[3]])
    return out


LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def audited(spark):
    rng = random.Random(5)
    pool = [
        "", None, "short text", "# " * 250, " ".join(f"w{i}" for i in range(250)), "LOUD " * 300,
        " ".join(f"v{i}" for i in range(250)) + " $", "A" * 100_000, "B b | " * 120, "plain words only " * 100,
    ]
    rows = [(i, rng.choice(pool), rng.choice(["a", "b", None, ""])) for i in range(150)]
    rows += [(None, pool[4], "a"), (None, pool[4], "b"), (3, "other text", "a"), (7, pool[4], "c"), (7, pool[4], "c")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(7, 1, 0), (7, 0, 1), (None, 1, 1), (999, 1, 1)]
    marks = {}
    for doc, q, t in labels:
        if doc is not None:
            old = marks.get(doc, (0, 0))
            marks[doc] = (max(old[0], int(q == 1)), max(old[1], int(t == 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"mask": F.lit("clash"), "digest": F.lit(1), "n": F.lit(0)})
    return docs, spark.createDataFrame(labels, LABELS).withColumn("mask", F.lit(2)), rows, marks


def test_audit_equals_brute_force(audited):
    docs, labels, rows, marks = audited
    out = A.audit(A.count_masks(docs.repartition(7), labels, F.col("source")), A.FILTERS).collect()
    got = {tuple(r)[:3]: tuple(r)[3:] for r in out}
    assert len(out) == len(got) == 600 * 4
    assert got == brute(rows, marks)


def test_empty_tables(spark, audited):
    docs, labels, *_ = audited
    assert A.audit(A.count_masks(docs.limit(0), labels, F.col("source")), A.FILTERS).count() == 0
    out = A.audit(A.count_masks(docs, labels.limit(0), F.lit("all")), A.FILTERS)
    assert out.count() == 600 and out.agg(F.sum("good_lost"), F.sum("toxic_lost")).first()[:] == (0, 0)
    with pytest.raises(ValueError, match="filters"):
        A.audit(spark.createDataFrame([], "part string, mask int, n long, good long, toxic long"), "A")


def test_other_numbers_of_filters(spark):
    counted = spark.createDataFrame([("p", 1, 5, 1, 0), ("p", 3, 2, 0, 1), ("p", 0, 4, 4, 0)], "part string, mask int, n long, good long, toxic long")
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in A.audit(counted, "XY").collect()}
    assert got == {("XY", 1): (4, 7, 0, 5, 12), ("XY", 2): (4, 0, 2, 0, 2), ("YX", 1): (9, 2, 0, 0, 2), ("YX", 2): (4, 5, 2, 5, 12)}
