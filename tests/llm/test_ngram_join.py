"""N-gram Jaccard join against all pairs, and connected components."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakestrata.llm import graph, ngram_join as J


def brute(rows):
    """doc_id -> (n, smallest id reachable) over all pairs of texts."""
    def grams(text):
        words = [w.decode() for w in (text or "").encode().lower().split()]
        if not words:
            return frozenset()
        return frozenset([tuple(words)]) if len(words) < 5 else frozenset(zip(*(words[k:] for k in range(5))))

    sets = [(i, grams(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            both = len(s & t)
            if both and 100 * both >= 80 * len(s | t):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        k = rng.randrange(len(words))
        roll = rng.random()
        if roll < 0.4:
            words[k] = f"new{rng.randrange(10**6)}"
        elif roll < 0.7:
            del words[k]
        else:
            words.insert(k, f"more{rng.randrange(10**6)}")
    return words


def corpus(rng):
    rows = []
    passage = [f"shared{k}" for k in range(12)]
    for group in range(14):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([3, 5, 9, 40, 120]))]
        for _ in range(rng.randint(1, 14)):
            words = changed(rng, base, rng.randint(0, max(1, len(base) // 25)))
            if rng.random() < 0.5:
                words = words + passage
            rows.append(" ".join(words))
    rows += ["", " \n", "one", "ONE", "one two", "É é", "é É", rows[0], rows[3].upper()]
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,tile,hot", [(1, 2000, 50_000), (2, 3, 50_000), (3, 4, 5), (4, 3, 1)])
def test_components_equal_all_pairs(spark, monkeypatch, seed, tile, hot):
    """Also with tiles so small that every list is cut, and few frequent shingles."""
    monkeypatch.setattr(J, "TILE", tile)
    monkeypatch.setattr(J, "HOT_SHINGLES", hot)
    rows = corpus(random.Random(seed))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).repartition(3)
    assert sorted(map(tuple, J.near_duplicates(df).collect())) == brute(rows)


def test_chain_of_edits_is_one_component(spark):
    rng = random.Random(9)
    words = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words)))
        words = changed(rng, words, 2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, J.near_duplicates(df).collect())) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (None, "alone here"), (9, "x " * 30_000)]
    out = J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(map(tuple, out.collect()), key=repr)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (None, 2, 4), (4, 2, 4), (4, 2, 4), (None, 1, None), (9, 1, 9)], key=repr)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert J.near_duplicates(empty).count() == 0


def test_keep_one_keeps_the_smallest_and_all_without_id(spark):
    rows = [(3, "a b c d e f", "p"), (1, "a b c d e f", "q"), (2, "other words entirely are here now", "r"), (None, "a b c d e f", "s"), (5, "", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra string")
    out = J.keep_one(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([rows[1], rows[2], rows[3], rows[4]], key=repr)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=300), st.sets(st.integers(0, 2**64 - 1), max_size=40), st.integers(0, 40))
def test_bitmaps_bound_the_overlap(both, extra, cut):
    a = np.array(sorted(both), dtype=np.uint64)
    b = np.array(sorted((set(sorted(both)[cut:]) | extra) or both), dtype=np.uint64)
    words = min(len(J.bitmap(a)), len(J.bitmap(b)))
    differing = int(np.bitwise_count(J.folded(J.bitmap(a), words) ^ J.folded(J.bitmap(b), words)).sum())
    assert J.overlap(a, b) == len(set(a.tolist()) & set(b.tolist())) <= (len(a) + len(b) - differing) // 2


@pytest.mark.parametrize("at_once", [0, 10**6])
def test_components_of_long_paths_and_stars(spark, at_once):
    """Star rounds and the fold in one task give the same."""
    rng = random.Random(2)
    path = [(k, k + 1) for k in range(300)]
    star = [(1000, 1001 + k) for k in range(200)]
    ids = list(range(5000, 5300))
    rng.shuffle(ids)
    shuffled = list(zip(ids, ids[1:]))
    edges = spark.createDataFrame(path + star + shuffled + [(7, 7), (3, 2)], "u long, v long").repartition(5)
    got = {r["node"]: r["component"] for r in graph.components(edges, at_once).collect()}
    want = {k: 0 for k in range(1, 301)} | {1001 + k: 1000 for k in range(200)} | {k: 5000 for k in range(5001, 5300)}
    assert got == want


def test_keep_one_loses_no_text_of_a_repeated_id(spark):
    some = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    rows = [(1, some(1), "a"), (1, some(2), "a"), (2, some(3), "a"), (3, some(3), "b"), (3, some(4), "c"), (4, "", "a"), (5, None, "a"), (6, some(5), "a"), (6, some(5), "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = sorted((r["doc_id"], r["text"] or "") for r in J.keep_one(docs.repartition(5)).collect())
    assert kept == sorted([(1, some(1)), (1, some(2)), (2, some(3)), (3, some(4)), (4, ""), (5, ""), (6, some(5))])
    one = {tuple(r) for r in J.keep_one(docs.repartition(5)).where("doc_id = 6").collect()}
    assert len(one) == 1 and one == {tuple(r) for r in J.keep_one(docs.coalesce(1)).where("doc_id = 6").collect()}
