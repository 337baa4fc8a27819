"""Collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakestrata.llm import phrases as P


def plain_ngrams(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = Counter()
    for piece in re.split("[.,;:!?\n-\r]", lowered):
        words = re.findall("[^ \t]+", piece)
        for size in (1, 2, 3):
            found.update((size, " ".join(words[k:k + size])) for k in range(len(words) - size + 1))
    return found


def brute(rows, least=10, top=2000):
    counts = {}
    for text, lang in rows:
        counts.setdefault(lang if lang is not None else "und", Counter()).update(plain_ngrams(text))
    out = set()
    for lang, found in counts.items():
        f = {p: n for (_, p), n in found.items()}
        n = sum(c for (size, _), c in found.items() if size == 1)
        candidates = {p: c for (size, p), c in found.items() if size > 1 and c >= least}
        ranked = []
        for p, a in candidates.items():
            w = p.split(" ")
            cuts = [(1_000_000 * a * a // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            inside = any(f" {p} " in f" {q} " and len(q.split(" ")) > len(w) and 100 * b >= 50 * a for q, b in candidates.items())
            if not inside:
                ranked.append((-score, -a, p.encode(), f[" ".join(w[:k])], f[" ".join(w[k:])]))
        for rank, (score, a, p, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.add((lang, rank, p.decode(), -a, l, r, n, -score))
    return out


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB cé.\n\t\x0b,x", max_size=60), st.sampled_from([1, 2, 3, 50]))
def test_chunks_hold_every_ngram_once(text, every):
    want = plain_ngrams(text)
    found, words = Counter(), 0
    for chunk, n in P.chunks_of(P.symbols_of(text.encode()), every):
        symbols, words = chunk.split(b" "), words + n
        for start in range(len(symbols) - 2):
            for size in (1, 2, 3):
                part = symbols[start:start + size]
                if P.END not in part and len(part) == size:
                    found[size, b" ".join(part).decode()] += 1
    assert found == want
    assert words == sum(c for (size, _), c in want.items() if size == 1)


def test_equal_passages_give_equal_chunks():
    rng = random.Random(3)
    words = lambda n: [b"w%d" % rng.randrange(300) for _ in range(n)]
    shared = words(600)
    one, other = (P.chunks_of(words(50) + shared + words(50)) for _ in range(2))
    common = {c for c, _ in one} & {c for c, _ in other}
    assert sum(len(c.split()) for c in common) > 500


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    pool = ["new", "york", "city", "the", "of", "in", "Straße", "été", "x.y", "a|b"]
    line = lambda: "".join(rng.choice(pool) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n"]) for _ in range(rng.randint(0, 40)))
    out = [(line(), rng.choice(["en", "de", None, "und"])) for _ in range(250)]
    out += [("new york city " * 30, "en")] * 20 + [(None, "en"), ("", None), ("Only Once", "fr")]
    # Pairs that occur only inside one longer phrase, and a tie in score and count.
    out += [("red green blue. alpha beta. gamma delta.", "es")] * 12
    return out


def collocated(spark, rows, **kw):
    df = spark.createDataFrame(rows, "text string, lang string").withColumns({"phrase": F.lit("clash"), "times": F.lit(1)})
    return [tuple(r) for r in P.collocations(df.repartition(5), F.col("lang"), **kw).collect()]


def test_collocations_equal_plain_counting(spark, rows):
    got = collocated(spark, rows)
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    es = [(r[1], r[2]) for r in sorted(got) if r[0] == "es"]
    assert es == [(1, "alpha beta"), (2, "gamma delta"), (3, "red green blue")]


def test_small_groups_short_chunks_and_a_full_bitmap(spark, rows, monkeypatch):
    want = brute(rows, 5, 7)
    assert set(collocated(spark, rows, min_count=5, top=7, every=1, group=50)) == want
    # Every pair looks frequent: more is counted, the result is the same.
    monkeypatch.setattr(P, "BITMAP_BITS", 64)
    assert set(collocated(spark, rows, min_count=5, top=7, every=1000)) == want


def test_groups_number_whole_batches_and_end_at_long_words():
    chunks = [("en", b". a b a .", 3), ("de", b"a x", 2), ("en", b"b c", 5)]
    batch = lambda rows: pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64())],
        names=["lang", "chunk", "times"],
    )
    (en, names, ids, times, last), de = P._groups(iter([batch(chunks)]), 100)
    assert (en, de[0]) == ("en", "de") and names[0].as_py() == P.END
    assert [names[i].as_py() for i in ids.tolist()] == [b".", b"a", b"b", b"a", b".", b"b", b"c"]
    assert times.tolist() == [3] * 5 + [5] * 2 and last.tolist() == [False] * 3 + [True] * 4
    long = [batch([("en", b"w%d " % k + b"x" * 5_000, 1)]) for k in range(4)]
    assert len(list(P._groups(iter(long), 300))) == 4


def test_very_long_text_and_empty_table(spark):
    text = "one two three, " * 40_000
    assert set(collocated(spark, [(text, "en")])) == brute([(text, "en")])
    assert collocated(spark, [(text, "en")][:0] or [(None, None)]) == []
    empty = spark.createDataFrame([], "text string, lang string")
    assert P.collocations(empty, F.col("lang")).count() == 0


def test_products_beyond_64_bits_are_exact(spark):
    big = [("en", 1, b"a", 10**13 + 7), ("en", 1, b"b", 10**13 + 9), ("en", 2, b"a b", 10**13 + 1), ("en", 1, b"c", 999_999_999_999), ("en", 2, b"b c", 999_999_999_998)]
    ngrams = spark.createDataFrame(big, "lang string, size int, phrase binary, f long")
    words = spark.createDataFrame([("en", 10**14)], "lang string, n long")
    got = {r["phrase"]: r["score"] for r in P.score_phrases(ngrams, words).collect()}
    a, l, r = 10**13 + 1, 10**13 + 7, 10**13 + 9
    assert got["a b"] == 10**6 * a * a // (l * r)
    assert got["b c"] == 10**6 * 999_999_999_998**2 // (r * 999_999_999_999)
