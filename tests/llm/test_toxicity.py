"""Toxic passages: segments against brute force, scores on planted texts."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakestrata.llm import queries, toxicity as T
from lakestrata.llm.common import table

SF = "/root/testdata/sf0.01"


def all_maximal(scores):
    """By definition: the best segment, shortest first, then on both its sides."""
    if not len(scores):
        return []
    best = None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            total = sum(scores[a:b])
            if total > 0 and (best is None or (total, a - b) > best[:2]):
                best = (total, a - b, a, b)
    if best is None:
        return []
    total, _, a, b = best
    left = all_maximal(scores[:a])
    right = [(x + b, y + b, s) for x, y, s in all_maximal(scores[b:])]
    return left + [(a, b, total)] + right


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-8, 8).filter(bool), max_size=14))
def test_segments_equal_their_definition(values):
    # Distinct weights, so that no two segments tie.
    scores = [v + 0.001 * 2.0**-k for k, v in enumerate(values)]
    got = T.maximal_segments(np.array(scores, dtype=float))
    want = all_maximal(scores)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_many_segments_take_linear_time():
    rng = np.random.default_rng(1)
    assert len(T.maximal_segments(rng.normal(-0.3, 1, 400_000))) > 10_000
    assert T.maximal_segments(np.zeros(0)) == [] and T.maximal_segments(np.full(9, -1.0)) == []
    assert T.maximal_segments(np.full(300_000, 0.5)) == [(0, 300_000, 150_000.0)]


def test_evidence():
    assert T.evidence(100, [], 1.0, 0.001) == 0.0
    one = T.evidence(100, [8.0], 1.0, 0.001)
    assert one == pytest.approx(8.0 - np.log(0.1))
    assert T.evidence(100, [8.0, 8.0], 1.0, 0.001) > one and T.evidence(10_000, [8.0], 1.0, 0.001) < one
    assert T.evidence(10**9, [1.0], 1.0, 0.1) == 0.0


def test_words_and_forms():
    assert T.words_of("Don't STOP—été Ünder_score 東京!") == ["don", "t", "stop", "été", "ünder", "score", "東", "京"]
    assert T.words_of("") == [] and T.words_of("?!") == []
    assert T.forms_of("worthless") == ["worthless", "worthles*", "worthle*", "worthl*", "worth*", "wort*"]
    assert T.forms_of("four") == ["four"]


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(6)
    plain = [f"word{k}" for k in range(400)] + ["the"] * 60
    insults = ["blagh", "grumpf", "sknorr", "vexling"]
    docs, labels = [], []
    for i in range(900):
        words = [rng.choice(plain) for _ in range(rng.choice([8, 30, 120, 800]))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            at = rng.randrange(len(words) + 1)
            words[at:at] = [rng.choice(insults) + rng.choice(["", "", "en", "ish"]) for _ in range(rng.randint(2, 4))]
        docs.append((i, " ".join(words).capitalize() + "."))
        if i % 4:
            labels.append((i, toxic))
    rows = docs + [(900, None), (901, ""), (902, "blagh grumpf! " * 3), (902, "the word1 word2"), (None, "You blagh sknorr vexling"), (903, "the " * 100_000 + "blagh sknorr grumpf " * 3 + "word9 " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"toxic": F.lit(1), "half": F.lit("clash"), "score": F.lit(0.5), "_row": F.lit(1)})
    lab = spark.createDataFrame(labels + [(5000, 1), (None, 1), (1, None)], "doc_id long, toxic int")
    return df.repartition(6), lab, dict(docs), {i for i, t in docs if any(x in t.lower() for x in insults)}


def test_planted_passages(planted):
    docs, labels, texts, toxic = planted
    model = T.train(docs, labels)
    rows = T.score(docs, model, keep=["doc_id", "score", "text"]).collect()
    assert len(rows) == docs.count() and rows[0].__fields__ == ["doc_id", "text", "score", "predicted", "passages"]
    own = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 900]
    held = [r for r in own if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    for group in (own, held):
        right = sum(r["predicted"] == (r["doc_id"] in toxic) for r in group)
        assert right >= 0.97 * len(group)
    by_id = {(r["doc_id"], r["text"]): r for r in rows}
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= T.THRESHOLD)
        for p in r["passages"]:
            found = r["text"][p["start"]:p["end"]]
            assert T.words_of(found) and p["expected"] < T.MOST_EXPECTED
            if r["doc_id"] in toxic:
                assert any(x in found.lower() for x in ("blagh", "grumpf", "sknorr", "vexling"))
    assert by_id[900, None]["passages"] == [] == by_id[901, ""]["passages"]
    assert by_id[902, "the word1 word2"]["predicted"] == 0 and by_id[902, "blagh grumpf! " * 3]["predicted"] == 1
    assert by_id[None, "You blagh sknorr vexling"]["predicted"] == 1
    long = next(r for r in rows if r["doc_id"] == 903)
    assert [long["text"][p["start"]:p["end"]] for p in long["passages"]] == ["blagh sknorr grumpf blagh sknorr grumpf blagh sknorr grumpf"]


def test_forms_joined_or_sent_score_alike(planted):
    docs, labels, *_ = planted
    sent, joined = T.train(docs, labels), T.train(docs, labels, sent_forms=3)
    assert sent.sent and joined.sent is None and sent.tail_k == joined.tail_k and sent.slope == joined.slope
    rows = lambda m: sorted(((r["doc_id"] or -1, r["score"], len(r["passages"])) for r in T.score(docs, m, keep=["doc_id"]).collect()))
    assert rows(sent) == rows(joined)


def test_held_out_labels_and_copies_change_nothing(planted):
    docs, labels, *_ = planted
    flipped = labels.withColumn("toxic", F.when(T.crc32_of("doc_id") % T.FOLDS == T.HELD_OUT, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = T.train(docs, labels), T.train(docs.unionByName(docs), flipped.unionByName(flipped))
    assert a.sent == b.sent and (a.tail_rate, a.intercept, a.slope) == (b.tail_rate, b.intercept, b.slope)


def test_without_labels(spark, planted):
    docs, labels, *_ = planted
    none = T.train(docs, labels.limit(0))
    assert {r["score"] for r in T.score(docs, none, keep=["doc_id"]).collect()} == {0.5}
    harmless = T.train(docs, labels.where("toxic = 0"))
    assert all(r["score"] < 0.01 for r in T.score(docs, harmless, keep=["doc_id"]).collect())
    assert T.score(docs.limit(0), T.train(docs.limit(0), labels), keep=["doc_id"]).count() == 0


def test_query_on_the_given_documents(spark):
    rows = {r["doc_id"]: r for r in queries.op13_toxic_segments(spark, SF).collect()}
    labels = [(r["doc_id"], r["toxic"]) for r in table(spark, SF, "labels").collect() if r["doc_id"] in rows]
    held = [(rows[d]["predicted"], t) for d, t in labels if rows[d]["held_out"]]
    assert all(rows[d]["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d in rows)
    assert sum(p for p, t in held if t) >= 0.75 * sum(t for _, t in held)
    assert sum(p for p, t in held if not t) <= 0.03 * sum(1 - t for _, t in held)
