"""Benchmark decontamination against exact edit distances."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import decontaminate as D


def distance_to_best_part(item, words):
    """Brute force: the table of edits, item against any run of words."""
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        following = [i]
        for j, b in enumerate(words, 1):
            following.append(min(row[j - 1] + (a != b), row[j] + 1, following[j - 1] + 1))
        row = following
    return min(row)


def test_best_match_equals_the_plain_table():
    rng = random.Random(3)
    for _ in range(200):
        item = [rng.randrange(5) for _ in range(rng.randint(1, 8))]
        words = [rng.randrange(5) for _ in range(rng.randint(0, 15))]
        edits, end = D.best_match(np.array(item, np.uint64), np.array(words, np.uint64))
        assert edits == distance_to_best_part(item, words)
        assert min(distance_to_best_part(item, words[k:end]) for k in range(end + 1)) == edits


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        k = rng.randrange(len(words))
        roll = rng.random()
        if roll < 0.4:
            words[k] = f"zq{rng.randrange(999)}"
        elif roll < 0.7 and len(words) > 1:
            del words[k]
        else:
            words.insert(k, f"xk{rng.randrange(999)}")
    return words


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(11)
    vocabulary = [f"word{k}" for k in range(500)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, some(rng.randint(6, 60))) for k in range(40)]
    docs, truth = [], {}
    for i in range(400):
        item, words = items[i % 40]
        host = some(rng.randint(0, 120))
        if i < 300:
            at = rng.randint(0, len(host))
            docs.append((i, " ".join(host[:at] + edited(rng, words, rng.randint(0, D.allowed_edits(len(words)))) + host[at:])))
            truth[i] = item
        else:
            docs.append((i, " ".join(host)))
    bench = spark.createDataFrame([(k, " ".join(w).upper() + "!") for k, w in items], "item_id long, text string")
    return spark.createDataFrame(docs, "doc_id long, text string"), bench, truth, dict(docs), dict(items)


def test_recall_and_exactness(planted):
    docs, bench, truth, texts, items = planted
    found = D.matches(docs.withColumn("words", F.lit("clash")), bench).collect()
    got = {(r["doc_id"], r["item_id"]): r for r in found}
    assert sum(pair in got for pair in truth.items()) >= 0.97 * len(truth)
    for (doc, item), r in got.items():
        edits = distance_to_best_part(items[item], texts[doc].split())
        assert r["edits"] >= edits and r["edits"] <= D.allowed_edits(len(items[item])) == int(0.2 * r["n_words"])
    assert not {doc for doc, _ in got} - set(truth)


def test_contaminated_documents_go_and_others_stay(planted):
    docs, bench, truth, texts, _ = planted
    left = {r["doc_id"] for r in D.drop_contaminated(docs, bench).collect()}
    assert left >= set(range(300, 400)) and len(left - set(range(300, 400))) <= 0.03 * len(truth)


def test_near_and_far_embeddings():
    rng = np.random.default_rng(1)
    words = D.folded(rng.integers(1, 2**63, 40, dtype=np.uint64))
    other = words.copy()
    other[20] = 5
    far = D.folded(rng.integers(1, 2**63, 40, dtype=np.uint64))
    start = np.zeros(1, np.int64)
    same = lambda a, b: int((D.window_keys(a, start, 39, 48, 4) == D.window_keys(b, start, 39, 48, 4)).sum())
    assert same(words, words) == 48 > same(words, other) > 0 == same(words, far)
    many = np.arange(10_000) % 3
    longer = np.concatenate([words, words])
    keys = D.window_keys(longer, many, 39, 48, 4)
    assert (keys == D.window_keys(longer, np.arange(3), 39, 48, 4)[many]).all()


def test_a_walk_by_its_definition():
    """One walk step by step in plain integers; past the window it gives out 0."""
    rng = np.random.default_rng(2)
    words = D.folded(rng.integers(1, 2**63, 30, dtype=np.uint64))
    multipliers, sampled = D.walks(12, 5, 4)
    got = D.embedded(words, np.array([3, 25]), 12, multipliers)
    assert sampled.shape == (5, 4) and (sampled < D.walk_length(12)).all()
    for walk in range(5):
        for column, start in enumerate((3, 25)):
            at = 0
            for step in range(D.walk_length(12)):
                inside = at < 12
                symbol = int(words[start + at]) if inside and start + at < 30 else 0
                assert got[walk, step, column] == symbol
                if inside:
                    at += ((symbol ^ symbol >> 15) * int(multipliers[walk, step]) & 0xFFFFFFFF) >> 31


def test_more_edits_take_more_walks():
    few, many = D.hit_rate(30, 30, 1, 4), D.hit_rate(30, 30, 6, 4)
    assert 1 > few > many > 0
    walks_, steps = D.repetitions(30, 30)
    assert 1 - (1 - D.hit_rate(30, 30, 6, steps)) ** walks_ >= D.TARGET
    assert D.repetitions(30, 30, 0.5)[0] < walks_


def test_odd_rows(spark):
    item = "one two three four five six seven eight"
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "one two"), (None, "alpha beta gamma delta epsilon zeta")], "item_id long, text string")
    rows = [(1, None), (2, ""), (None, f"so {item} so"), (4, item), (4, item), (5, "one two"), (6, "x " * 50_000 + item), (7, "alpha beta gamma delta epsilon zeta")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", F.lit("clash"))
    got = sorted(((r["doc_id"], r["item_id"], r["edits"]) for r in D.matches(docs, bench).collect()), key=repr)
    assert got == sorted([(None, 1, 0), (4, 1, 0), (6, 1, 0), (7, None, 0)], key=repr)
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 5]
    assert D.matches(docs, bench.limit(0)).count() == 0 == D.matches(docs.limit(0), bench).count()
    assert D.drop_contaminated(docs, bench.limit(0)).count() == len(rows)


def shortened(rng, words, edits):
    gone = set(rng.sample(range(len(words)), edits))
    return [w for k, w in enumerate(words) if k not in gone]


def test_items_with_words_missing_alone_and_at_the_end_of_a_text(spark):
    """Texts shorter than the item, and passages that end with the text."""
    rng = random.Random(5)
    items = {n: [f"w{rng.randrange(400)}" for _ in range(n)] for n in range(5, 61)}
    docs = []
    for n, words in items.items():
        for edits in {1, D.allowed_edits(n)}:
            before = [f"other{rng.randrange(400)}" for _ in range(90)]
            docs += [(n, shortened(rng, words, edits)), (n, before + shortened(rng, words, edits))]
    got = found_pairs(spark, items, [words for _, words in docs])
    assert got >= {(k, n) for k, (n, _) in enumerate(docs)}


def found_pairs(spark, items, texts):
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in D.matches(docs, bench).collect()}


@pytest.mark.parametrize("kind", ["substitutions", "deletions", "insertions", "mixed"])
def test_every_match_is_found_at_the_largest_number_of_edits(spark, kind):
    """Exactly the allowed edits of one kind, items up to 200 words, against brute force."""
    rng = random.Random(kind)
    vocabulary = [f"v{k}" for k in range(300)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {k: some(n) for k, n in enumerate([5, 9, 10, 15, 19, 24, 30, 40, 50, 59, 100, 101, 150, 200])}
    texts = []
    for words in items.values():
        for _ in range(3):
            passage = list(words)
            for k in sorted(rng.sample(range(len(words)), D.allowed_edits(len(words))), reverse=True):
                how = rng.choice(["substitutions", "deletions", "insertions"]) if kind == "mixed" else kind
                passage[k : k + 1] = {"substitutions": ["new"], "deletions": [], "insertions": ["new", passage[k]]}[how]
            texts.append(some(40) + passage + some(40))
    near = {
        (t, k) for t, words in enumerate(texts) for k, item in items.items()
        if distance_to_best_part(item, words) <= D.allowed_edits(len(item))
    }
    assert near >= {(t, t // 3) for t in range(len(texts))}
    assert found_pairs(spark, items, texts) == near


def test_words_of_any_script(spark):
    same = lambda a, b: D.words_of(a).tolist() == D.words_of(b).tolist()
    assert same("It\u2019s \u201cone\u201d\u2014two\u00a0three\u2026 co\u00adop", 'its "one" - two three... coop'.replace("its", "it's"))
    assert same("Re\u0301sume\u0301 \uff21\uff22\uff0c\uff11", "r\u00e9sum\u00e9 AB, 1") and same("snake_case", "snake case")
    assert len(D.words_of("\u0939\u093f\u0928\u094d\u0926\u0940 \u092d\u093e\u0937\u093e")) == 2  # Hindi marks are no ends
    assert len(D.words_of("GPT4\u662f\u4ec0\u4e48\u3002\ud55c\uad6d\uc5b4")) == 5 and same("...", "") and same("\u3002", "")
    mixed = "".join(chr(c) for c in range(32, 127))
    assert D.words_of(mixed).tolist() == D.words_of(mixed + "\u2014").tolist()  # both expressions
    items = {
        1: "\u6c34\u5728\u6807\u51c6\u5927\u6c14\u538b\u4e0b\u7684\u6cb8\u70b9\u662f\u591a\u5c11\u6444\u6c0f\u5ea6\uff1f",
        2: "\u6771\u4eac\u306f\u65e5\u672c\u306e\u9996\u90fd\u3067\u3059\u304b",
        3: "\u0e01\u0e23\u0e38\u0e07\u0e40\u0e17\u0e1e\u0e40\u0e1b\u0e47\u0e19\u0e40\u0e21\u0e37\u0e2d\u0e07\u0e2b\u0e25\u0e27\u0e07",
        4: "\u662f\u6c34",
    }
    docs = [(k, f"\u95ee\u9898\uff1a{text}\u3002\u7b54") for k, text in items.items()]
    docs.append((5, items[1].replace("\u591a", "").replace("\u7684", "\u4e4b")))
    docs.append((6, "\u5b8c\u5168\u4e0d\u540c\u7684\u4e00\u6bb5\u6587\u5b57\uff0c\u6ca1\u6709\u5173\u7cfb"))
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["edits"]) for r in D.matches(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == {(1, 1, 0), (2, 2, 0), (3, 3, 0), (5, 1, 2)}
