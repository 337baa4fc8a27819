"""Quality classifier and line dedup."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import line_dedup, quality_gbt, queries
from lakestrata.llm.common import table

SF = "/root/testdata/sf0.01"
WORDS = "the report says that trade grew by more than half while prices for grain and wool fell in all ports".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def junk(rng, n):
    return " | ".join(rng.choice(WORDS).upper() + "$$$" for _ in range(n))


@pytest.fixture(scope="module")
def small(spark):
    rng = random.Random(4)
    good = [(i, prose(rng, 40)) for i in range(150)]
    bad = [(1000 + i, junk(rng, 40)) for i in range(60)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad], "doc_id long, quality int")
    return docs, labels


def walk(forest, x):
    """Brute force: every tree by itself, a row at a time."""
    total = forest.bias
    for root in forest.roots:
        node = root
        while forest.left[node] != node:
            node = forest.left[node] if x[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
        total += forest.value[node]
    return 1 / (1 + np.exp(-total))


def test_scores_equal_a_walk_through_every_tree(small):
    docs, labels = small
    forest = quality_gbt.train(docs, labels)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality_gbt.score(docs, forest, keep=["doc_id"]).collect():
        assert r["score"] == pytest.approx(walk(forest, quality_gbt.document_statistics(rows[r["doc_id"]])), abs=1e-9)
        assert r["predicted"] == int(r["score"] >= 0.3) == int(r["doc_id"] < 1000)


def test_held_out_rows_are_not_learned_from(small):
    docs, labels = small
    flipped = labels.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    one, two = quality_gbt.train(docs, labels), quality_gbt.train(docs, flipped)
    assert one.value.tolist() == two.value.tolist()


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    rows = queries.op10_quality_classifier(spark, SF).collect()
    assert len(rows) == table(spark, SF, "documents").count()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_odd_rows_are_scored(spark, small):
    docs, labels = small
    forest = quality_gbt.train(docs, labels)
    odd = spark.createDataFrame(
        [(1, None, 9.0), (None, "", 9.0), (2, "x" * 200_000, 9.0), (2, "x" * 200_000, 9.0), (3, " \n\t", 9.0)],
        "doc_id long, text string, score double",
    )
    rows = quality_gbt.score(odd, forest, keep=["doc_id", "score"]).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    assert quality_gbt.score(odd.limit(0), forest, keep=["doc_id"]).count() == 0
    assert quality_gbt.keep_good(odd, labels.limit(0)).columns == odd.columns
    assert quality_gbt.keep_good(odd, labels.limit(0)).count() == 5  # no labels: 0.5 for all
    unlabelled = quality_gbt.train(docs.limit(0), labels)
    assert {r["score"] for r in quality_gbt.score(odd, unlabelled, keep=["doc_id"]).collect()} == {0.5}


def brute_lines(rows, ratio, min_pages):
    hosts = {}
    for _, text, host in rows:
        hosts.setdefault(host, set()).add(text or "")
    out = []
    for key, text, host in rows:
        pages = hosts[host]
        bad = set()
        for line in {x.strip(" ") for x in (text or "").split("\n")} - {""}:
            held = sum(line in {x.strip(" ") for x in p.split("\n")} for p in pages)
            if held >= min_pages and held > ratio * len(pages):
                bad.add(line)
        lines = (text or "").split("\n")
        kept = [x for x in lines if x.strip(" ") not in bad]
        out.append((key, text if len(kept) == len(lines) else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(7)
    pool = [f"line {i}" for i in range(30)] + ["menu", " menu ", "", "  ", "footer"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 8))), rng.choice(["a", "a", "b", None])) for i in range(80)]
    rows += [(200, None, "a"), (201, None, None), (202, "", "b"), (None, "menu\nown", "a"), (5, "menu\nown", "a"), (5, "menu\nown", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_lines", F.lit("clash"))
    for ratio, least in ((0.05, 5), (0.3, 2)):
        out = line_dedup.drop_boilerplate(df, F.col("source"), ratio=ratio, min_pages=least)
        got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()), key=repr)
        assert got == brute_lines(rows, ratio, least)


def test_copies_of_a_page_are_not_its_boilerplate(spark):
    rows = [(i, "same page\nsecond line", "h") for i in range(50)] + [(100 + i, f"page {i}", "h") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = line_dedup.dedup_documents(df)
    assert out.columns == df.columns and sorted(map(tuple, out.collect())) == sorted(rows)
    assert line_dedup.dedup_documents(df.limit(0)).count() == 0


def test_small_hosts_lose_their_boilerplate_too(spark):
    rows = [(i, f"Menu\nown text {i}", "small") for i in range(4)] + [(9, "Menu\nalone", "single")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = {r["doc_id"]: r["text"] for r in line_dedup.dedup_documents(df).collect()}
    assert left == {**{i: f"own text {i}" for i in range(4)}, 9: "Menu\nalone"}
