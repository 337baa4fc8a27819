"""Bin completion against optima, and packed documents against the tokenizer."""

from __future__ import annotations

import random
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakestrata.llm import bin_completion as B, packing


def fewest(items, capacity):
    """Brute force over all ways to place the items."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for space in {b for b in bins if b >= items[k]}:
            at = bins.index(space)
            bins[at] -= items[k]
            place(k + 1, bins)
            bins[at] += items[k]
        place(k + 1, [*bins, capacity - items[k]])

    place(0, [])
    return best[0]


def check(counts, packed, capacity):
    held = Counter()
    for pattern, bins in packed:
        assert sum(pattern) <= capacity and bins > 0
        for n in pattern:
            held[n] += bins
    assert held == Counter({n: c for n, c in counts.items() if c})


def test_small_packings_are_optimal():
    rng = random.Random(8)
    for _ in range(250):
        capacity = rng.choice([10, 20, 50, 100])
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 11)))
        packed = B.pack(counts, capacity)
        check(counts, packed, capacity)
        best = fewest(list(counts.elements()), capacity)
        assert B.lower_bound(counts, capacity) <= best == B.bins_of(packed) <= B.bins_of(B.best_fit(counts, capacity))


def test_large_packing_is_close_to_the_bound():
    rng = random.Random(1)
    counts = Counter(min(2048, max(1, int(rng.lognormvariate(6.3, 0.9)))) for _ in range(20_000))
    packed = B.pack(counts, 2048)
    check(counts, packed, 2048)
    assert B.bins_of(packed) <= min(B.bins_of(B.best_fit(counts, 2048)), 1.002 * B.lower_bound(counts, 2048) + 1)


def test_dominated_fillings_are_left_out():
    assert B.fillings({60: 1, 30: 2, 20: 1}, [20, 30, 60], 60, 100, [0]) == [(60,)]
    assert (30, 20) not in B.fillings({30: 2, 20: 1}, [20, 30], 60, 100, [0])
    with pytest.raises(ValueError):
        B.pack({11: 1}, 10)


TEXTS = ["", None, "hello", "a b c " * 900, "x" * 9000, "naïve 中文 🙂 <|endoftext|>", "hello", " \n" * 50] + [f"text number {k} " * (k % 37) for k in range(120)]


@pytest.fixture(scope="module")
def packed(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("length", F.lit("clash"))
    return packing.pack_documents(df.repartition(4), capacity=256).collect()


def test_pieces_hold_the_tokenizer_ids(packed):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    pieces = defaultdict(list)
    for r in packed:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(range(len(TEXTS)))
    for doc_id, text in enumerate(TEXTS):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        own = sorted(pieces[doc_id], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [r["start"] for r in own] == [sum(q["length"] for q in own[:k]) for k in range(len(own))]
        assert sum(r["length"] for r in own) == len(ids) and all(r["length"] == 256 for r in own[1:])
        for r in own:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))


def test_sequences_are_gapless_and_few(packed):
    places = defaultdict(list)
    for r in packed:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for rows in places.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 256
    counts = Counter(r["length"] for r in packed)
    assert len(places) == B.bins_of(B.pack(counts, 256)) <= B.bins_of(B.best_fit(counts, 256))


def test_numbers_of_a_hot_length_are_dealt_over_cells(spark, monkeypatch):
    monkeypatch.setattr(packing, "NUMBERED", 7)
    rows = [(k % 30, 0, 5 if k % 3 else 6, k % 4) for k in range(300)] + [(None, 0, 5, 1)] * 3
    df = spark.createDataFrame(rows, "doc_id long, piece int, length long, ids_crc32 long")
    out = packing.numbered(df, 203)
    numbers = defaultdict(list)
    for r in out.collect():
        numbers[r["length"]].append(r["number"])
    assert {n: sorted(v) for n, v in numbers.items()} == {5: list(range(203)), 6: list(range(100))}


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("text", [" " * 1_000_000, "\n" * 1_000_000, "a" * 1_000_000, "!?" * 500_000, " \u00a0\t\n" * 250_000 + "end"])
def test_long_runs_get_the_tokenizer_ids(spark, text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
    df = spark.createDataFrame([(1, text), (2, "harmless")], "doc_id long, text string")
    rows = sorted((r for r in packing.pack_documents(df).collect() if r["doc_id"] == 1), key=lambda r: r["piece"])
    assert sum(r["length"] for r in rows) == len(ids)
    for r in rows:
        part = ids[r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))


def test_white_runs_are_seen_wherever_they_begin():
    block = packing.WHITE_BLOCK
    for before in (0, 1, block - 1, block + 7):
        assert packing.has_long_white_run("x" * before + " " * (2 * block) + "x")
    assert not packing.has_long_white_run(("x" + " " * (block - 1)) * 5) and not packing.has_long_white_run("")


def test_search_beats_best_fit_and_prunes_by_waste():
    rng = random.Random(4)
    counts = Counter(rng.randint(400, 900) for _ in range(2_000))
    packed = B.pack(counts, 2048)
    check(counts, packed, 2048)
    assert B.lower_bound(counts, 2048) <= B.bins_of(packed) < B.bins_of(B.best_fit(counts, 2048))
    # A filling that wastes more than is to spare is not listed.
    assert B.fillings({500: 1}, [500], 600, 99, [0]) == [] and B.fillings({500: 1}, [500], 600, 100, [0]) == [(500,)]
