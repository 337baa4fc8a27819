"""Collocations: phrases whose words occur together more often than apart.

N-grams are counted by prefix-free parsing. A document is a row of symbols,
words and piece ends, closed by two piece ends. Wherever the hash of two
neighbouring symbols is divisible by ``EVERY`` a chunk ends, and the next one
begins with the same two symbols; so equal passages give equal chunks wherever
they stand. Distinct chunks form a dictionary with their frequencies, and
n-grams are counted once per distinct chunk, times its frequency. The n-grams
that begin in a chunk's last two symbols belong to the next chunk and are left
to it.

All counts are exact. Pairs are counted by hash first, and a bitmap of a fixed
size holds the frequent ones; n-grams are then counted word for word where all
their pairs may be frequent. An error of the hash or the bitmap costs time and
never a phrase.

Defined results: a NULL text counts as empty, a NULL language as ``und``; texts
of any length are read whole; a repeated row counts each time; an empty table
gives no rows; equal scores go by count, then by the phrase's bytes. Only the
language and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.common import Batches, cut_lineage, mix64, text_of
from lakestrata.operators.dedupe import with_sequence
from lakestrata.operators.joins import broadcast_if_small

EVERY = 24  # symbols of a chunk, about
LONGEST = 3  # words of a phrase
MIN_COUNT = 10
TOP = 2000
SCALE = 1_000_000
# Symbols that one task counts together before it hands the counts on.
GROUP = 3_000_000
LONG_WORD = 16
BITMAP_BITS = 1 << 27
# Rows of a batch that a task hands on.
ROWS = 50_000

END = b"."  # no word holds it
_ENDS = re.compile(rb"[.,;:!?\x0A-\x0D][.,;:!?\x0A-\x0D\x20\x09]*")
_CHUNKS = "lang string, chunk binary, words int, times long"
_NGRAMS = "lang string, size int, phrase binary, times long"


def symbols_of(data: bytes) -> list[bytes]:
    """Words and piece ends of a UTF-8 text; bytes lower A to Z alone."""
    return _ENDS.sub(b" . ", data.lower()).split()


class _Numbers(dict):
    """Numbers symbols as they come."""

    def __missing__(self, symbol: bytes) -> int:
        self[symbol] = n = len(self)
        return n

    def of(self, symbols: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, symbols), dtype=np.int64, count=len(symbols))


def chunks_of(symbols: list[bytes], every: int = EVERY) -> list[tuple[bytes, int]]:
    """The chunks of one document, in order, each with its words before the
    last two symbols. Together they hold every n-gram of up to three symbols
    once that begins before a chunk's last two."""
    if not symbols:
        return []
    symbols = [*symbols, END, END]
    numbers = _Numbers()
    ids = numbers.of(symbols)
    hashes = np.fromiter((zlib.crc32(s) for s in numbers), dtype=np.uint64, count=len(numbers))[ids]
    pairs = mix64(hashes[:-1] << np.uint64(32) | hashes[1:])
    # A chunk ends with the pair at these places; the last pair always ends one.
    ends = np.flatnonzero(pairs[:-1] % np.uint64(every) == 0).tolist()
    words = np.cumsum(ids != numbers[END]) - (ids != numbers[END])
    out, start = [], 0
    for end in [*ends, len(symbols) - 2]:
        if end > start:
            out.append((b" ".join(symbols[start:end + 2]), int(words[end] - words[start])))
            start = end
    return out


def _parse(every: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            counts: Counter = Counter()
            langs = batch.column(0).to_pylist()
            for lang, data in zip(langs, batch.column(1).cast(pa.binary()).to_pylist()):
                counts.update((lang, *chunk) for chunk in chunks_of(symbols_of(data), every))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.binary()),
                 pa.array([k[2] for k in counts], pa.int32()), pa.array(list(counts.values()), pa.int64())],
                names=["lang", "chunk", "words", "times"],
            )

    return run


def dictionary(docs: DataFrame, lang: Column, *, every: int = EVERY) -> DataFrame:
    """Distinct chunks of a language with the number of their occurrences."""
    source = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), text_of().alias("text"))
    return source.mapInArrow(_parse(every), _CHUNKS).groupBy("lang", "chunk", "words").agg(F.sum("times").alias("times"))


def _groups(batches: Batches, most: int) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks of one language at a time: names of the symbols, the symbols'
    numbers, the frequency of each one's chunk, and whether it is among the
    last two of its chunk. Batches are read until they hold ``most`` symbols.
    Number 0 is the end of a piece."""
    kept: list[tuple[pa.Array, pa.ListArray, pa.Array]] = []
    held = 0
    for batch in batches:
        lang, chunk, times = (batch.column(batch.schema.get_field_index(c)) for c in ("lang", "chunk", "times"))
        split = pc.split_pattern(chunk, b" ")
        kept.append((lang, split, times))
        # Very long words count by their bytes.
        held += max(len(split.flatten()), chunk.nbytes // LONG_WORD)
        if held >= most:
            yield from _numbered(kept)
            kept, held = [], 0
    if kept:
        yield from _numbered(kept)


def _numbered(kept: list) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    lang, split, times = (pa.concat_arrays(list(arrays)) for arrays in zip(*kept))
    for one in pc.unique(lang):
        mask = pc.equal(lang, one)
        chunks, each = split.filter(mask), times.filter(mask).to_numpy()
        sizes = pc.list_value_length(chunks).to_numpy()
        coded = pa.concat_arrays([pa.array([END], pa.binary()), chunks.flatten()]).dictionary_encode()
        ids = coded.indices.to_numpy()[1:].astype(np.int64)
        last = np.zeros(len(ids), bool)
        ends = np.cumsum(sizes)
        # Every chunk has two symbols at least.
        last[ends - 1] = last[ends - 2] = True
        yield one.as_py(), coded.dictionary, ids, np.repeat(each, sizes), last


def _starts(ids: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """Places where an n-gram of words alone begins that its chunk counts."""
    ok = ~last
    ok[max(len(ids) - size + 1, 0):] = False
    for k in range(size):
        ok[:len(ids) - k] &= ids[k:] != 0
    return np.flatnonzero(ok)


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their total frequency."""
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(times, first) if len(first) else times


def _rows(lang: str, names: pa.Array, numbers: list[np.ndarray], times: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Phrases with their frequency; ``numbers`` holds those of the first
    words, the second ones, and so on."""
    for at in range(0, len(times), ROWS):
        words = [names.take(pa.array(n[at:at + ROWS])) for n in numbers]
        part = pc.binary_join_element_wise(*words, b" ") if len(words) > 1 else words[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(part), pa.string()), pa.array([len(words)] * len(part), pa.int32()),
             part, pa.array(times[at:at + ROWS], pa.int64())],
            names=["lang", "size", "phrase", "times"],
        )


def _hashes(lang: str, names: pa.Array) -> np.ndarray:
    seed = zlib.crc32(lang.encode())
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in names.to_pylist()), dtype=np.uint64, count=len(names))


def _pair_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring symbols, from those of all symbols."""
    with np.errstate(over="ignore"):
        return mix64(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])


def _count_pairs(most: int) -> Callable[[Batches], Batches]:
    """Counts pairs of words by their hash."""
    def run(batches: Batches) -> Batches:
        for lang, names, ids, times, last in _groups(batches, most):
            at = _starts(ids, last, 2)
            pairs, total = _summed(_pair_hashes(_hashes(lang, names)[ids])[at], times[at])
            for k in range(0, len(pairs), ROWS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[k:k + ROWS].view(np.int64)), pa.array(total[k:k + ROWS])], names=["pair", "times"]
                )

    return run


def _bitmap(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Words of the bitmap that are not zero: places in order, and bits. There
    are at most ``BITMAP_BITS`` / 64 of them, however many pairs there are."""
    place = F.col("pair").bitwiseAND(BITMAP_BITS - 1)
    bits = F.expr(f"shiftleft(1L, CAST(pair & {BITMAP_BITS - 1} & 63 AS INT))")
    held = pairs.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bits).alias("bits"))
    got = held.toArrow()
    words, bits = (got.column(i).to_numpy() for i in range(2))
    order = np.argsort(words)
    return words[order], bits[order].astype(np.int64).view(np.uint64)


def _count_phrases(most: int, bitmap) -> Callable[[Batches], Batches]:
    """Counts words, the pairs that the bitmap holds, and the three words both
    of whose pairs it holds."""
    def run(batches: Batches) -> Batches:
        places, bits = bitmap.value
        whole = np.zeros(BITMAP_BITS // 64, dtype=np.uint64)
        whole[places] = bits
        for lang, names, ids, times, last in _groups(batches, most):
            n = len(names)
            at = _starts(ids, last, 1)
            words, total = _summed(ids[at], times[at])
            yield from _rows(lang, names, [words], total)
            place = _pair_hashes(_hashes(lang, names)[ids]) & np.uint64(BITMAP_BITS - 1)
            held = whole[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1) == 1
            at = _starts(ids, last, 2)
            at = at[held[at]]
            pairs, total = _summed(ids[at] * n + ids[at + 1], times[at])
            yield from _rows(lang, names, [pairs // n, pairs % n], total)
            at = _starts(ids, last, 3)
            at = at[held[at] & held[at + 1]]
            # Pairs numbered in their order, so that three words fit one integer.
            code = np.searchsorted(pairs, ids[at] * n + ids[at + 1])
            keys, total = _summed(code * n + ids[at + 2], times[at])
            head = pairs[keys // n]
            yield from _rows(lang, names, [head // n, head % n, keys % n], total)

    return run


def frequent_ngrams(chunks: DataFrame, *, min_count: int = MIN_COUNT, group: int = GROUP) -> DataFrame:
    """N-grams of one to three words that occur ``min_count`` times or more,
    as lang, size, phrase (its words joined by a space) and f.

    A first pass counts pairs by hash; pairs of equal hash only make a count
    too large, so no frequent pair is missed. The second counts what can be
    frequent, word for word.
    """
    pairs = chunks.mapInArrow(_count_pairs(group), "pair long, times long").groupBy("pair").agg(F.sum("times").alias("f"))
    often = cut_lineage(pairs.where(F.col("f") >= min_count).select("pair"), "frequent_pairs")
    bitmap = chunks.sparkSession.sparkContext.broadcast(_bitmap(often))
    counted = chunks.mapInArrow(_count_phrases(group, bitmap), _NGRAMS)
    total = counted.groupBy("lang", "size", "phrase").agg(F.sum("times").alias("f"))
    return cut_lineage(total.where(F.col("f") >= min_count), "ngrams")


def collocations(
    docs: DataFrame, lang: Column, *, min_count: int = MIN_COUNT, top: int = TOP, every: int = EVERY, group: int = GROUP,
) -> DataFrame:
    """The ``top`` phrases of each language by score, see ``score_phrases``."""
    chunks = cut_lineage(dictionary(docs, lang, every=every), "chunks")
    words = chunks.groupBy("lang").agg(F.sum(F.col("times") * F.col("words")).alias("n"))
    return score_phrases(frequent_ngrams(chunks, min_count=min_count, group=group), words, top=top)


def score_phrases(ngrams: DataFrame, words: DataFrame, *, top: int = TOP) -> DataFrame:
    """Rank the phrases of two and more words.

    Cut in two, a phrase scores ``SCALE * a * a / (l * r)`` from the counts of
    the whole and its parts, rounded down; its lowest cut counts, the first of
    equal ones. A phrase inside a longer one that has at least half its count is
    left out. Counts below 10**15 are computed exactly.
    """
    phrases = ngrams.where("size > 1").select("lang", "phrase", F.col("f").alias("a"))
    cuts = phrases.withColumn("_w", F.split(F.col("phrase").cast("string"), " ")).select(
        "lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size("_w") - 1)).alias("k"), "_w",
    ).select(
        "lang", "phrase", "a", "k", F.size("_w").alias("size"),
        F.array_join(F.slice("_w", F.lit(1), F.col("k")), " ").cast("binary").alias("left"),
        F.array_join(F.slice("_w", F.col("k") + 1, F.size("_w") - F.col("k")), " ").cast("binary").alias("right"),
    )
    count = lambda part, name: ngrams.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    cut = cuts.join(count("left", "l"), ["lang", "left"]).join(count("right", "r"), ["lang", "right"])
    exact = lambda c: F.col(c).cast("decimal(15,0)")
    above = F.lit(SCALE).cast("decimal(7,0)") * (exact("a") * exact("a"))
    score = F.call_function("div", above, exact("l") * exact("r")).cast("long")
    lowest = (
        cut.withColumn("score", score).groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    # A part of a longer phrase: its words without the first or the last.
    within = F.when(F.col("k") == 1, F.col("right")).otherwise(F.col("left"))
    inside = (
        cuts.where(F.col("size") == LONGEST)
        .groupBy("lang", within.alias("phrase")).agg(F.max("a").alias("longer"))
    )
    kept = lowest.join(inside, ["lang", "phrase"], "left").where(F.expr("longer IS NULL OR 100 * longer < 50 * a"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Written once: numbering reads them three times.
    flat = cut_lineage(
        kept.select("lang", F.col("phrase").cast("string").alias("phrase"), "a", "cut.l", "cut.r", "cut.score"), "scored"
    )
    # Numbered over all languages by one range shuffle: no language is one task.
    numbered = with_sequence(flat, ["lang", *order], "rank")
    first = numbered.groupBy("lang").agg(F.min("rank").alias("first"))
    ranked = (
        numbered.join(broadcast_if_small(first), "lang").withColumn("rank", F.col("rank") - F.col("first") + 1)
        .where(F.col("rank") <= top)
    )
    return ranked.join(broadcast_if_small(words), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
