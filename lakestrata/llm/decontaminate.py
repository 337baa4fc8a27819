"""Benchmark decontamination by edit distance over words.

Item-sized windows of the texts and the items go through the same CGK random
walks: at each step a walk gives out the word it stands at, and the word and the
step decide whether it moves on. Two sequences a few edits apart soon stand at the
same words again, so their walks agree in many steps, while others agree in none: edit
distance becomes Hamming distance. Locality-sensitive hashing samples a few steps of
each walk as a key; a text window and an item that share a key are verified with the
exact edit distance of the item to the best part of the text nearby.

How many walks a size of items needs is worked out by letting walks run over random
items with the most edits allowed, all of them deletions, the kind that walks survive
worst: in the hardest tenth of items one of the keys is met with probability
``TARGET``. Windows begin at any word, and up to the allowed edits before a text, so
that texts shorter than the item have windows too; beyond both ends stand words that
no item holds.

Only windows where the item can be are embedded: a part of a text within ``e`` edits
of an item of ``n`` words has at most ``n + e`` words and holds at least
``n - 1 - 2 e`` of its word pairs (the q-gram lemma). A fixed-size table of the
benchmark's word pairs tests that without losing a match, in classes of sizes that grow
by a tenth, and a second one drops keys that no item has.

Words are runs of letters and digits of any script in lower case, with the marks
that combine with them; all else, typographic signs too, stands between words. In
scripts written without spaces (Chinese, Japanese, Thai, Lao, Khmer, Burmese) every
letter is a word. Texts are brought to Unicode form NFKC first, and characters that
are not seen within a word, such as the soft hyphen, are left out. An item
matches if the edits are at most ``EDITS`` of its words. Items of fewer than
``MIN_WORDS`` words match nothing: so few words say nothing about their origin.

Defined results: NULL and empty texts and items match nothing; repeated rows
give one result row; a NULL identifier, of a text or an item, is reported as
NULL; with an empty table
nothing matches. Only the identifier and the text are read.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lakestrata.llm.common import Batches, cut_lineage, mix64, pylist, text_of

EDITS = 0.2
MIN_WORDS = 5
CLASS_GROWTH = 1.1
# The tables of word pairs and of keys have this many 16-bit entries each, however large
# the benchmark is. Each bit of an entry stands for every sixteenth class of sizes.
PAIR_PLACES = 1 << 22
CLASS_BITS = 16
# Words searched at a time.
WORDS_AT_ONCE = 400_000
# Probability that an item of the hardest tenth shares a key with a match of the most edits.
TARGET = 0.98
# Steps sampled for a key: the most of these that reach the target with ``FEW_KEYS`` keys, else the fewest.
STEPS, FEW_KEYS = (4, 3, 2), 64
# Symbols of the embeddings held at a time.
SYMBOLS_AT_ONCE = 2_000_000


def _ranges(places, belongs) -> str:
    """The characters at ``places`` that belong, as ranges of a character set."""
    out: list[list[int]] = []
    for place in places:
        if belongs(chr(place)):
            if out and out[-1][1] == place - 1:
                out[-1][1] = place
            else:
                out.append([place, place])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


# Thai and Lao, Burmese, Khmer, Tai, kana, Han.
UNSPACED = [
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3005, 0x3007), (0x3031, 0x312F),
    (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF),
]
_ALONE = _ranges([place for a, b in UNSPACED for place in range(a, b + 1)], str.isalpha) + "\\U00020000-\\U000323af"
_MARKS = _ranges(range(0x300, 0x1F000), lambda c: unicodedata.category(c)[0] == "M")
WORD = re.compile(rf"[^\W_{_ALONE}]+(?:[{_MARKS}]+[^\W_{_ALONE}]*)*|[{_ALONE}][{_MARKS}]*")
# WORD says the same of a text in ASCII.
ASCII_WORD = re.compile(rb"[0-9a-z]+")
UNSEEN = re.compile("[\u00ad\u200c\u200d\u2060\ufeff]")


def words_of(text: str) -> np.ndarray:
    """64-bit hashes of the text's words."""
    if text.isascii():
        found = ASCII_WORD.findall(text.lower().encode())
    else:
        found = WORD.findall(unicodedata.normalize("NFKC", UNSEEN.sub("", text)).lower())
        found = "\n".join(found).encode().split(b"\n") if found else []
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))


def pairs_of(words: np.ndarray) -> np.ndarray:
    """Places of neighbouring words in the table."""
    with np.errstate(over="ignore"):
        mixed = mix64(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    return (mixed & np.uint64(PAIR_PLACES - 1)).astype(np.int64)


def allowed_edits(n_words: int) -> int:
    return int(EDITS * n_words)


def class_of(n_words: int) -> int:
    """The smallest size of the class an item of ``n_words`` words is in."""
    size = MIN_WORDS
    while (following := max(size + 1, int(size * CLASS_GROWTH))) <= n_words:
        size = following
    return size


def walk_length(size: int) -> int:
    """Steps of a walk that are made; most walks have not ended by then."""
    return 3 * size // 2


def walks(size: int, n: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers of ``n`` walks' steps, and the steps each one's key samples."""
    rng = np.random.Generator(np.random.PCG64(size))
    made = walk_length(size)
    sampled = np.sort(rng.random((n, made)).argpartition(steps - 1, axis=1)[:, :steps], axis=1)
    return rng.integers(0, 1 << 31, (n, made), dtype=np.uint32) * np.uint32(2) + np.uint32(1), sampled


def embedded(words: np.ndarray, starts: np.ndarray, size: int, multipliers: np.ndarray) -> np.ndarray:
    """CGK embeddings of the windows of ``size`` words: (walk, step, window).

    ``words`` are 32-bit. A walk that has ended gives out 0.
    """
    n, made = multipliers.shape
    at = np.zeros((n, len(starts)), dtype=np.int32)
    out = np.zeros((n, made, len(starts)), dtype=np.uint32)
    ended = np.append(words, np.uint32(0))
    for step in range(made):
        inside = at < size
        symbol = ended[np.where(inside, starts + at, len(words))]
        out[:, step] = symbol
        with np.errstate(over="ignore"):
            moves = (symbol ^ (symbol >> np.uint32(15))) * multipliers[:, step : step + 1] >> np.uint32(31)
        at += (moves == 1) & inside
    return out


def hit_rate(n_words: int, size: int, edits: int, steps: int, *, items: int = 60, n_walks: int = 16, samples: int = 24) -> float:
    """Probability that one key of ``steps`` samples finds an item of
    ``n_words`` words with that many deletions, in any of the windows around
    the match: that of the hardest tenth of random items, by trial."""
    rng = np.random.Generator(np.random.PCG64([n_words, size, edits]))
    made, hits = walk_length(size), []
    for _ in range(items):
        item, around = (rng.integers(1, 1 << 32, k, dtype=np.uint32) for k in (n_words, 2 * size + 2 * edits))
        left = np.delete(item, rng.choice(n_words, edits, replace=False))
        text = np.concatenate([around[:edits], left, around[edits:]])
        multipliers = rng.integers(0, 1 << 31, (n_walks, made), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        own = embedded(item, np.zeros(1, np.int64), size, multipliers)
        agree = embedded(text, np.arange(2 * edits + 1), size, multipliers) == own
        sampled = rng.random((samples, made)).argpartition(steps - 1, axis=1)[:, :steps]
        hits.append(agree[:, sampled].all(axis=2).any(axis=2).mean())
    return float(np.quantile(hits, 0.1))


@lru_cache(maxsize=None)
def repetitions(n_words: int, size: int, target: float = TARGET) -> tuple[int, int]:
    """(walks, steps sampled of each) that reach the target for items of up to
    ``n_words`` words in the class ``size``."""
    if not 0 < target < 1:
        raise ValueError("the target lies between 0 and 1")
    for steps in STEPS:
        rate = hit_rate(n_words, size, allowed_edits(n_words), steps)
        needed = int(np.ceil(np.log(1 - target) / np.log(1 - min(rate, target)))) if rate > 0 else None
        if needed and (needed <= FEW_KEYS or steps == STEPS[-1]):
            return needed, steps
    raise ValueError(f"no key of two steps finds items of {n_words} words")


def window_keys(words: np.ndarray, starts: np.ndarray, size: int, n_walks: int, steps: int) -> np.ndarray:
    """``n_walks`` bucket keys for every window, a row each."""
    multipliers, sampled = walks(size, n_walks, steps)
    starts = np.asarray(starts, dtype=np.int64)
    keys = np.empty((len(starts), n_walks), dtype=np.uint64)
    first = mix64(np.arange(n_walks, dtype=np.uint64) + np.uint64(size << 20))
    held = max(1, SYMBOLS_AT_ONCE // max(1, multipliers.size))
    for low in range(0, len(starts), held):
        codes = embedded(words, starts[low : low + held], size, multipliers)
        key = np.repeat(first[:, None], codes.shape[2], axis=1)
        with np.errstate(over="ignore"):
            for k in range(steps):
                symbols = codes[np.arange(n_walks), sampled[:, k]].astype(np.uint64)
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + symbols)
        keys[low : low + held] = key.T
    return keys


def folded(words: np.ndarray) -> np.ndarray:
    """32-bit words, none of them 0."""
    return (words >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def item_keys(words: np.ndarray, plan: dict[int, tuple[int, int]]) -> np.ndarray:
    """Keys of an item: its first words, as many as its class has."""
    size = class_of(len(words))
    return window_keys(folded(words), np.zeros(1, np.int64), size, *plan[size])[0]


def best_match(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Least edits between ``item`` and any run of ``words``, and where that
    run ends: one row of the distance table per word of the item."""
    n = len(words)
    row = np.zeros(n + 1, dtype=np.int64)
    steps = np.arange(n + 1)
    for i, word in enumerate(item, 1):
        following = np.empty(n + 1, dtype=np.int64)
        following[0] = i
        following[1:] = np.minimum(row[:-1] + (words != word), row[1:] + 1)
        # Insertions run along the row: a running minimum once the slope is taken out.
        row = np.minimum.accumulate(following - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


def _item_rows(batches: Batches) -> Batches:
    for batch in batches:
        ids, sizes, words = [], [], []
        for item_id, text in zip(pylist(batch, "item_id"), pylist(batch, "text")):
            own = words_of(text)
            if len(own) >= MIN_WORDS:
                ids.append(item_id), sizes.append(len(own)), words.append(own.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(words, pa.binary())],
            names=["item_id", "n_words", "words"],
        )


def _key_rows(plan: dict[int, tuple[int, int]]):
    """Every item with its keys."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keys = [item_keys(np.frombuffer(w, "<u8"), plan).view(np.int64) for w in pylist(batch, "words")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.list_(pa.int64()))], names=[*batch.schema.names, "keys"]
            )

    return run


def class_bit(classes: list[int], size: int) -> int:
    return 1 << (classes.index(size) % CLASS_BITS)


def places_of(keys: np.ndarray) -> np.ndarray:
    """Places of keys in the table, after those of the pairs."""
    return (keys & np.uint64(PAIR_PLACES - 1)).astype(np.int64) + PAIR_PLACES


def _known_rows(classes: list[int]):
    """(place, bit) of the word pairs and the keys of every item."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = set()
            for packed, keys in zip(pylist(batch, "words"), pylist(batch, "keys")):
                words, keys = np.frombuffer(packed, "<u8"), np.array(keys, dtype=np.int64).view(np.uint64)
                bit = class_bit(classes, class_of(len(words)))
                found |= {(int(p), bit) for p in (*pairs_of(words), *places_of(keys))}
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32())], names=["place", "bit"]
            )

    return run


def size_classes(sizes: list[int]) -> list[tuple[int, int, int, int]]:
    """Of items with these numbers of words: (class, words of the longest
    match, least number of pairs a match shares, most edits)."""
    members: dict[int, list[int]] = {}
    for n in sizes:
        members.setdefault(class_of(n), []).append(n)
    return [
        (size, max(n + allowed_edits(n) for n in own), min(n - 1 - 2 * allowed_edits(n) for n in own), max(map(allowed_edits, own)))
        for size, own in sorted(members.items())
    ]


def _found(
    texts: list[np.ndarray], known: np.ndarray, classes: list[tuple[int, int, int, int]], plan: dict[int, tuple[int, int]]
) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each text with windows that share a key with an item: their starts and these keys."""
    # Between texts stand words that no item holds, at least as many as a
    # window can reach out of its text.
    pad = max(size + edits for size, _, _, edits in classes)
    gap = mix64(np.arange(1, pad + 1, dtype=np.uint64))
    words = np.concatenate([part for text in texts for part in (gap, text)] + [gap])
    lengths = np.array([len(t) for t in texts])
    begins = pad + np.concatenate([[0], np.cumsum(lengths + pad)[:-1]])
    ends = begins + lengths
    hits = known[pairs_of(words)]
    hits[begins - 1] = 0
    hits[ends - 1] = 0
    short = folded(words)
    sizes = [size for size, *_ in classes]
    starts, keys = [], []
    for size, longest, shared, edits in classes:
        bit = class_bit(sizes, size)
        upto = np.concatenate([[0], np.cumsum(hits & bit > 0)])
        last = np.minimum(np.arange(len(words)) + longest - 1, len(upto) - 1)
        at = np.flatnonzero(upto[last] - upto >= shared)
        owner = np.searchsorted(begins, at + edits, side="right") - 1
        at = at[(owner >= 0) & (at < ends[owner])]
        if not len(at):
            continue
        found = window_keys(short, at, size, *plan[size])
        row, column = np.nonzero(known[places_of(found)] & bit)
        starts.append(at[row])
        keys.append(found[row, column])
    if not starts:
        return {}
    starts, keys = np.concatenate(starts), np.concatenate(keys).view(np.int64)
    owner = np.searchsorted(begins - pad, starts, side="right") - 1
    # The same start and key may come twice where windows repeat.
    order = np.argsort(owner, kind="stable")
    starts, keys, owner = starts[order], keys[order], owner[order]
    there, firsts = np.unique(owner, return_index=True)
    return {
        int(text): (starts[a:b] - begins[text], keys[a:b]) for text, a, b in zip(there, firsts, [*firsts[1:], len(owner)])
    }


def _windows(table, classes: list[tuple[int, int, int, int]], plan: dict[int, tuple[int, int]]):
    """Rows of the texts with windows that share a key with an item, with all their words."""
    names = ["doc_id", "text_hash", "words", "starts", "keys"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def searched(known, waiting) -> pa.RecordBatch:
        out: list[list] = [[] for _ in names]
        for text, (starts, keys) in _found([w for _, _, w in waiting], known, classes, plan).items():
            doc_id, key, words = waiting[text]
            row = (doc_id, key, words.tobytes(), starts, keys)
            for column, value in zip(out, row):
                column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    def run(batches: Batches) -> Batches:
        known = np.frombuffer(table.value, np.uint16)
        shortest = MIN_WORDS - allowed_edits(MIN_WORDS)
        waiting, size = [], 0
        for batch in batches:
            for doc_id, key, text in zip(pylist(batch, "doc_id"), pylist(batch, "text_hash"), pylist(batch, "text")):
                words = words_of(text)
                if len(words) >= shortest:
                    waiting.append((doc_id, key, words))
                    size += len(words)
                if size >= WORDS_AT_ONCE:
                    yield searched(known, waiting)
                    waiting, size = [], 0
        if waiting:
            yield searched(known, waiting)

    return run


def _verified(batches: Batches) -> Batches:
    """The best match of an item near its windows in a text."""
    names = ["doc_id", "text_hash", "item_id", "n_words", "edits", "word_end"]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        columns = [pylist(batch, c) for c in ("doc_id", "text_hash", "item_id", "words", "item_words", "starts")]
        for doc_id, key, item_id, words, item, starts in zip(*columns):
            words, item = np.frombuffer(words, "<u8"), np.frombuffer(item, "<u8")
            slack = allowed_edits(len(item))
            best = None
            reach = -1
            spans: list[list[int]] = []
            for start in sorted(starts):
                low, high = max(0, start - len(item) - slack), min(len(words), start + len(item) + slack)
                if low <= reach:
                    spans[-1][1] = max(spans[-1][1], high)
                else:
                    spans.append([low, high])
                reach = max(reach, high)
            for low, high in spans:
                edits, end = best_match(item, words[low:high])
                if edits <= slack and (best is None or edits < best[0]):
                    best = (edits, low + end)
            if best:
                for column, value in zip(out, (doc_id, key, item_id, len(item), *best)):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)


def matches(docs: DataFrame, benchmark: DataFrame, *, target: float = TARGET) -> DataFrame:
    """One row per (text, item) that match: ``doc_id``, ``text_hash``,
    ``item_id``, ``n_words`` of the item, ``edits``, ``word_end`` (the number
    of the text's words up to the end of the match)."""
    out = "doc_id long, text_hash long, item_id long, n_words long, edits long, word_end long"
    spark = docs.sparkSession
    items = cut_lineage(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
        .mapInArrow(_item_rows, "item_id long, n_words long, words binary")
        .withColumn("item_row", F.monotonically_increasing_id()),
        "items",
    )
    # Numbers of words, not items, reach the driver.
    sizes = sorted(r["n_words"] for r in items.select("n_words").distinct().collect())
    if not sizes:
        return spark.createDataFrame([], out)
    classes = size_classes(sizes)
    plan = {size: repetitions(max(n for n in sizes if class_of(n) == size), size, target) for size, *_ in classes}
    keyed = cut_lineage(
        items.select("item_row", "words").mapInArrow(_key_rows(plan), "item_row long, words binary, keys array<long>"), "keyed_items"
    )
    table = np.zeros(2 * PAIR_PLACES, dtype=np.uint16)
    bits = keyed.select("words", "keys").mapInArrow(_known_rows([c for c, *_ in classes]), "place long, bit int")
    for row in bits.groupBy("place").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        table[row["place"]] = row["bits"]
    packed = spark.sparkContext.broadcast(table.tobytes())

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    source = source.withColumn("text_hash", F.xxhash64("text"))
    found = cut_lineage(
        source.mapInArrow(
            _windows(packed, classes, plan), "doc_id long, text_hash long, words binary, starts array<long>, keys array<long>"
        ).withColumn("row_id", F.monotonically_increasing_id()),
        "windows",
    )
    known_keys = keyed.select("item_row", F.explode("keys").alias("key"))
    collided = (
        found.select("row_id", "starts", F.posexplode("keys").alias("at", "key"))
        .select("row_id", "key", F.expr("starts[at]").alias("start")).distinct()
        .join(known_keys, "key").groupBy("row_id", "item_row").agg(F.collect_set("start").alias("starts"))
    )
    texts = found.select("row_id", "doc_id", "text_hash", "words")
    candidates = (
        collided.join(texts, "row_id")
        .join(items.select("item_row", "item_id", F.col("words").alias("item_words")), "item_row")
    )
    return candidates.select("doc_id", "text_hash", "item_id", "words", "item_words", "starts").mapInArrow(_verified, out).distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the texts that hold a benchmark item."""
    bad = cut_lineage(matches(docs, benchmark).select(F.col("text_hash").alias("_bad_text")).distinct(), "contaminated")
    return docs.join(bad, F.xxhash64(text_of()) == F.col("_bad_text"), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
