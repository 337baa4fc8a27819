"""Document fingerprints by winnowing.

All k-grams of a text's code points get a rolling hash. Of every ``WINDOW``
consecutive hashes the smallest is chosen, the rightmost one among equals, and
kept with its position. Two texts that share a run of at least
``WINDOW + GRAM - 1`` code points share a fingerprint of it. A text shorter
than a k-gram is one gram; one with fewer grams than a window is one window.

A fingerprint is written as 16 hex digits per chosen gram, 8 of its hash and 8
of its position, in order of position. Likeness is the Jaccard coefficient of
the chosen hashes; two empty fingerprints are alike (1.0).

``with_edits`` compares every document with an edited form of itself that
takes its second half from the next document, by descending identifier.

Defined results: NULL and empty texts have an empty fingerprint; rows of equal
identifiers follow one another in the order of their texts' hashes; a row
without identifier has no place in the order, so its next document is itself;
an empty table gives no rows. Only the identifier and the text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.common import Batches, mix64, pylist, text_of, utf32

GRAM = 16
WINDOW = 33
BASE = np.uint64(0x100000001B3)
# Documents of one range of identifiers that a task compares in order.
RANGE_ROWS = 2_000
MAX_RANGES = 10_000


def gram_hashes(text: str, gram: int = GRAM) -> np.ndarray:
    """Polynomial hashes of all k-grams, mod 2**64, each half from two halves."""
    codes = utf32(text).astype(np.uint64) + np.uint64(1)
    if not len(codes):
        return codes
    if len(codes) < gram:
        codes = np.concatenate([codes, np.zeros(gram - len(codes), np.uint64)])
    with np.errstate(over="ignore"):
        hashes, length, power = codes, 1, BASE
        while length < gram:
            hashes = hashes[:-length] * power + hashes[length:]
            power, length = power * power, 2 * length
    return mix64(hashes) >> np.uint64(32)


def winnowed(text: str, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes (32 bits) and their positions."""
    hashes = gram_hashes(text)
    n = len(hashes)
    if not n:
        return hashes, np.zeros(0, np.int64)
    window = min(window, n)
    # The position of the smallest hash of ever longer windows; the right one wins a tie.
    best, length = np.arange(n), 1
    while length < window:
        step = min(length, window - length)
        left, right = best[:-step], best[step:]
        best = np.where(hashes[right] <= hashes[left], right, left)
        length += step
    chosen = best[np.concatenate([[True], best[1:] != best[:-1]])]
    return hashes[chosen], chosen


def written(hashes: np.ndarray, positions: np.ndarray) -> str:
    out = np.empty((len(hashes), 2), dtype=">u4")
    out[:, 0], out[:, 1] = hashes, positions
    return out.tobytes().hex()


def read(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of a written fingerprint."""
    rows = np.frombuffer(bytes.fromhex(fingerprint), dtype=">u4").reshape(-1, 2)
    return rows[:, 0].astype(np.uint64), rows[:, 1].astype(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard coefficient of two sorted arrays of distinct hashes."""
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every row."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            values = [written(*winnowed(t)) for t in pylist(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.string())], names=["doc_id", "fingerprint"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return source.mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by as much of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compared(batches: Batches) -> Batches:
    """Rows come in order of their range and rank; each is compared with the
    row after it. A range ends with the row that follows it (``closing``)."""
    names = [c.split()[0] for c in EDITED.split(", ")]

    def known(text: str):
        hashes, positions = winnowed(text)
        return text, written(hashes, positions), np.unique(hashes)

    before = None  # (range, doc_id, known) still waiting for its next row
    for batch in batches:
        out: list[list] = [[] for _ in names]

        def add(doc_id, own, following) -> None:
            changed = known(edited(own[0], following[0]))
            row = (
                doc_id, len(own[0]), hashlib.sha256(changed[0].encode("utf-8", "surrogatepass")).hexdigest(), own[1], changed[1],
                likeness(own[2], changed[2]), likeness(own[2], following[2]),
            )
            for column, value in zip(out, row):
                column.append(value)

        columns = [pylist(batch, c) for c in ("range", "doc_id", "closing", "text")]
        for range_, doc_id, closing, text in zip(*columns):
            own = known(text)
            if range_ < 0:
                add(doc_id, own, own)
                continue
            if before is not None and before[0] == range_:
                add(before[1], before[2], own)
            before = None if closing else (range_, doc_id, own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64() if k < 2 else pa.float64() if k > 4 else pa.string()) for k, c in enumerate(out)], names=names
        )


def _bounds(ids: DataFrame) -> list[int]:
    """Identifiers that cut the table into ranges of about ``RANGE_ROWS`` rows."""
    ranges = min(MAX_RANGES, ids.count() // RANGE_ROWS)
    if ranges < 2:
        return []
    shares = [k / ranges for k in range(1, ranges)]
    return sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 10 * ranges)).first()[0]))


def _range_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many bounds lie below an identifier, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    step = 100
    pages = [bounds[k : k + step] for k in range(0, len(bounds), step)]
    last_of_page = F.lit([p[-1] for p in pages])
    page = F.size(F.filter(last_of_page, lambda b: b < doc_id))
    within = F.get(F.lit(pages), page)
    return page * step + F.coalesce(F.size(F.filter(within, lambda b: b < doc_id)), F.lit(0))


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike its
    own is to the edited one's and to the next document's.

    The texts are shuffled once, into ranges of identifiers. The first row of
    a range in descending order is also what follows the range above it, so it
    is sent there as well; only its identifier passes the driver.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    source = source.withColumn("rank", F.xxhash64("text"))
    named = source.where(F.col("doc_id").isNotNull())
    bounds = _bounds(named.select("doc_id"))
    placed = named.withColumn("range", _range_of(F.col("doc_id"), bounds))
    tops = placed.groupBy("range").agg(F.max(F.struct("doc_id", "rank")).alias("top")).orderBy("range").collect()
    # The highest row of a range closes the range above; that of the highest closes the lowest.
    closes = [(r["top"]["doc_id"], r["top"]["rank"], tops[(k + 1) % len(tops)]["range"]) for k, r in enumerate(tops)]
    # One row a range: MAX_RANGES rows at most.
    targets = F.broadcast(spark.createDataFrame(closes, "doc_id long, rank long, target int"))
    closing = (
        placed.join(targets, ["doc_id", "rank"]).dropDuplicates(["target"])
        .select("doc_id", "text", "rank", F.col("target").alias("range"), F.lit(True).alias("closing"))
    )
    rows = placed.withColumn("closing", F.lit(False)).unionByName(closing)
    ordered = rows.repartition(max(1, len(tops)), "range").sortWithinPartitions(
        "range", "closing", F.desc("doc_id"), F.desc("rank")
    )
    alone = source.where(F.col("doc_id").isNull()).withColumns({"range": F.lit(-1), "closing": F.lit(False)})
    columns = ["range", "doc_id", "closing", "text"]
    return ordered.select(*columns).mapInArrow(_compared, EDITED).unionByName(alone.select(*columns).mapInArrow(_compared, EDITED))
