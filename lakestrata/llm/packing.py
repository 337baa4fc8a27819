"""Best-fit packing of tokenized documents into sequences of fixed length.

Documents become token ids closed by an end id; one longer than a sequence is
cut, the first piece taking the remainder. Only the histogram of lengths, at
most one row per length up to the capacity, reaches the driver, where bin
completion turns it into patterns. Pieces of one length are numbered and the
numbers dealt to the places of that length in the patterns.

Defined results: a NULL or empty text is the end id alone; repeated rows are
each packed; a NULL identifier stays NULL; an empty table gives no rows. Texts of
any length and of any characters, long white runs too, get their ids whole. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lakestrata.llm.bin_completion import Packing, pack
from lakestrata.llm.common import Batches, cut_lineage, pylist, text_of

CAPACITY = 2048
END_ID = 0
VOCABULARY = "byte_bpe_50k.tiktoken"
# The same vocabulary in the form that takes any text.
WHOLE_VOCABULARY = "byte_bpe_50k.json"
# The faster form fails at some 600,000 white characters in a row. A run of twice
# this length holds a block of it that is white throughout.
WHITE_BLOCK = 50_000
# Pieces of one length that one task numbers.
NUMBERED = 50_000
# Places per file of numbers: keeps one length from being one task.
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _encoder(vocabulary: str):
    """The byte-level BPE of 50k tokens; control strings are ordinary text.

    Read here as ranks: the ids are those of the vocabulary's JSON form, which
    takes more than four times as long to apply.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _whole_encoder(vocabulary: str):
    import public_tokenizers
    import tokenizers

    read = tokenizers.Tokenizer.from_file(str(public_tokenizers.path(vocabulary)))
    read.encode_special_tokens = True  # control strings are ordinary text here too
    return lambda text: read.encode(text, add_special_tokens=False).ids


def has_long_white_run(text: str) -> bool:
    """True for every text with a run of ``2 * WHITE_BLOCK`` white characters."""
    return any(text[at : at + WHITE_BLOCK].isspace() for at in range(0, len(text) - WHITE_BLOCK + 1, WHITE_BLOCK))


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((start, capacity) for start in range(first, n, capacity))]


def tokenized(docs: DataFrame, *, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """One row per piece with the checksum of its little-endian 32-bit ids."""
    def run(batches: Batches) -> Batches:
        encoder, other = None, None
        for batch in batches:
            encoder = encoder or _encoder(vocabulary)
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(pylist(batch, "doc_id"), pylist(batch, "text")):
                if has_long_white_run(text):
                    other = other or _whole_encoder(WHOLE_VOCABULARY)
                    ids = other(text)
                else:
                    ids = encoder.encode_ordinary(text)
                ids = np.array([*ids, end_id], dtype="<u4")
                for piece, (start, length) in enumerate(cuts(len(ids), capacity)):
                    row = (doc_id, piece, start, length, zlib.crc32(ids[start : start + length].tobytes()))
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if k == 1 else pa.int64()) for k, c in enumerate(out)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, PIECES)


def places(packing: Packing) -> dict[int, np.ndarray]:
    """For each length the places it fills: rows (first number, bin, offset).

    A place of a pattern stands for as many pieces as the pattern has bins;
    piece ``r`` of the length goes to the last row whose first number is at
    most ``r``, and as many bins further.
    """
    rows: dict[int, list[tuple[int, int, int]]] = {}
    given: dict[int, int] = {}
    first_bin = 0
    for pattern, bins in packing:
        offset = 0
        for length in pattern:
            rows.setdefault(length, []).append((given.get(length, 0), first_bin, offset))
            given[length] = given.get(length, 0) + bins
            offset += length
        first_bin += bins
    return {length: np.array(r, dtype=np.int64) for length, r in rows.items()}


def _dealt(by_length: dict[int, np.ndarray]):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            number = batch.column(batch.schema.get_field_index("number")).to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for value in np.unique(length):
                rows = by_length[int(value)]
                own = length == value
                at = np.searchsorted(rows[:, 0], number[own], side="right") - 1
                sequence[own] = rows[at, 1] + number[own] - rows[at, 0]
                offset[own] = rows[at, 2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"],
            )

    return run


def numbered(pieces: DataFrame, most: int) -> DataFrame:
    """``pieces`` with ``number``, counting from 0 within each length.

    ``most`` is the largest number of pieces of one length. The pieces of a
    length are spread by hash over cells of about ``NUMBERED`` rows, numbered
    there, and shifted by what earlier cells hold.
    """
    cells = max(1, -(-most // NUMBERED))
    spread = pieces.withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(cells)))
    held = spread.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("held"))
    earlier = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    shift = held.select("length", "cell", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("shift"))
    own = Window.partitionBy("length", "cell").orderBy("doc_id", "piece", "ids_crc32")
    counted = spread.withColumn("number", F.row_number().over(own) - 1)
    return counted.join(shift, ["length", "cell"]).withColumn("number", F.col("number") + F.col("shift")).drop("cell", "shift")


def pack_documents(docs: DataFrame, *, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = cut_lineage(tokenized(docs, capacity=capacity, vocabulary=vocabulary), "pieces")
    # At most one row per length up to the capacity.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_length = places(pack(counts, capacity))
    ordered = numbered(pieces, max(counts.values(), default=1))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return ordered.select(*names, "number").mapInArrow(_dealt(by_length), f"{PIECES}, sequence_id long, offset long")
