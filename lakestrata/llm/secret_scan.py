"""Secret scan with corpus-wide ownership frequency.

Each text is searched for candidates: assignments to telling names, access
keys, long hex runs and, beyond these base kinds, tokens of known shape and
runs of high entropy. The corpus then says what a candidate is. Its value's
hash is counted by distinct repositories and distinct owners: a value that many
owners hold is an example someone copied, a live-looking value that only its
owner holds is taken for a real credential. Base spans are always reported;
spans of the added kinds only where the corpus makes them live.

Defined results: a NULL text counts as empty; an empty text has no spans; a
NULL owner or repository counts as one of its own; repeated rows each come
back with the same spans and count once as a repository; an empty table gives
no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.common import Batches, cut_lineage, pylist, text_of

# The base kinds, in the order in which they are listed.
BASE_KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs shorter than 32 are no candidates, so they need not be matched first.
HEX = re.compile(r"[0-9a-f]{32,}")

ADDED_KINDS = ["github", "slack", "google", "jwt", "private_key", "entropy"]
SHAPES = [
    re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"),
    re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    re.compile(r"AIza[A-Za-z0-9_-]{35}"),
    re.compile(r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
]
RUN = re.compile(r"[A-Za-z0-9+/_=-]{24,}")
KINDS = BASE_KINDS + ADDED_KINDS

# Owners from which on a value is an example.
EXAMPLE_OWNERS = 3
MIN_ENTROPY = 3.0
PLACEHOLDER = re.compile(r"example|sample|dummy|changeme|placeholder|your|xxxx|1234567|abcdefg|test", re.IGNORECASE)


def entropy(value: str) -> float:
    """Bits per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def looks_live(value: str) -> bool:
    """Random enough for a credential and no obvious placeholder."""
    return (
        len(value) >= 12 and any(c.isdigit() for c in value) and entropy(value) >= MIN_ENTROPY
        and PLACEHOLDER.search(value) is None
    )


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value); kinds as places in ``KINDS``."""
    found = [(m.start(), 0, m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end(), m.group()) for m in HEX.finditer(text)]
    for kind, shape in enumerate(SHAPES, len(BASE_KINDS)):
        found += [(m.start(), kind, m.end(), m.group()) for m in shape.finditer(text)]
    for m in RUN.finditer(text):
        value = m.group()
        if any(c.isalpha() for c in value) and looks_live(value):
            found.append((m.start(), KINDS.index("entropy"), m.end(), value))
    return sorted(found)


FOUND = "starts array<long>, kinds array<int>, ends array<long>, hashes array<long>, live array<boolean>"


def _searched(batches: Batches) -> Batches:
    kinds = [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_())]
    names = [c.split()[0] for c in FOUND.split(", ")]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for text in pylist(batch, "text"):
            found = candidates(text)
            out[0].append([f[0] for f in found])
            out[1].append([f[1] for f in found])
            out[2].append([f[2] for f in found])
            out[3].append([xxhash.xxh3_64_intdigest(f[3].encode("utf-8")) - (1 << 63) for f in found])
            out[4].append([looks_live(f[3]) for f in found])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], *(pa.array(c, k) for c, k in zip(out, kinds))], names=["doc_id", "owner", "repository", *names]
        )


def ownership(found: DataFrame) -> DataFrame:
    """``hash``, ``owners``, ``repositories`` of every candidate value.

    Rows are reduced to distinct (value, owner, repository) within each task
    before they are shuffled, and once more per owner.
    """
    held = found.select(F.explode(F.array_distinct("hashes")).alias("hash"), "owner", "repository")
    return (
        held.distinct()
        .groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
        .groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))
    )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan(docs: DataFrame, *, owner: Column, repository: Column, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """Per row: ``doc_id``, counts of the base kinds, ``base_sha256``, ``spans``,
    and how many of its candidates are ``n_live`` and ``n_examples``."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), owner.cast("string").alias("owner"),
        repository.cast("string").alias("repository"), text_of().alias("text"),
    )
    found = cut_lineage(
        source.mapInArrow(_searched, f"doc_id long, owner string, repository string, {FOUND}")
        .withColumn("row_id", F.monotonically_increasing_id()),
        "candidates",
    )
    zipped = F.arrays_zip(
        F.col("starts").alias("start"), F.col("kinds").alias("kind"), F.col("ends").alias("end"),
        F.col("hashes").alias("hash"), F.col("live").alias("live"),
    )
    each = found.where(F.size("starts") > 0).select("row_id", F.explode(zipped).alias("s")).select("row_id", "s.*")
    judged = each.join(ownership(found), "hash").withColumns({
        "is_example": F.col("owners") >= example_owners,
        "is_live": F.col("live") & (F.col("owners") == 1),
    })
    kept = judged.where((F.col("kind") < len(BASE_KINDS)) | F.col("is_live"))
    by_row = kept.groupBy("row_id").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("found_spans"),
        F.count_if("is_live").alias("n_live"), F.count_if("is_example").alias("n_examples"),
    )
    rows = found.select("doc_id", "row_id").join(by_row, "row_id", "left")
    spans = F.coalesce("found_spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    base = F.filter(spans, lambda s: s["kind"] < len(BASE_KINDS))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(spans).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_examples", F.lit(0)).alias("n_examples"),
    )
