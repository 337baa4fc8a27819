"""N-gram Jaccard join: which texts share at least 80 % of their shingles.

A text's set holds the 64-bit hashes of its distinct word n-grams. Texts of
equal sets are one node, known by a hash of the whole set. The join is exact
for these hashes (two shingles of one pair fall together with a chance of
about n * n / 2**64):

1. Shingles are put in one order for all texts, those that many texts share
   last. Two sets of the wanted similarity share one of their first
   ``n - ceil(0.8 n) + 1`` shingles, the prefix; only these are shuffled.
2. Nodes that share a prefix shingle are a list. In each list every node is
   compared with the smallest one. That is one pair a node, also in a list
   that holds a third of all rows, and it connects groups of near copies.
3. What remains are lists that still hold nodes of several components. They
   are cut into size-banded tiles of a bounded number of nodes. A node brings
   a parity bitmap of its set, as wide as its band asks for. Differing bits
   bound the overlap from above; pairs that pass get the exact intersection
   of their sorted arrays. Pairs inside one component are not looked at. A
   tile first hands on only pairs that connect what its earlier pairs left
   apart. If all of these are links, so is everything they stand for; if some
   fail, a second pass hands on every pair that is still open.

Defined results: NULL text counts as empty; an empty text has no shingles and
links with nothing; a text with fewer words than an n-gram is one shingle.
Rows of one ``doc_id`` count as the same document. A row without ``doc_id``
gets the component of its text, which is NULL if no row of it has an id; such
a text links with no other.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from lakestrata.llm.common import Batches, cut_lineage, mix64, pylist, text_of
from lakestrata.llm.graph import components

WORDS = 5
# Frequent shingles kept for the order: a fixed 400 kB, whatever the input.
HOT_SHINGLES = 50_000
# Shingles a task counts at a time.
COUNTED = 1_000_000
# Sets a task remembers so that it sends equal ones once.
REMEMBERED = 200_000
# Nodes on either side of a tile.
TILE = 2_000
# Rows up to which a tile is compared pair by pair in plain integers.
SMALL_TILE = 12
BAND = 1.25
MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64
)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), dtype=np.uint64, count=len(parts))
    n = len(h)
    with np.errstate(over="ignore"):
        if n < words:
            total = (h * MULTIPLIERS[:n]).sum(dtype=np.uint64) + np.uint64(n)
            return mix64(np.array([total], dtype=np.uint64))
        total = np.full(n - words + 1, words, dtype=np.uint64)
        for i in range(words):
            total += h[i : n - words + 1 + i] * MULTIPLIERS[i]
    return np.unique(mix64(total))


def set_hash(sorted_set: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(sorted_set.tobytes()))))


def prefix_length(n: int) -> int:
    """Shingles of which two sets of similarity 0.8 share at least one."""
    return n - (4 * n + 4) // 5 + 1


def similar(n_a: int, n_b: int, common: int) -> bool:
    return 100 * common >= 80 * (n_a + n_b - common)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    return int((a[at] == b).sum()) if len(a) else 0


def bitmap(sorted_set: np.ndarray) -> np.ndarray:
    """Parity bitmap: bit ``h mod width`` toggles with each shingle.

    The width is a power of two, at least 1,024 and twice the set. Each
    shingle that only one of two sets holds changes one bit, so differing bits
    never exceed the symmetric difference.
    """
    width = max(1024, 1 << (2 * len(sorted_set) - 1).bit_length())
    odd = np.bincount((sorted_set & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The same parity bitmap at a smaller width."""
    while len(bits) > words:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _sets(batches: Batches) -> Batches:
    """A row (doc_id, n, node, bits) per text; rows (node, n) for shingles
    that several texts of a task hold, and how many do."""
    schema = pa.schema([
        ("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("bits", pa.binary()),
    ])

    def counted(arrays: list[np.ndarray]) -> pa.RecordBatch:
        values, held = np.unique(np.concatenate(arrays), return_counts=True)
        values, held = values[held > 2], held[held > 2]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(values), np.int32)), pa.nulls(len(values), pa.int64()), pa.array(held.astype(np.int64)), _signed(values), pa.nulls(len(values), pa.binary())],
            schema=schema,
        )

    waiting: list[np.ndarray] = []
    size = 0
    for batch in batches:
        own = [shingles(t) for t in pylist(batch, "text")]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.zeros(len(own), np.int32)), batch.column(0),
            pa.array([len(s) for s in own], pa.int64()),
            pa.array([set_hash(s) if len(s) else None for s in own], pa.int64()),
            pa.array([bitmap(s).tobytes() if len(s) else None for s in own], pa.binary()),
        ], schema=schema)
        waiting += own
        size += sum(map(len, own))
        if size >= COUNTED:
            yield counted(waiting)
            waiting, size = [], 0
    if waiting:
        yield counted(waiting)


def _postings(hot: np.ndarray):
    """``hot``: frequent shingles, the most frequent last."""
    by_value = np.argsort(hot)
    ordered = hot[by_value]

    def run(batches: Batches) -> Batches:
        seen: set[int] = set()
        for batch in batches:
            tokens, nodes, often = [], [], []
            for text in pylist(batch, "text"):
                s = shingles(text)
                node = set_hash(s)
                if not len(s) or node in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(node)
                p = prefix_length(len(s))
                if len(ordered):
                    at = np.searchsorted(ordered, s)
                    at[at == len(ordered)] = 0
                    is_hot = ordered[at] == s
                else:
                    is_hot = np.zeros(len(s), dtype=bool)
                rare = s[~is_hot][:p]
                common = hot[np.sort(by_value[at[is_hot]])][: p - len(rare)] if is_hot.any() else s[:0]
                tokens += [rare, common]
                nodes.append(np.full(p, node, dtype=np.int64))
                often += [np.zeros(len(rare), bool), np.ones(len(common), bool)]
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [_signed(np.concatenate(tokens)), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(often))],
                    names=["token", "node", "hot"],
                )

    return run


def _arrays(batches: Batches) -> Batches:
    for batch in batches:
        own = [shingles(t) for t in pylist(batch, "text")]
        yield pa.RecordBatch.from_arrays(
            [pa.array([set_hash(s) for s in own], pa.int64()), pa.array([s.tobytes() for s in own], pa.binary())],
            names=["node", "members"],
        )


def _bound_passes(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int) -> bool:
    """Whether the bitmaps leave it open that two sets are similar."""
    if 5 * min(n_a, n_b) < 4 * max(n_a, n_b):
        return False
    words = min(len(a), len(b))
    differing = int(np.bitwise_count(folded(a, words) ^ folded(b, words)).sum())
    return similar(n_a, n_b, (n_a + n_b - differing) // 2)


def _screened(batches: Batches) -> Batches:
    for batch in batches:
        u, v, n_u, n_v = (pylist(batch, c) for c in ("u", "v", "n_u", "n_v"))
        bits_u, bits_v = pylist(batch, "bits_u"), pylist(batch, "bits_v")
        kept = [
            i for i in range(len(u))
            if _bound_passes(np.frombuffer(bits_u[i], "<u8"), n_u[i], np.frombuffer(bits_v[i], "<u8"), n_v[i])
        ]
        rows = pa.array(kept, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index(c)).take(rows) for c in ("u", "v", "doc_u", "doc_v")],
            names=["u", "v", "doc_u", "doc_v"],
        )


def _verified(batches: Batches) -> Batches:
    """Exact intersection of the sorted arrays."""
    for batch in batches:
        u, v = pylist(batch, "u"), pylist(batch, "v")
        left, right = pylist(batch, "left_members"), pylist(batch, "right_members")
        kept = []
        for i in range(len(u)):
            a, b = np.frombuffer(left[i], "<u8"), np.frombuffer(right[i], "<u8")
            if similar(len(a), len(b), overlap(a, b)):
                kept.append(i)
        yield _pairs([u[i] for i in kept], [v[i] for i in kept])


def _pairs(u, v) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


class _Merged:
    """Which components one tile has found to belong together."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while x in self.up:
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        """False if they already were one."""
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _small_tile(rows: list[tuple], merged: _Merged | None) -> list[tuple[int, int]]:
    """Pairs of a few rows (node, component, n, side, bits), one by one."""
    found = []
    diagonal = not any(r[3] == 1 for r in rows)
    for at, (node, component, n, side, bits) in enumerate(rows):
        if side == 1:
            continue
        for other, other_component, m, other_side, other_bits in rows[at + 1 :] if diagonal else rows:
            if component == other_component or (not diagonal and other_side != 1):
                continue
            if 5 * min(n, m) < 4 * max(n, m):
                continue
            if len(bits) == len(other_bits):
                differing = (int.from_bytes(bits, "little") ^ int.from_bytes(other_bits, "little")).bit_count()
                if not similar(n, m, (n + m - differing) // 2):
                    continue
            elif not _bound_passes(np.frombuffer(bits, "<u8"), n, np.frombuffer(other_bits, "<u8"), m):
                continue
            if merged is None or merged.join(component, other_component):
                found.append((node, other))
    return found


def _large_tile(rows: list[tuple], merged: _Merged | None) -> list[tuple[int, int]]:
    """The same pairs, a row against its window of sizes at a time."""
    node, component, size, side = (np.array([r[k] for r in rows], dtype=np.int64) for k in range(4))
    bits = [np.frombuffer(r[4], "<u8") for r in rows]
    diagonal = not (side == 1).any()
    left = np.flatnonzero(side == 0)
    right = left if diagonal else np.flatnonzero(side == 1)
    right = right[np.argsort(size[right], kind="stable")]
    found: list[tuple[int, int]] = []
    at_width: dict[int, np.ndarray] = {}
    for i in left:
        low = np.searchsorted(size[right], -(-4 * size[i] // 5), side="left")
        high = np.searchsorted(size[right], 5 * size[i] // 4, side="right")
        # Sets of the window are at least 0.8 times as large: half the width is the least they have.
        words = max(16, len(bits[i]) // 2)
        if words not in at_width:
            at_width[words] = np.stack([
                folded(bits[j], words) if len(bits[j]) >= words else np.zeros(words, "<u8") for j in right
            ])
        window = right[low:high]
        differing = np.bitwise_count(at_width[words][low:high] ^ folded(bits[i], words)).sum(axis=1, dtype=np.int64)
        bound = (size[i] + size[window] - differing) // 2
        near = (component[window] != component[i]) & (100 * bound >= 80 * (size[i] + size[window] - bound))
        if diagonal:
            near &= node[window] > node[i]
        for j in window[near]:
            if merged is None or merged.join(int(component[i]), int(component[j])):
                found.append((int(node[i]), int(node[j])))
    return found


def _tiles_of(every: bool):
    """Rows come sorted by tile; one tile is held at a time.

    Without ``every``, pairs that a tile's earlier pairs already connect are
    left out, so a tile gives fewer pairs than it has rows.
    """
    def pairs_of(rows: list[tuple]) -> list[tuple[int, int]]:
        merged = None if every else _Merged()
        return (_small_tile if len(rows) <= SMALL_TILE else _large_tile)(rows, merged)

    def run(batches: Batches) -> Batches:
        key, rows = None, []
        found: list[tuple[int, int]] = []
        for batch in batches:
            columns = [pylist(batch, c) for c in ("tile", "node", "component", "n", "side", "bits")]
            for tile, *row in zip(*columns):
                if tile != key:
                    found += pairs_of(rows)
                    key, rows = tile, []
                rows.append(tuple(row))
            if found:
                distinct = set(found)
                found = []
                yield _pairs([p[0] for p in distinct], [p[1] for p in distinct])
        found += pairs_of(rows)
        yield _pairs([p[0] for p in found], [p[1] for p in found])

    return run


def _open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The lists that still hold nodes of several components, without their
    leaders, which every other node has met.

    The nodes of the leader's component are the main side of a list.
    """
    lists = lists.where("node <> leader")
    labelled = lists.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (
        labelled.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high").select("token")
    )
    main = labels.select(F.col("node").alias("leader"), F.col("component").alias("main"))
    return (
        labelled.join(mixed, "token").join(main, "leader", "left")
        .withColumn("is_main", F.col("component") == F.coalesce("main", "leader"))
        .select("token", "node", "component", "is_main")
    )


def _tiles(open_lists: DataFrame, sets: DataFrame, every: bool) -> DataFrame:
    """Pairs across components that the bitmaps let through.

    A list of at most ``TILE`` nodes is one tile. A longer one is cut into
    size bands and blocks: a block of the main side meets every block of the
    others, those meet each other, and no tile holds more than about two
    blocks.
    """
    counts = open_lists.groupBy("token").agg(
        F.count_if("is_main").alias("main"), F.count_if(~F.col("is_main")).alias("others")
    ).where(F.col("others") > 0)
    whole = F.col("main") + F.col("others") <= TILE
    rows = open_lists.join(counts, "token").withColumns({
        "main_blocks": F.ceil(F.col("main") / TILE), "blocks": F.ceil(F.col("others") / TILE),
    })
    hashed = F.xxhash64("node")
    struct = "array<struct<i:bigint,j:bigint,side:int>>"
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    own = F.pmod(hashed, F.when(F.col("is_main"), F.col("main_blocks")).otherwise(F.col("blocks")))
    places = (
        F.when(whole, F.array(F.struct(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"), F.lit(0).alias("side"))))
        .when(F.col("is_main"), F.transform(
            upto(F.col("blocks")), lambda i: F.struct(i.alias("i"), (-1 - F.col("block")).alias("j"), F.lit(1).alias("side"))))
        .otherwise(F.concat(
            F.transform(upto(F.col("blocks")), lambda j: F.struct(
                F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j"),
                F.when(j < F.col("block"), 1).otherwise(0).alias("side"))),
            F.when(F.col("main_blocks") > 0, F.transform(
                upto(F.greatest(F.col("main_blocks"), F.lit(1).cast("long"))),
                lambda r: F.struct(F.col("block").alias("i"), (-1 - r).alias("j"), F.lit(0).alias("side"))))
            .otherwise(F.array().cast(struct)),
        ))
    )
    band = F.floor(F.log("n") / F.log(F.lit(BAND)))
    # Sets of the wanted similarity lie in one band or in neighbouring ones.
    bands = F.when(F.col("whole"), F.array(F.lit(-1).cast("long"))).otherwise(F.array(band, band + 1))
    placed = (
        rows.withColumns({"block": own, "whole": whole}).withColumn("at", F.explode(places))
        .select("token", "whole", "node", "component", "at.*")
        .join(sets.drop("doc_id"), "node")
        .withColumn("band", F.explode(bands))
        .select(F.xxhash64("token", "band", "i", "j").alias("tile"), "node", "component", "n", "side", "bits")
    )
    return placed.repartition("tile").sortWithinPartitions("tile").mapInArrow(_tiles_of(every), "u long, v long").distinct()


def _with_documents(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Each pair with a document of either node."""
    left = sets.select(F.col("node").alias("u"), F.col("doc_id").alias("doc_u"))
    right = sets.select(F.col("node").alias("v"), F.col("doc_id").alias("doc_v"))
    return pairs.join(right, "v").join(left, "u")


def _check(pairs: DataFrame, source: DataFrame) -> DataFrame:
    """The pairs (u, v) that are similar, by their sorted arrays; a pair may
    come more than once.

    The arrays are made again from the texts of just the documents (doc_u,
    doc_v) that stand for the nodes in ``pairs``.
    """
    wanted = pairs.select(F.explode(F.array("doc_u", "doc_v")).alias("doc_id")).distinct()
    arrays = cut_lineage(
        source.join(wanted, "doc_id", "left_semi").select("text").mapInArrow(_arrays, "node long, members binary"), "arrays"
    )
    pairs = pairs.select("u", "v")
    right = arrays.select(F.col("node").alias("v"), F.col("members").alias("right_members"))
    left = arrays.select(F.col("node").alias("u"), F.col("members").alias("left_members"))
    joined = pairs.join(right, "v").join(left, "u").select("u", "v", "left_members", "right_members")
    return joined.mapInArrow(_verified, "u long, v long")


def _screen(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that the bitmaps let through, with a document of each."""
    left = sets.select(F.col("node").alias("u"), *[F.col(c).alias(f"{c}_u") for c in ("n", "bits")], F.col("doc_id").alias("doc_u"))
    right = sets.select(F.col("node").alias("v"), *[F.col(c).alias(f"{c}_v") for c in ("n", "bits")], F.col("doc_id").alias("doc_v"))
    near = (5 * F.least("n_u", "n_v") >= 4 * F.greatest("n_u", "n_v"))
    joined = pairs.join(right, "v").join(left, "u").where(near)
    return joined.mapInArrow(_screened, "u long, v long, doc_u long, doc_v long")


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n, node) and labels (node, component)."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    first = cut_lineage(source.mapInArrow(_sets, "kind int, doc_id long, n long, node long, bits binary"), "sets")
    rows = first.where("kind = 0").select("doc_id", "n", "node")
    frequent = (
        first.where("kind = 1").groupBy("node").agg(F.sum("n").alias("held"))
        .orderBy(F.desc("held"), "node").limit(HOT_SHINGLES).orderBy("held", "node").select("node")
    )
    hot = np.array([r[0] for r in frequent.collect()], dtype=np.int64).view(np.uint64)
    postings = cut_lineage(source.mapInArrow(_postings(hot), "token long, node long, hot boolean"), "postings")
    lists = cut_lineage(_lists(postings), "lists")

    sets = cut_lineage(
        first.where("kind = 0 and node is not null").groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits").alias("bits")),
        "bitmaps",
    )
    stars = lists.where("leader <> node").select(F.col("leader").alias("u"), F.col("node").alias("v")).distinct()
    near = cut_lineage(_screen(stars, sets), "pairs")
    labels = components(_check(near, source))
    failed = None
    for every in (False, True):
        others = _tiles(cut_lineage(_open_lists(lists, labels), "lists"), sets, every)
        if failed is not None:
            others = others.join(failed, ["u", "v"], "left_anti")
        others = cut_lineage(others, "pairs")
        if others.isEmpty():
            break
        more = cut_lineage(_check(_with_documents(others, sets), source).distinct(), "links")
        labels = components(labels.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more))
        # All that the tiles took for links were links: nothing was left out.
        if more.count() == others.count():
            break
        failed = others.join(more, ["u", "v"], "left_anti")
    return rows, labels


def _lists(postings: DataFrame) -> DataFrame:
    """``token``, ``node`` and the list's ``leader``, its smallest node, for
    all shingles that several nodes share.

    Frequent shingles are at most ``HOT_SHINGLES`` groups: they are reduced
    within each task and their leaders are sent to the rows. All others are
    shuffled once.
    """
    by_token = Window.partitionBy("token")
    rare = postings.where("not hot").select("token", "node").withColumns({
        "leader": F.min("node").over(by_token), "last": F.max("node").over(by_token),
    })
    often = postings.where("hot").select("token", "node").distinct()
    leaders = often.groupBy("token").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
    common = often.join(F.broadcast(leaders.limit(HOT_SHINGLES)), "token")
    return (
        rare.unionByName(common.select(*rare.columns)).where("leader <> last").select("token", "node", "leader").distinct()
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row."""
    rows, labels = links(docs)
    labelled = cut_lineage(
        rows.join(labels, "node", "left").select("doc_id", "n", F.coalesce("component", "node").alias("component")), "labels"
    )
    least = labelled.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    return labelled.join(least, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near copies: that with the
    smallest (doc_id, hash of its text).

    A document is its identifier and its text here: unlike texts of one
    identifier both stay. Of rows that agree in both, the one with the
    smallest hash of all columns stays. Rows without an id all stay.
    """
    text_hash, key = F.xxhash64(text_of()), F.xxhash64(F.col("doc_id").cast("long"), text_of())
    with_id = docs.where(F.col("doc_id").isNotNull())
    rows, labels = links(with_id.select(key.alias("doc_id"), "text"))
    names = with_id.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), text_hash.alias("hash")).distinct()
    grouped = (
        rows.select(F.col("doc_id").alias("key"), "node").distinct().join(labels, "node", "left")
        .select("key", F.coalesce("component", "node").alias("component")).join(names, "key")
    )
    first = F.min(F.struct("doc_id", "hash", "key")).alias("first")
    kept = (
        grouped.where("component IS NOT NULL").groupBy("component").agg(first).select("first.key")
        .unionByName(grouped.where("component IS NULL").select("key"))
    )
    kept = cut_lineage(kept, "kept").withColumnRenamed("key", "_kept_key")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    chosen = (
        with_id.select(key.alias("key"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("order"), whole.alias("row"))
        .join(kept, F.col("key") == F.col("_kept_key"), "left_semi")
        .groupBy("key").agg(F.min_by("row", "order").alias("row"))
    )
    return chosen.select("row.*").unionByName(docs.where(F.col("doc_id").isNull()))
