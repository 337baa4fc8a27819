"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakestrata.llm.common import Batches, cut_lineage

# Edges one task folds together at a time: the bound on its memory.
FOLD_EDGES = 200_000


def _folded(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """The same components as (node, smallest node seen with it)."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for x, y in zip(a, b):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    nodes = [x for x in parent if find(x) != x]
    return nodes, [find(x) for x in nodes]


def _fold(batches: Batches) -> Batches:
    a: list[int] = []
    b: list[int] = []

    def out() -> pa.RecordBatch:
        u, v = _folded(a, b)
        a.clear(), b.clear()
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    for batch in batches:
        a += batch.column(0).to_pylist()
        b += batch.column(1).to_pylist()
        if len(a) > FOLD_EDGES:
            yield out()
    yield out()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, at_once: int = FOLD_EDGES) -> DataFrame:
    """``node`` and ``component``, the smallest node it is connected with, for
    every node of ``edges (u long, v long)`` that is not itself the smallest.

    Every task first folds its edges to one a node. If no more than
    ``at_once`` edges are left, one task folds those. Otherwise star rounds
    move edges closer to their smallest node until the edge table no longer
    changes; every round is written to the shared folder.
    """
    oriented = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = cut_lineage(oriented.mapInArrow(_fold, "u long, v long"), "edges")
    if current.limit(at_once + 1).count() <= at_once:
        folded = current.coalesce(1).mapInArrow(_fold, "u long, v long")
        return cut_lineage(folded, "edges").select(F.col("u").alias("node"), F.col("v").alias("component"))
    current = current.distinct()
    before = None
    while True:
        state = current.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.bit_xor(F.hash("v", "u")).alias("y")).first()
        if not state["n"] or tuple(state) == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = tuple(state)
        stars = _small_star(_large_star(current).distinct())
        current = cut_lineage(stars.distinct(), "edges")
