"""Line dedup by site-relative frequency, on DataFrame functions alone.

A line is boilerplate on a host if the pages of the host that contain it are
more than a given share of the host's pages. Exact copies of a page count as
one page, so that a page copied many times is not its own boilerplate.

Defined results: a NULL host is a host of its own, a NULL text counts as empty
and stays as it is, blank lines are never boilerplate, and a page that loses
all its lines stays as an empty text. Repeated rows each come back. An empty
table gives an empty result. All other columns pass through unread; the names
this module adds on the way start with ``_ld_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.common import cut_lineage, text_of

RATIO = 0.05
# A line on one page alone repeats nothing, whatever its share of a small host.
MIN_PAGES = 2


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(docs: DataFrame, host: Column, *, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per host with the hashes of its boilerplate lines.

    A host has at most (distinct lines per page / ratio) of them, however many
    pages it has. Pages are counted by the hash of their text; lines are
    counted on hashes, first within each task.
    """
    pages = docs.select(host.alias("_ld_host"), F.xxhash64(text_of()).alias("_ld_page"), text_of().alias("_ld_text"))
    totals = (
        pages.select("_ld_host", "_ld_page").distinct()
        .groupBy("_ld_host").agg(F.count(F.lit(1)).alias("_ld_pages"))
    )
    kept = F.filter(_lines(F.col("_ld_text")), lambda line: F.trim(line) != "")
    held = (
        pages.select("_ld_host", "_ld_page", F.explode(F.array_distinct(F.transform(kept, _key))).alias("_ld_line"))
        .distinct()
        .groupBy("_ld_host", "_ld_line").agg(F.count(F.lit(1)).alias("_ld_held"))
        .where(F.col("_ld_held") >= min_pages)
    )
    over = held.join(totals, held["_ld_host"].eqNullSafe(totals["_ld_host"])).select(held["*"], "_ld_pages")
    return (
        over.where(F.col("_ld_held") > ratio * F.col("_ld_pages"))
        .groupBy("_ld_host").agg(F.array_sort(F.collect_set("_ld_line")).alias("_ld_bad"))
    )


def drop_boilerplate(docs: DataFrame, host: Column, *, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text``.

    Adds ``n_lines`` and ``n_dropped`` (replacing columns of these names). The
    boilerplate table is written first; Spark then knows its size and chooses
    the join by it.
    """
    bad = cut_lineage(boilerplate(docs, host, ratio=ratio, min_pages=min_pages), "boilerplate")
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    bad = bad.withColumnRenamed("_ld_host", "_ld_bad_host")
    joined = (
        docs.withColumn("_ld_host", host)
        .join(bad, F.col("_ld_host").eqNullSafe(F.col("_ld_bad_host")), "left")
    )
    lines = _lines(F.col("_ld_text"))
    left = F.filter(lines, lambda line: ~F.array_contains(F.col("_ld_bad"), _key(line)))
    split = joined.withColumn("_ld_text", text_of()).withColumns({
        "_ld_lines": F.size(lines),
        "_ld_left": F.when(F.col("_ld_bad").isNotNull(), left),
    })
    done = split.withColumns({
        "n_lines": F.col("_ld_lines"),
        "n_dropped": F.coalesce(F.col("_ld_lines") - F.size("_ld_left"), F.lit(0)),
    })
    text = F.when(F.col("n_dropped") > 0, F.array_join("_ld_left", "\n")).otherwise(F.col("text"))
    return done.withColumn("text", text).select(*[F.col(f"`{c}`") for c in names], "n_lines", "n_dropped")


def dedup_documents(docs: DataFrame) -> DataFrame:
    """Documents with each source taken as a host; columns unchanged but for
    the text and, where the table has it, its length."""
    out = drop_boilerplate(docs, F.col("source"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
