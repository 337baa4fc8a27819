"""A training corpus from raw documents: quality, lines, copies, leaks, packing.

Every stage is a function of (session, the documents so far, table folder).
All but the last return the columns of ``documents``. ``run`` writes each
result to the shared folder and the next stage reads it from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakestrata.llm import decontaminate, line_dedup, ngram_join, packing, quality_gbt
from lakestrata.llm.common import cut_lineage, prepare, table
from lakestrata.settings import apply_scale_settings


def _ready(spark: SparkSession) -> SparkSession:
    return prepare(apply_scale_settings(spark))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_gbt.keep_good(docs, table(_ready(spark), sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return line_dedup.dedup_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return ngram_join.keep_one(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(_ready(spark), sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", leaks),
    ("best-fit packing", pack),
]

# Trained trees, edit distance and bin packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(_ready(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
