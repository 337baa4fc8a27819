"""The pipeline, its queries and their SQL."""

from __future__ import annotations


import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakestrata.llm import decontaminate, ngram_join, quality_gbt, queries
from lakestrata.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SF), "test")
        assert docs.columns == before.columns and docs.dtypes == before.dtypes, name
        ids, were = [{r["doc_id"] for r in df.select("doc_id").collect()} for df in (docs, before)]
        assert ids <= were
        if name == "quality classifier":
            forest = quality_gbt.train(before, table(spark, SF, "labels"))
            scored = quality_gbt.score(before, forest, keep=["doc_id"]).where("predicted = 1")
            assert ids == {r["doc_id"] for r in scored.collect()}
        elif name == "line dedup":
            assert ids == were
        elif name == "n-gram Jaccard join":
            groups = ngram_join.near_duplicates(before).collect()
            assert ids == {r["component_id"] for r in groups}
        else:
            leaked = {r["doc_id"] for r in decontaminate.matches(before, table(spark, SF, "benchmark")).collect()}
            assert ids == were - leaked
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect())) == sorted(tuple(r)[:5] for r in packed)


def test_null_and_repeated_rows_pass(spark):
    docs = table(spark, SF, "documents")
    rows = [(None, None, None, None, None), (None, "some plain words here", "en", "src1", 21), (7, "", "en", None, 0)]
    odd = docs.unionByName(spark.createDataFrame(rows, docs.schema)).unionByName(docs.limit(3))
    for _, stage in corpus_pipeline.STAGES:
        odd = corpus_pipeline.cut_lineage(stage(spark, odd, SF), "odd")
    assert odd.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    nothing = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        nothing = corpus_pipeline.cut_lineage(stage(spark, nothing, SF), "nothing")
    assert nothing.count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for view in ("documents", "labels"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SF}/{view}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_covers_its_table(spark, name):
    rows = queries.QUERIES[name](spark, SF)
    source = {"op9_html_text": "pages"}.get(name, "documents")
    n = table(spark, SF, source).count()
    if name == "op2_best_fit_packing":
        assert rows.select("doc_id").distinct().count() == n
    elif name == "op7_chat_formatting":
        assert rows.count() == table(spark, SF, "conversations").select("conv_id").distinct().count() + 1
    elif name == "op6_benchmark_decontamination":
        texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
        items = {r["item_id"]: r["text"] for r in table(spark, SF, "benchmark").collect()}
        exact = {(d, i) for d, t in texts.items() for i, item in items.items() if item in t}
        assert exact <= {(r["doc_id"], r["item_id"]) for r in rows.collect()}
    elif name == "op11_filter_audit":
        assert rows.where("step = 1 AND filter_order = 'ABCDE'").agg(F.sum(F.col("kept") + F.col("removed"))).first()[0] == n
    elif name == "op12_phrase_collocations":
        assert rows.groupBy("lang").agg(F.max("rank").alias("k"), F.count("rank").alias("n")).where("k <> n OR k > 2000").count() == 0 < rows.count()
    else:
        assert rows.count() == n


def test_entry_lists_all(spark):
    import __spark_entry__ as entry

    numbers = {int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op")}
    assert numbers >= set(range(1, 14)) and "pipeline" in entry.queries()
    assert "op8_line_dedup" in entry.oracle_sql()
