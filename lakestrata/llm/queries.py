"""The registered queries of the text operators and, where there is one, SQL
that computes the same."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.llm import (
    chat, decontaminate, filter_audit, html_text, line_dedup, ngram_join, packing, phrases, pii, quality_gbt,
    secret_scan, toxicity, winnowing,
)
from lakestrata.llm.common import Batches, crc32_of, pylist, table

Runner = Callable[[SparkSession, str], DataFrame]

# The queries' key for surrogates; a deployment passes its own to the operator.
SURROGATE_KEY = "lakestrata surrogate key"


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, SURROGATE_KEY)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source stands for an owner, its texts of one language for a repository."""
    return secret_scan.scan(
        table(spark, sf_dir, "documents"), owner=F.col("source"), repository=F.concat_ws("/", "source", "lang")
    )


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.with_edits(table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document and benchmark item it contains."""
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_words", "edits", "word_end")


# A conversation of control strings alone, added to the table's own.
CONTROL_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
CHAT_DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewritten_at int"
)


def _chat_digests(batches: Batches) -> Batches:
    """What the formatted texts say, read back from them."""
    sha = lambda text: hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
    names = [c.split()[0] for c in CHAT_DIGEST.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32()]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        columns = [pylist(batch, c) for c in ("conv_id", "formatted", "roles", "spans", "rewritten_at")]
        for conv_id, formatted, roles, spans, rewritten in zip(*columns):
            turns = chat.read_back(formatted)
            loss = chat.loss_text(formatted, roles, spans)
            said = "".join(f"{role}\n{text}\n" for role, text in turns)
            row = (conv_id, len(turns), sha(said), len(loss), sha(loss), len(formatted), rewritten)
            for column, value in zip(out, row):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    added = spark.createDataFrame(CONTROL_CONVERSATION, "conv_id long, turn long, role string, text string")
    return chat.format_conversations(rows.unionByName(added)).mapInArrow(_chat_digests, CHAT_DIGEST)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.drop_boilerplate(docs, F.col("source")).select("doc_id", "text", "n_lines", "n_dropped")


OP8_SQL = f"""
WITH d AS (SELECT doc_id, source AS host, text, coalesce(text, '') AS body FROM documents),
totals AS (SELECT host, count(DISTINCT body) AS pages FROM d GROUP BY host),
lines AS (
  SELECT DISTINCT host, body, trim(line) AS line
  FROM (SELECT host, body, unnest(string_split(body, chr(10))) AS line FROM d) WHERE trim(line) <> ''),
held AS (SELECT host, line, count(*) AS n FROM lines GROUP BY host, line),
bad AS (
  SELECT h.host, list(h.line) AS bad FROM held h JOIN totals t ON h.host IS NOT DISTINCT FROM t.host
  WHERE h.n >= {line_dedup.MIN_PAGES} AND h.n > CAST({line_dedup.RATIO} AS DOUBLE) * t.pages GROUP BY h.host),
cut AS (
  SELECT doc_id, text, string_split(body, chr(10)) AS all_lines,
         [x FOR x IN string_split(body, chr(10)) IF NOT list_contains(coalesce(bad, []), trim(x))] AS kept
  FROM d LEFT JOIN bad ON d.host IS NOT DISTINCT FROM bad.host)
SELECT doc_id, CASE WHEN len(kept) < len(all_lines) THEN array_to_string(kept, chr(10)) ELSE text END AS text,
       CAST(len(all_lines) AS INTEGER) AS n_lines, CAST(len(all_lines) - len(kept) AS INTEGER) AS n_dropped
FROM cut
"""


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = quality_gbt.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_gbt.score(docs, forest, keep=["doc_id"])
    return scored.select("doc_id", (crc32_of("doc_id") % quality_gbt.FOLDS == 0).alias("held_out"), "score", "predicted")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = filter_audit.count_masks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), part=F.col("source")
    )
    return filter_audit.audit(counted, filter_audit.FILTERS)


# The orders one by one; a filter's value is its removals summed over them.
OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
marks AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS bad FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN marks USING (doc_id)),
counted AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM f GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS step)),
met AS (
  SELECT part, filter_order, step, x, n, good, bad, contains(fails, x) AS hit, fails = x AS alone,
         length(translate(fails, earlier, '')) < length(fails) AS gone
  FROM counted, steps),
counts AS (
  SELECT part, filter_order, step, x,
         sum(CASE WHEN hit OR gone THEN 0 ELSE n END) AS kept, sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN hit AND NOT gone THEN bad ELSE 0 END) AS toxic_lost
  FROM met GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM counts
"""


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), F.col("lang"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT lang, [x FOR x IN string_split_regex(piece, '[\x20\x09]+') IF x <> ''] AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
grams AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM pieces
  UNION ALL
  SELECT lang, 2, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM pieces
  UNION ALL
  SELECT lang, 3, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) FROM pieces),
f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY lang, size, phrase),
n AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
cuts AS (
  SELECT lang, phrase, a, size, k, array_to_string(w[:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
  FROM cand, (SELECT unnest([1, 2]) AS k) WHERE k < size),
scored AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r,
         CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.lp JOIN f r ON r.lang = c.lang AND r.phrase = c.rp),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, part, max(a) AS b FROM (
    SELECT lang, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) AS part, a FROM cand WHERE size = 3)
  GROUP BY lang, part),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN longer g ON g.lang = s.lang AND g.part = s.phrase WHERE g.b IS NULL OR 100 * g.b < 50 * s.a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score
  FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n.n AS BIGINT) AS n, score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


def op13_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id", (crc32_of("doc_id") % toxicity.FOLDS == toxicity.HELD_OUT).alias("held_out"), "score", "predicted",
        F.size("passages").alias("n_passages"),
    )


QUERIES: dict[str, Runner] = {
    run.__name__: run
    for run in (
        op1_pii_surrogates, op2_best_fit_packing, op3_secret_scan, op4_ngram_jaccard_join, op5_winnowing,
        op6_benchmark_decontamination, op7_chat_formatting, op8_line_dedup, op9_html_text, op10_quality_classifier,
        op11_filter_audit, op12_phrase_collocations, op13_toxic_segments,
    )
}
SQL: dict[str, str] = {"op8_line_dedup": OP8_SQL, "op11_filter_audit": OP11_SQL, "op12_phrase_collocations": OP12_SQL}
