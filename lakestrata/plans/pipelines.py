"""The batch and stream pipelines, each a few lazy plans and one write.

What flows downstream is always the masked table. Row counts come from
metrics observed during the write, and every stage leaves audit rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lakestrata import constants as K
from lakestrata.functions.masking import DEFAULT_POLICY, MaskRule, mask_columns
from lakestrata.functions.time import ntz
from lakestrata.operators import audit, quality
from lakestrata.operators.aggregates import distinct_counts, row_counts
from lakestrata.operators.joins import orphan_keys
from lakestrata.plans.consolidate import Tables, consolidate
from lakestrata.plans.star import build_star, fact_losses
from lakestrata.sinks.files import append_audit, append_new, write_layer
from lakestrata.sinks.star import load_star, read_star
from lakestrata.sources.logs import read_audit
from lakestrata.sources.tables import read_layer
from lakestrata.streaming import batches
from lakestrata.streaming.sales import process_sales_stream, read_event_stream

SALES = "vendas"


class LoadError(Exception):
    """A load was stopped before it was published."""


@dataclass(frozen=True)
class Lake:
    """Where the layers and the audit table live."""

    root: str

    @property
    def audit(self) -> str:
        return f"{self.root}/audit"

    @property
    def star(self) -> str:
        return f"{self.root}/gold/star"

    @property
    def stream(self) -> str:
        return f"{self.root}/silver/{SALES}_stream"


STEP = "level string, dag_id string, task_id string, action string, message string, compliance_status string"


def record_steps(spark: SparkSession, lake: Lake, steps: Sequence[tuple], as_of: datetime | str) -> None:
    """Append the audit rows of a stage's steps, (level, dag, task, action,
    message, compliance) each, as one file."""
    rows = spark.createDataFrame(list(steps), STEP).withColumn("timestamp", ntz(as_of)).coalesce(1)
    append_audit(audit.audit_rows(rows, preset=True), lake.audit, small=True)


def record(
    spark: SparkSession, lake: Lake, dag: str, task: str, action: str, message: str,
    as_of: datetime | str, level: str = "INFO", compliance: str | None = None,
) -> None:
    """Append one audit row for a pipeline step; the level sets what is not given."""
    record_steps(spark, lake, [(level, dag, task, action, message, compliance)], as_of)


def consolidate_and_mask(
    spark: SparkSession,
    tables: Tables,
    lake: Lake,
    key: str,
    as_of: datetime | str,
    policy: Mapping[str, MaskRule] = DEFAULT_POLICY,
    driving: str = "customers",
    mode: str = "fanout",
) -> int:
    """Consolidate, mask and write the silver sales table by purchase month;
    the number of rows written.

    A full rebuild: months that are no longer there are removed. Columns that
    one table alone holds are masked there, before joins repeat their values.
    The numbers of distinct values before and after masking are audited per
    column.
    """
    owner = {c: [n for n, t in tables.items() if c in t.columns] for c in policy}
    early = {c: owner[c][0] for c in policy if len(owner[c]) == 1}
    prepared = dict(tables)
    for name in set(early.values()):
        own = {c: policy[c] for c in early if early[c] == name}
        prepared[name] = mask_columns(tables[name], own, key=key)
    wide = consolidate(prepared, driving, mode)
    masked = mask_columns(wide, {c: r for c, r in policy.items() if c not in early}, key=key)
    by_month = masked.withColumn("mes", F.date_format("order_purchase_timestamp", "yyyy-MM"))
    seen = Observation("silver")
    counted = by_month.observe(seen, F.count(F.lit(1)).alias("rows"))
    # The months alone: Spark leaves out the joins that only repeat rows.
    path = write_layer(counted, lake.root, "silver", SALES, ["mes"], replace="table", values=by_month.select("mes").distinct())
    rows = seen.get["rows"]
    # Numbers of distinct values, one row per masked column.
    sources = {c: tables[early[c]] if c in early else wide for c in policy}
    by_table: dict[int, tuple[DataFrame, list[str]]] = {}
    for column, source in sources.items():
        by_table.setdefault(id(source), (source, []))[1].append(column)
    before = {r["column"]: r["n_distinct"] for source, own in by_table.values() for r in distinct_counts(source, own).collect()}
    after = {r["column"]: r["n_distinct"] for r in distinct_counts(spark.read.parquet(path), list(policy)).collect()}
    steps = []
    for column, rule in policy.items():
        action, compliance = K.MASK_AUDIT.get(rule.method, ("DATA_MASKED", None))
        distinct = f"{before.get(column, 0)} -> {after.get(column, 0)} distinct values"
        steps.append(("INFO", "consolidate", "mask", action, f"{column}: {rule.method}, {distinct}. {rule.reason}", compliance))
    steps.append(("INFO", "consolidate", "write", "CONSOLIDATION_WRITTEN", f"{rows} rows", None))
    record_steps(spark, lake, steps, as_of)
    return rows


def check_sales(
    spark: SparkSession, lake: Lake, suite: Sequence[quality.Rule], as_of: datetime | str
) -> DataFrame:
    """Gate on the silver table: the rule results, or ``QualityGateError``.

    The validation is audited either way.
    """
    sales = read_layer(spark, lake.root, "silver", SALES)
    # Rule results are one row per rule.
    results = quality.validate(sales, suite)
    rows = results.collect()
    results = spark.createDataFrame(rows, results.schema).coalesce(1)
    append_audit(audit.audit_validations(results, SALES, as_of), lake.audit, small=True)
    if sum(r["success"] for r in rows) < K.SUCCESS_RATE_FLOOR * len(rows):
        text = f"success rate below {K.SUCCESS_RATE_FLOOR:.0%}"
        record(spark, lake, "gate", "validate", "VALIDATION_THRESHOLD_BREACH", text, as_of, "CRITICAL")
    return quality.require_success(results)


def publish_star(
    spark: SparkSession, lake: Lake, version: str, as_of: datetime | str
) -> DataFrame:
    """Build the star from silver, check the written keys and publish it
    whole; row counts per table. Rows the fact drops are audited."""
    silver = read_layer(spark, lake.root, "silver", SALES)

    def no_orphans(written: Mapping[str, DataFrame]) -> None:
        # One look for both dimensions: the first that lacks a key is named.
        lacking = [
            orphan_keys(written["fato_vendas"], written[dim], column).limit(1).select(F.lit(dim).alias("dim"))
            for dim, column in (("dim_cliente", "cliente_id"), ("dim_produto", "produto_id"))
        ]
        found = lacking[0].unionByName(lacking[1]).orderBy("dim").first()
        if found:
            record(spark, lake, "star", "check", "STAR_ORPHANS", f"{found['dim']} lacks keys of the fact", as_of, "ERROR")
            raise LoadError(f"{found['dim']} lacks keys of the fact")

    load_star(spark, build_star(silver), lake.star, version, no_orphans)
    counts = row_counts(read_star(spark, lake.star))
    lost = fact_losses(silver).first()
    text = f"{version}: {lost['kept']} of {lost['rows']} rows, {lost['incomplete']} incomplete, {lost['merged']} merged"
    record(spark, lake, "star", "load", "STAR_PUBLISHED", text, as_of)
    return counts


def run_batch(
    spark: SparkSession, tables: Tables, lake: Lake, key: str, suite: Sequence[quality.Rule],
    version: str, as_of: datetime | str, mode: str = "preaggregate",
) -> DataFrame:
    """Consolidate, mask, gate and publish; row counts of the star.

    By default the silver table has one row per item, so that what the fact
    merges are repeated lines and not copies made by payments.
    """
    consolidate_and_mask(spark, tables, lake, key, as_of, mode=mode)
    check_sales(spark, lake, suite, as_of)
    return publish_star(spark, lake, version, as_of)


def write_authority_report(
    spark: SparkSession, lake: Lake, start: datetime | str, end: datetime | str, as_of: datetime | str
) -> str:
    """Write the restricted copy of a period's audit rows and record that it
    was handed out; the path of the copy."""
    report = audit.audit_report(read_audit(spark, lake.audit), start, end)["autoridade"]
    path = f"{lake.root}/reports/authority/{str(start)[:10]}_{str(end)[:10]}"
    seen = Observation("authority")
    report.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    text = f"{seen.get['rows']} rows from {start} to {end}"
    record(spark, lake, "report", "authority", "AUTHORITY_REPORT_WRITTEN", text, as_of)
    return path


def sales_events(consolidated: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Consolidated rows as sales events; the event time is the purchase time."""
    return consolidated.select(
        *also,
        F.col("order_purchase_timestamp").cast("string").alias("timestamp"),
        "customer_state",
        F.col("price").cast("string").alias("price"),
        F.col("order_id").cast("string").alias("order_id"),
    )


def land_events(spark: SparkSession, lake: Lake) -> str:
    """Append the sales of the silver table that are not landed yet, one event
    per order line; the path of the event table, which is only ever appended
    to."""
    path = f"{lake.root}/bronze/{SALES}_events"
    line = ["order_id", "product_id", "order_item_id"]
    silver = read_layer(spark, lake.root, "silver", SALES)
    events = sales_events(silver, line[1:])
    append_new(spark, path, events.where("order_id is not null"), line, ["price", "timestamp"])
    return path


@dataclass(frozen=True)
class StreamRun:
    """A started stream, where it writes, and the last batch before it."""

    query: StreamingQuery
    root: str
    after: int


def run_stream(
    spark: SparkSession, lake: Lake, as_of: datetime | str | None = None, max_files: int | None = None
) -> StreamRun:
    """Stream all landed sales events through the sales processor until all
    that is there now is processed.

    A silver rebuild rewrites files, but lands only events that are new, so a
    second run does not emit a sale again.
    """
    path = land_events(spark, lake)
    schema = spark.read.parquet(path).schema
    events = read_event_stream(spark, path, schema, max_files=max_files)
    after = batches.last_batch(spark, lake.stream)
    query = process_sales_stream(events, lake.stream, f"{lake.root}/checkpoints/{SALES}", as_of)
    return StreamRun(query, lake.stream, after)


COUNTERS = ("consumed", "processed", "skipped", "invalid")


def finish_stream(spark: SparkSession, lake: Lake, run: StreamRun, as_of: datetime | str) -> dict[str, int]:
    """Wait for the stream, add up the counters of the batches it published
    and audit the totals."""
    run.query.awaitTermination()
    totals = batches.totals(spark, run.root, COUNTERS, run.after)
    text = ", ".join(f"{name} {n}" for name, n in totals.items())
    record(spark, lake, "stream", "process", "STREAM_FINISHED", text, as_of)
    return totals
