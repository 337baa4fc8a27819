"""Rule suites compiled into aggregates and row predicates.

A rule is a dict with ``type`` and ``column`` plus its own arguments:

``not_null``; ``between`` (min / max, either may be None, inclusive);
``in_set`` (values); ``of_type`` (as); ``zscore`` (max); ``iqr`` (factor).

All rules but ``not_null`` ignore NULL. ``mostly`` (default 1.0) is the share
of tested rows that must pass. All rules of a suite are counted in one scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakestrata import constants as K
from lakestrata.operators.aggregates import null_cells
from lakestrata.operators.filters import outside
from lakestrata.operators.quantiles import exact_quantiles

Rule = Mapping[str, object]

# Suite-file names of the rules (fixed values).
EXPECTATION_TYPES = {
    "expect_column_values_to_not_be_null": "not_null",
    "expect_column_values_to_be_between": "between",
    "expect_column_values_to_be_in_set": "in_set",
    "expect_column_values_to_be_of_type": "of_type",
}


class QualityGateError(Exception):
    """The data did not pass every rule of the suite."""


def _between(df: DataFrame, c: Column, rule: Rule) -> Column:
    low, high = rule.get("min"), rule.get("max")
    if low is None and high is None:
        raise ValueError("a between rule needs min or max")
    fails = [F.isnan(c)] if _may_be_nan(df, rule["column"]) else []
    if low is not None:
        fails.append(c < F.lit(low))
    if high is not None:
        fails.append(c > F.lit(high))
    return reduce(Column.__or__, fails)


def _may_be_nan(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))


def _numbers(df: DataFrame, c: Column) -> tuple[Column, Column]:
    """The values as doubles, and the same without NaN for statistics."""
    x = c.cast("double")
    return x, F.when(~F.isnan(x), x)


def _zscore(df: DataFrame, c: Column, rule: Rule) -> Column:
    """Distance from the mean in standard deviations, both computed once and
    without NaN; NaN is unexpected."""
    x, known = _numbers(df, c)
    mean = df.agg(F.avg(known).alias("m")).scalar()
    deviation = df.agg(F.stddev_samp(known).alias("s")).scalar()
    return F.isnan(x) | (F.abs(x - mean) > F.lit(float(rule.get("max", 3.0))) * deviation)


def _iqr(df: DataFrame, c: Column, rule: Rule) -> Column:
    """Outside the quartiles by more than ``factor`` times their distance; the
    quartiles are exact, without NaN, and NaN is unexpected."""
    x, _ = _numbers(df, c)
    q1, q3 = exact_quantiles(df, rule["column"], [0.25, 0.75])
    if q1 is None:
        return F.isnan(x)
    margin = (q3 - q1) * float(rule.get("factor", 1.5))
    return F.isnan(x) | outside(x, F.lit(q1 - margin), F.lit(q3 + margin))


RuleBuilder = Callable[[DataFrame, Column, Rule], Column]

_RULES: dict[str, RuleBuilder] = {
    "not_null": lambda df, c, rule: c.isNull(),
    "between": _between,
    "in_set": lambda df, c, rule: ~c.isin(list(rule["values"])),
    "of_type": lambda df, c, rule: c.try_cast(rule["as"]).isNull(),
    "zscore": _zscore,
    "iqr": _iqr,
}


def register_rule(name: str, builder: RuleBuilder) -> None:
    """Add a rule type; ``builder(df, column, rule)`` is true for bad values."""
    _RULES[name] = builder


def parse_suite(document: Mapping) -> list[dict]:
    """Rules of a suite document; its structure is checked."""
    for required in ("expectation_suite_name", "expectations"):
        if required not in document:
            raise ValueError(f"suite lacks {required!r}")
    rules = []
    for entry in document["expectations"]:
        kind = entry["expectation_type"]
        if kind not in EXPECTATION_TYPES:
            raise ValueError(f"unknown rule {kind!r}")
        args = dict(entry["kwargs"])
        rule = {"type": EXPECTATION_TYPES[kind], "column": args["column"]}
        for source, target in (
            ("min_value", "min"), ("max_value", "max"), ("value_set", "values"), ("type_", "as"), ("mostly", "mostly")
        ):
            if source in args:
                rule[target] = args[source]
        rules.append(rule)
    return rules


def _failures(df: DataFrame, suite: Sequence[Rule]) -> list[Column]:
    """Per rule, a never-NULL boolean that is true for failing rows."""
    if not suite:
        raise ValueError("the suite has no rules")
    out = []
    for rule in suite:
        kind, column = rule["type"], rule["column"]
        if kind not in _RULES:
            raise ValueError(f"unknown rule {kind!r}")
        if column not in df.columns:
            raise ValueError(f"rule on missing column {column!r}")
        c = F.col(column)
        bad = _RULES[kind](df, c, rule)
        if kind != "not_null":
            bad = c.isNotNull() & bad
        out.append(F.coalesce(bad, F.lit(False)))
    return out


def validate(df: DataFrame, suite: Sequence[Rule], examples: int = 0) -> DataFrame:
    """One row per rule: rule_id, rule_type, column_name, tested, unexpected,
    unexpected_percent, success (and ``examples``, at most that many values).

    Counting is a single aggregate over one scan.
    """
    fails = _failures(df, suite)
    measures = [F.count(F.lit(1)).alias("n")]
    for i, (rule, bad) in enumerate(zip(suite, fails)):
        measures.append(F.count_if(bad).alias(f"bad_{i}"))
        measures.append(F.count(F.col(rule["column"])).alias(f"seen_{i}"))
    counted = df.agg(*measures)
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("rule_id"),
            F.lit(rule["type"]).alias("rule_type"),
            F.lit(rule["column"]).alias("column_name"),
            (F.col("n") if rule["type"] == "not_null" else F.col(f"seen_{i}")).alias("tested"),
            F.col(f"bad_{i}").alias("unexpected"),
            F.lit(float(rule.get("mostly", 1.0))).alias("_mostly"),
        )
        for i, rule in enumerate(suite)
    ])
    results = counted.select(F.explode(rows).alias("r")).select("r.*")
    passed_share = F.try_divide(F.col("tested") - F.col("unexpected"), F.col("tested"))
    results = results.select(
        "rule_id", "rule_type", "column_name", "tested", "unexpected",
        F.coalesce(
            F.round(F.try_divide(F.col("unexpected") * F.lit(100.0), F.col("tested")), 2), F.lit(0.0)
        ).alias("unexpected_percent"),
        F.coalesce(passed_share >= F.col("_mostly"), F.lit(True)).alias("success"),
    )
    if not examples:
        return results
    # Only rules that failed are looked at again. The counts are one row per
    # rule, so they pass through the driver.
    counted_rows = results.collect()
    results = df.sparkSession.createDataFrame(counted_rows, results.schema)
    failed = [row["rule_id"] for row in counted_rows if row["unexpected"]]
    if not failed:
        return results.withColumn("examples", F.lit(None).cast("array<string>"))
    return results.join(_examples(df, suite, {i: fails[i] for i in failed}, examples), "rule_id", "left")


# Cells in which one scan looks for the smallest value of a rule each.
EXAMPLE_CELLS = 16


def _examples(df: DataFrame, suite: Sequence[Rule], fails: Mapping[int, Column], n: int) -> DataFrame:
    """The ``n`` smallest distinct offending values per rule, as text.

    A scan takes the smallest value of each of ``EXAMPLE_CELLS`` hash cells;
    scans go on with values below the ``n``-th found so far until none is
    new. No value is shuffled: each task forwards one row, whatever the number
    of failing values and however often one occurs.
    """
    values = {i: F.col(suite[i]["column"]).cast("string") for i in fails}
    found: dict[int, list[str]] = {i: [] for i in fails}
    open_ = list(fails)
    while open_:
        smallest = []
        for i in open_:
            wanted = fails[i] & values[i].isNotNull()
            if found[i]:
                wanted &= ~values[i].isin(found[i])
            if len(found[i]) >= n:
                wanted &= values[i] < found[i][n - 1]
            cell = F.pmod(F.xxhash64(values[i]), F.lit(EXAMPLE_CELLS))
            smallest += [F.min(F.when(wanted & (cell == k), values[i])).alias(f"r{i}_{k}") for k in range(EXAMPLE_CELLS)]
        # One row with a bounded number of values.
        row = df.agg(*smallest).first()
        news = {i: [v for k in range(EXAMPLE_CELLS) if (v := row[f"r{i}_{k}"]) is not None] for i in open_}
        for i in open_:
            found[i] = sorted(found[i] + news[i])[:n]
        open_ = [i for i in open_ if set(news[i]) & set(found[i])]
    rows = [(i, examples) for i, examples in found.items() if examples]
    return df.sparkSession.createDataFrame(rows, "rule_id int, examples array<string>")


def suite_summary(results: DataFrame, floor: float = K.SUCCESS_RATE_FLOOR) -> DataFrame:
    """One row: evaluated, successful, success_rate, success, below_threshold.

    ``below_threshold`` only warns; the gate is ``success``.
    """
    summary = results.agg(
        F.count(F.lit(1)).alias("evaluated"), F.count_if(F.col("success")).alias("successful")
    )
    rate = F.coalesce(F.try_divide(F.col("successful"), F.col("evaluated")), F.lit(0.0))
    return summary.select(
        "evaluated", "successful", rate.alias("success_rate"),
        (F.col("successful") == F.col("evaluated")).alias("success"),
        (rate < F.lit(floor)).alias("below_threshold"),
    )


def failed_rule_summary(results: DataFrame) -> DataFrame:
    """One row: the distinct failed rule types as sorted text."""
    failed = F.collect_set(F.when(~F.col("success"), F.col("rule_type")))
    return results.agg(F.array_join(F.sort_array(failed), ", ").alias("failed_rules"))


def require_success(results: DataFrame) -> DataFrame:
    """The results, or ``QualityGateError`` naming the failed rules."""
    # One row per rule: the suite bounds what reaches the driver.
    failed = results.where(~F.col("success")).orderBy("rule_id").collect()
    if failed:
        raise QualityGateError("; ".join(
            f"{r['rule_type']}({r['column_name']}): {r['unexpected']} unexpected" for r in failed
        ))
    return results


def quality_gate(df: DataFrame, suite: Sequence[Rule]) -> DataFrame:
    """Rule results; raises ``QualityGateError`` unless every rule passes."""
    results = validate(df, suite)
    return require_success(df.sparkSession.createDataFrame(results.collect(), results.schema))


def quarantine(df: DataFrame, suite: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rows that pass every rule, and the others with the
    ids of the rules they fail. Both are plain filters over the input."""
    fails = _failures(df, suite)
    bad = reduce(Column.__or__, fails)
    failed = F.array_compact(F.array(*[F.when(f, F.lit(i)) for i, f in enumerate(fails)]))
    return df.where(~bad), df.where(bad).withColumn("failed_rules", failed)


def check_collected(
    tables: Mapping[str, DataFrame | None],
    tolerance: float = K.NULL_TOLERANCE,
    temperature: str = "temperatura",
    limits: tuple[float, float] = K.TEMPERATURE_RANGE,
) -> DataFrame:
    """Status rows (source, status, null_percent, extreme_rows) of collected feeds.

    Status is ``OK``, ``NULLS`` (share of NULL cells above the tolerance) or
    ``MISSING`` for a table that is absent. ``extreme_rows`` counts rows whose
    temperature lies outside the limits; NULL for feeds without one.
    """
    rows: list[DataFrame] = []
    spark = next(df.sparkSession for df in tables.values() if df is not None)
    for name, df in tables.items():
        if df is None:
            rows.append(spark.range(1).select(
                F.lit(name).alias("source"), F.lit("MISSING").alias("status"),
                F.lit(None).cast("double").alias("null_percent"), F.lit(None).cast("bigint").alias("extreme_rows"),
            ))
            continue
        missing, cells = null_cells(df)
        extreme = F.lit(None).cast("bigint")
        if temperature in df.columns:
            extreme = F.count_if(outside(F.col(temperature), *limits))
        share = F.try_divide(F.col("missing"), F.col("cells"))
        row = df.agg(missing.alias("missing"), cells.alias("cells"), extreme.alias("x"))
        rows.append(row.select(
            F.lit(name).alias("source"),
            F.when(share > tolerance, F.lit("NULLS")).otherwise(F.lit("OK")).alias("status"),
            F.round(share * 100, 2).alias("null_percent"),
            F.col("x").alias("extreme_rows"),
        ))
    return reduce(DataFrame.unionByName, rows)


def zscore_outliers(df: DataFrame, column: str, limit: float = 3.0) -> DataFrame:
    """Rows further than ``limit`` standard deviations from the mean."""
    return quarantine(df, [{"type": "zscore", "column": column, "max": limit}])[1].drop("failed_rules")
