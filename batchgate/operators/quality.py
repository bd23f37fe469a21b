"""Fused rule evaluation, results and summary frames, and the gate.

``evaluate`` turns any number of rules into **one** aggregate over the input
(every row rule, NULL counter and the row count are ``count_if`` terms of a
single ``agg``) plus one grouped pass per unique-key rule. Partial
aggregation happens map-side, so a hot key or a third of the rows in one
group costs nothing extra. The result is a small DataFrame with one row per
rule; only gates and summaries collect it, and its size is bounded by the
number of configured rules, not by the data.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.predicates import any_null, any_true
from ..spec import normalize_rules
from .key_counts import KeyCounts
from .rules import (FAIL, FAIL_SEVERITIES, MESSAGES, PASS, WARN, CompiledRule,
                    compile_rules)

RESULT_COLUMNS = ["rule_index", "rule_name", "status", "severity", "message",
                  "records_checked", "records_failed"]


class ValidationError(ValueError):
    """Raised by the gate on the first failing rule."""


def as_rules(rules: Any) -> list[dict]:
    """Accept a rule list, a validation section of either dialect, or None."""
    if rules is None:
        return []
    if isinstance(rules, list) and all(isinstance(r, dict) for r in rules):
        return [dict(r, dialect=r.get("dialect", "library")) for r in rules]
    return normalize_rules(rules)


def compile_for(df: DataFrame, rules: Any) -> list[CompiledRule]:
    return compile_rules(as_rules(rules), df.schema)


def _result(r: CompiledRule, checked: Column, failed: Column, fail_msg: Column, pass_msg: Column,
            has_failed: Column | None = None) -> Column:
    has_failed = failed > 0 if has_failed is None else has_failed
    return F.struct(
        F.lit(r.order).alias("rule_index"),
        F.lit(r.rule_name).alias("rule_name"),
        F.when(has_failed, F.lit(r.fail_status)).otherwise(F.lit(PASS)).alias("status"),
        F.lit(r.severity).alias("severity"),
        F.when(has_failed, fail_msg).otherwise(pass_msg).alias("message"),
        checked.cast("bigint").alias("records_checked"),
        failed.cast("bigint").alias("records_failed"),
    )


def _static(r: CompiledRule) -> Column:
    status, severity, message = r.static
    return F.struct(F.lit(r.order).alias("rule_index"), F.lit(r.rule_name).alias("rule_name"),
                    F.lit(status).alias("status"), F.lit(severity).alias("severity"),
                    F.lit(message).alias("message"), F.lit(0).cast("bigint").alias("records_checked"),
                    F.lit(0).cast("bigint").alias("records_failed"))


def _joined_non_empty(parts: list[Column]) -> Column:
    return F.concat_ws(", ", F.filter(F.array(*parts), lambda x: x.isNotNull()))


def _scan_terms(compiled: list[CompiledRule]) -> list[Column]:
    """All count terms of the fused aggregate."""
    terms = [F.count(F.lit(1)).alias("_total")]
    for r in compiled:
        if r.kind == "row":
            terms.append(F.count_if(r.fail).alias(f"_f{r.order}"))
        elif r.kind == "nulls":
            for j, (_, pred) in enumerate(r.cells):
                terms.append(F.count_if(pred).alias(f"_f{r.order}_{j}"))
            if r.count_rows:
                terms.append(F.count_if(any_true(p for _, p in r.cells)).alias(f"_f{r.order}"))
    return terms


def _scan_result(r: CompiledRule) -> Column:
    total = F.col("_total")
    if r.kind == "static":
        return _static(r)
    if r.kind == "row":
        return _result(r, total, F.col(f"_f{r.order}"), F.lit(r.fail_message), F.lit(r.pass_message))
    if r.kind == "row_count":
        lo, hi = r.bounds
        out = F.lit(False)
        if lo is not None:
            out = out | (total < F.lit(lo))
        if hi is not None:
            out = out | (total > F.lit(hi))
        failed = F.when(out, total).otherwise(F.lit(0))
        msg = F.format_string(MESSAGES["row_count_fail"].replace("{n}", "%d").format(min=lo, max=hi), total)
        ok = F.format_string(MESSAGES["row_count_pass"].replace("{n}", "%d"), total)
        # Out of bounds fails even when the count itself is 0 (empty input).
        return _result(r, total, failed, msg, ok, has_failed=out)
    # nulls
    counts = [(c, F.col(f"_f{r.order}_{j}")) for j, (c, _) in enumerate(r.cells)]
    if r.count_rows:
        per_col = [F.when(n > 0, F.format_string(
            MESSAGES["nulls_rows_column"].replace("{n}", "%d").format(column=c), n)) for c, n in counts]
        failed = F.col(f"_f{r.order}") if counts else F.lit(0)
        return _result(r, total, failed, _joined_non_empty(per_col) if counts else F.lit(""),
                       F.lit(MESSAGES["nulls_rows_pass"]))
    per_col = [F.when(n > 0, F.format_string(f"{c}=%d", n)) for c, n in counts]
    failed = reduce(lambda a, b: a + b, [n for _, n in counts])
    fail_msg = F.concat(F.lit(MESSAGES["nulls_cells_fail"].split("{detail}")[0]), _joined_non_empty(per_col))
    return _result(r, total, failed, fail_msg, F.lit(MESSAGES["nulls_cells_pass"]))


def _unique_result(df: DataFrame, r: CompiledRule) -> DataFrame:
    """One grouped pass: rows checked, rows with a NULL key part, duplicate excess."""
    keys = r.keys
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_bg_n"))
    null_key = any_null(keys)
    n = F.col("_bg_n")
    stats = grouped.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("_checked"),
        F.coalesce(F.sum(F.when(null_key, n)), F.lit(0)).alias("_nulls"),
        F.coalesce(F.sum(F.when(~null_key & (n > 1), n - 1)), F.lit(0)).alias("_dups"),
    )
    fail_msg = F.format_string(
        MESSAGES["unique_fail"].replace("{nulls}", "%d").replace("{dups}", "%d"),
        F.col("_nulls"), F.col("_dups"))
    res = _result(r, F.col("_checked"), F.col("_nulls") + F.col("_dups"), fail_msg, F.lit(r.pass_message))
    return stats.select(res.alias("_r")).select("_r.*")


def _known_unique(r: CompiledRule, counts: KeyCounts) -> Column:
    """The same result from key counts that were taken before: literals, no pass."""
    c = counts.of(r.keys)
    message = MESSAGES["unique_fail"].format(nulls=c.null_rows, dups=c.excess)
    return _result(r, F.lit(c.rows), F.lit(c.null_rows + c.excess), F.lit(message), F.lit(r.pass_message))


def evaluate(df: DataFrame, rules: Any, counts: KeyCounts | None = None) -> DataFrame:
    """Results frame, one row per configured rule (``rule_index`` = config order).

    Scans: one for all row-level rules, NULL counters, row counts and static
    results together, plus one grouped pass per unique-key rule. Each pass
    re-reads ``df``, so give it a columnar source (the landed batch), not a
    text scan. With ``counts`` (the run's key counts of ``df``), unique-key
    rules are answered from them, and later steps share the same pass.
    """
    compiled = compile_for(df, rules)
    spark = df.sparkSession
    parts: list[DataFrame] = []
    base = [r for r in compiled if r.kind != "unique"]
    if any(r.kind in ("row", "nulls", "row_count") for r in base):
        agg = df.agg(*_scan_terms(base))
        parts.append(agg.select(F.inline(F.array(*[_scan_result(r) for r in base]))))
    elif base:
        one = spark.range(1)
        parts.append(one.select(F.inline(F.array(*[_static(r) for r in base]))))
    unique = [r for r in compiled if r.kind == "unique"]
    if counts is not None and unique:
        parts.append(spark.range(1).select(F.inline(F.array(*[_known_unique(r, counts) for r in unique]))))
    elif unique:
        parts.extend(_unique_result(df, r) for r in unique)
    if not parts:
        return spark.createDataFrame([], S.RESULT_SCHEMA).select(
            F.lit(0).alias("rule_index"), *S.RESULT_SCHEMA.fieldNames())
    return reduce(DataFrame.unionByName, parts).select(*RESULT_COLUMNS)


def summarize(results: DataFrame) -> DataFrame:
    """One row: overall status and status tallies over a results frame.

    Overall is FAIL when a FAIL result has a failing severity, else WARN when
    any rule warned, else PASS.
    """
    status, severity = F.col("status"), F.col("severity")
    fail_hard = F.count_if((status == FAIL) & severity.isin(*FAIL_SEVERITIES))
    return results.agg(
        F.when(fail_hard > 0, F.lit(FAIL))
         .when(F.count_if(status == WARN) > 0, F.lit(WARN))
         .otherwise(F.lit(PASS)).alias("overall_status"),
        F.count(F.lit(1)).alias("total_rules"),
        F.count_if(status == PASS).alias("passed_rules"),
        F.count_if(status == FAIL).alias("failed_rules"),
        F.count_if(status == WARN).alias("warning_rules"),
    )


def collect_results(results: DataFrame) -> list[Row]:
    """Bring the (rule-count sized) results to the driver in config order."""
    return sorted(results.collect(), key=lambda r: r["rule_index"])


def gate(results: DataFrame | list[Row]) -> list[Row]:
    """Raise on the first FAIL result in config order; return all results."""
    rows = collect_results(results) if isinstance(results, DataFrame) else list(results)
    for r in rows:
        if r["status"] == FAIL:
            raise ValidationError(
                f"Validation failed for rule: {r['rule_name']}, Status: {r['status']}, "
                f"Message: {r['message']}")
    return rows


def validate(df: DataFrame, validation_config: Any) -> dict:
    """Evaluate a validation config; the summary and the results as one dict."""
    results = evaluate(df, validation_config)
    rows = collect_results(results)
    # The results are at most one row per rule: summarised by the same operator, without a second scan.
    kept = df.sparkSession.createDataFrame(rows, results.schema) if rows else results
    return {**summarize(kept).first().asDict(), "results": [{k: r[k] for k in S.RESULT_SCHEMA.fieldNames()} for r in rows]}
