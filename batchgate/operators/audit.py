"""Failure audit and valid/invalid split.

The audit holds one row per violation (record, rule, column) and nothing for
passing records. Row-level rules are found in a single pass: each rule adds a
``when(failed, struct(..))`` entry to an array that is filtered and exploded.
Unique-key rules add one grouped pass; rows with a NULL key part are flagged
without any join, and rows of duplicated keys by a join with the (deduplicated)
key counts. The counts are rebalanced first: joined as they come, the join would
reuse the aggregate's partitioning, and adaptive execution could not split a
key that holds much of the table.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.predicates import any_null, any_true
from .key_counts import KeyCounts
from .quality import compile_for
from .rules import FAIL, CompiledRule

AUDIT_COLUMNS = ["record_key", "column_name", "validation_rule", "validation_status", "error_details"]


def record_key(keys: list[str]) -> Column:
    """Key columns as one string: parts joined by '|', NULL parts as ''."""
    if not keys:
        return F.lit(None).cast("string")
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def _entry(column: str | None, rule: str, status: str, detail: Column, when: Column) -> Column:
    return F.when(when, F.struct(
        F.lit(column).cast("string").alias("column_name"),
        F.lit(rule).alias("validation_rule"),
        F.lit(status).alias("validation_status"),
        detail.cast("string").alias("error_details"),
    ))


def _row_entries(compiled: list[CompiledRule]) -> list[Column]:
    entries = []
    for r in compiled:
        if r.kind == "row":
            entries.append(_entry(r.column, r.rule_name, r.fail_status, r.detail, r.fail))
        elif r.kind == "nulls":
            for c, pred in r.cells:
                entries.append(_entry(c, r.rule_name, r.fail_status, F.lit("NULL value"), pred))
    return entries


def _dup_keys(df: DataFrame, keys: list[str], counts: KeyCounts | None = None) -> DataFrame:
    """Non-NULL keys that occur more than once, with their count (grouped pass, or the run's key counts)."""
    if counts is not None:
        return counts.of(keys).repeated
    return (df.filter(~any_null(keys)).groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("_bg_n")).filter(F.col("_bg_n") > 1).hint("rebalance"))


def failure_audit(df: DataFrame, rules: Any, key_columns: list[str], counts: KeyCounts | None = None) -> DataFrame:
    """Rows for failing records only: record_key, column_name, rule, status, details.
    ``counts``: key counts of ``df`` that the run has taken."""
    compiled = compile_for(df, rules)
    rk = record_key(key_columns).alias("record_key")
    parts: list[DataFrame] = []
    entries = _row_entries(compiled)
    if entries:
        parts.append(
            df.select(rk, F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull())).alias("_v"))
              .select("record_key", "_v.*"))
    for r in compiled:
        if r.kind != "unique":
            continue
        keys = r.keys
        cols = ", ".join(keys)
        null_rows = df.filter(any_null(keys)).select(
            rk, F.lit(cols).alias("column_name"), F.lit(r.rule_name).alias("validation_rule"),
            F.lit(r.fail_status).alias("validation_status"), F.lit("NULL key").alias("error_details"))
        dup_rows = df.filter(~any_null(keys)).join(_dup_keys(df, keys, counts), keys, "inner").select(
            rk, F.lit(cols).alias("column_name"), F.lit(r.rule_name).alias("validation_rule"),
            F.lit(r.fail_status).alias("validation_status"),
            F.format_string("duplicate key, %d occurrences", F.col("_bg_n")).alias("error_details"))
        parts.extend([null_rows, dup_rows])
    if not parts:
        return df.sparkSession.createDataFrame(
            [], "record_key string, column_name string, validation_rule string, "
                "validation_status string, error_details string")
    return reduce(DataFrame.unionByName, parts).select(*AUDIT_COLUMNS)


def flag_failures(df: DataFrame, rules: Any, failing_only: bool = False,
                  flag: str = "_dq_failed", counts: KeyCounts | None = None) -> DataFrame:
    """Add a boolean column: the row fails at least one rule.

    ``failing_only`` restricts to rules that FAIL when violated (a rule that
    only warns then leaves its rows valid).
    """
    compiled = [r for r in compile_for(df, rules) if not failing_only or r.fail_status == FAIL]
    preds = []
    for r in compiled:
        if r.kind == "row":
            preds.append(r.fail)
        elif r.kind == "nulls":
            preds.extend(p for _, p in r.cells)
    out = df.withColumn(flag, any_true(preds))
    for i, r in enumerate(r for r in compiled if r.kind == "unique"):
        mark = f"_bg_dup{i}"
        dups = _dup_keys(df, r.keys, counts).select(*r.keys, F.lit(True).alias(mark))
        out = (out.join(dups, r.keys, "left")
                  .withColumn(flag, F.col(flag) | any_null(r.keys) | F.coalesce(F.col(mark), F.lit(False)))
                  .drop(mark))
    return out


FAILED_RULES, FAILED = "_dq_rules", "_dq_failed"


def tag_failures(df: DataFrame, rules: Any) -> DataFrame:
    """Adds ``_dq_rules``, the names of the row-level rules that fail a row (NULL key parts of unique-key rules
    included), and ``_dq_failed``. Rules that only warn tag nothing. One projection, no pass of its own."""
    names = []
    for r in compile_for(df, rules):
        if r.fail_status != FAIL:
            continue
        failed = {"row": lambda r: r.fail, "nulls": lambda r: any_true(p for _, p in r.cells),
                  "unique": lambda r: any_null(r.keys)}.get(r.kind)
        if failed is not None:
            names.append(F.when(failed(r), F.lit(r.rule_name)))
    found = F.filter(F.array(*names), lambda x: x.isNotNull()) if names else F.lit(None).cast("array<string>")
    return df.withColumn(FAILED_RULES, F.coalesce(found, F.array().cast("array<string>"))).withColumn(FAILED, F.size(FAILED_RULES) > 0)


def tag_repeated_keys(tagged: DataFrame, rules: Any, counts: KeyCounts) -> DataFrame | None:
    """The tagged rows with the unique-key rules that their repeated keys fail; None if no key repeats."""
    out = None
    plain = tagged.drop(FAILED_RULES, FAILED)
    for i, r in enumerate(compile_for(plain, rules)):
        if r.kind != "unique" or r.fail_status != FAIL or not counts.of(r.keys).excess:
            continue
        mark = f"_bg_dup{i}"
        marks = counts.of(r.keys).repeated.select(*r.keys, F.lit(r.rule_name).alias(mark))
        out = (tagged if out is None else out).join(marks, r.keys, "left")
        more = F.when(F.col(mark).isNull(), F.array().cast("array<string>")).otherwise(F.array(mark))
        out = out.withColumn(FAILED_RULES, F.concat(FAILED_RULES, more)).drop(mark)
    return None if out is None else out.withColumn(FAILED, F.size(FAILED_RULES) > 0).select(*tagged.columns)


def split_valid_invalid(df: DataFrame, rules: Any, failing_only: bool = False,
                        counts: KeyCounts | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) rows; both keep the input columns in their order."""
    cols = df.columns
    flagged = flag_failures(df, rules, failing_only, counts=counts)
    return (flagged.filter(~F.col("_dq_failed")).select(*cols),
            flagged.filter(F.col("_dq_failed")).select(*cols))


def audit_table_rows(audit_rows: DataFrame, job_run_id: int, job_name: str, source_name: str | None,
                     business_date: str, table_name: str, as_of=None) -> DataFrame:
    """Audit rows in the ``dq_failure_audit`` layout.

    ``dq_failure_id`` is a 64-bit hash of the run, the violation and the row's
    number within the write, so ids of several runs appended to one table do
    not repeat; no driver round trip.
    """
    from ..functions.columns import as_of_column
    return audit_rows.select(
        F.xxhash64(F.lit(job_run_id).cast("bigint"), *AUDIT_COLUMNS, F.monotonically_increasing_id()).alias("dq_failure_id"),
        F.lit(job_run_id).cast("bigint").alias("job_run_id"),
        F.lit(job_name).alias("job_name"),
        F.lit(source_name).cast("string").alias("source_name"),
        F.lit(business_date).cast("timestamp").alias("business_date"),
        F.lit(table_name).alias("table_name"),
        *AUDIT_COLUMNS,
        as_of_column(as_of).alias("created_at"),
    ).select(*S.DQ_FAILURE_AUDIT.fieldNames())
