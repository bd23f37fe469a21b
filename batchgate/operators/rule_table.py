"""Rules kept as rows of a table (``dq_rules`` layout) -> rule configs.

The rule table is configuration: one row per rule, so collecting the active
rows is bounded by how many rules were written, never by the data checked.
"""

from __future__ import annotations

from decimal import Decimal, InvalidOperation

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _num(text: str | None) -> int | Decimal | None:
    """A threshold as written: a float would move bounds beyond 2**53 to a neighbour."""
    if text is None or text.strip() == "":
        return None
    try:
        v = Decimal(text.strip())
    except InvalidOperation:
        v = Decimal("NaN")
    if not v.is_finite():
        raise ValueError(f"threshold {text!r} is not a number")
    if "." not in text and v == v.to_integral_value():
        return int(v)
    return Decimal(format(v, "f"))


def _pair(threshold: str | None):
    if not threshold:
        return None, None
    lo, _, hi = threshold.partition(",")
    return _num(lo), _num(hi)


def rule_from_row(row) -> dict:
    """One ``dq_rules`` row -> rule config (rule_type names the rule)."""
    kind = row["rule_type"]
    column = row["column_name"]
    cfg: dict = {"name": kind, "severity": row["severity"] or "ERROR", "dialect": "library"}
    if kind in ("non_nullable", "unique_key"):
        cfg["columns"] = [c.strip() for c in (column or "").split(",") if c.strip()]
    elif kind in ("length", "range"):
        cfg["column"] = column
        cfg["min"], cfg["max"] = _pair(row["threshold_value"])
    elif kind == "row_count":
        cfg["min"], cfg["max"] = _pair(row["threshold_value"])
    elif kind == "allowed_values":
        cfg["column"] = column
        cfg["values"] = [v.strip() for v in (row["threshold_value"] or "").split(",") if v.strip()]
    elif kind == "numeric_only":
        cfg["column"] = column
    elif kind == "expression":
        cfg["column"] = column
        cfg["expression"] = row["expression"]
    else:
        cfg["column"] = column
        cfg["expression"] = row["expression"]
        cfg["threshold_value"] = row["threshold_value"]
    if row["rule_name"]:
        cfg["rule_name"] = row["rule_name"]
    return cfg


def rules_from_table(rules: DataFrame, job_name: str | None = None,
                     table_name: str | None = None) -> list[dict]:
    """Active rules of a job/table in ``rule_id`` order."""
    q = rules.filter(F.coalesce(F.col("is_active"), F.lit(False)))
    if job_name is not None:
        q = q.filter(F.col("job_name") == job_name)
    if table_name is not None:
        q = q.filter(F.col("table_name") == table_name)
    return [rule_from_row(r) for r in q.orderBy("rule_id").collect()]
