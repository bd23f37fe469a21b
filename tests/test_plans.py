"""Structural targets, read from the physical plans (explain output)."""

import contextlib
import io
import re

from batchgate.functions.columns import with_metadata
from batchgate.operators import merge, quality

SF = "/root/testdata/sf0.001"


def plan(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def test_any_number_of_row_rules_is_one_scan_plus_one_per_unique_key(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    rules = [{"name": "non_nullable", "columns": ["l_orderkey", "l_partkey"]},
             {"name": "length", "column": "l_returnflag", "min": 1, "max": 1},
             {"name": "numeric_only", "column": "l_linenumber"},
             {"name": "allowed_values", "column": "l_linestatus", "values": ["O", "F"]},
             {"name": "range", "column": "l_discount", "min": 0, "max": 0.1},
             {"name": "range", "column": "l_quantity", "min": 1, "max": 50},
             {"name": "row_count", "min": 1}]
    assert len(re.findall(r"FileScan parquet", plan(quality.evaluate(li, rules)))) == 1
    two_unique = rules + [{"name": "unique_key", "columns": ["l_orderkey", "l_linenumber"]},
                          {"name": "unique_key", "columns": ["l_partkey"]}]
    assert len(re.findall(r"FileScan parquet", plan(quality.evaluate(li, two_unique)))) == 3


def test_rule_scan_reads_only_rule_columns(spark):
    part = spark.read.parquet(f"{SF}/part.parquet")
    p = plan(quality.evaluate(part, [{"name": "length", "column": "p_name", "min": 9}]), "formatted")
    assert "ReadSchema: struct<p_name:string>" in p


def test_merge_plans(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    t = with_metadata(orders, 1, "2026-08-07", "crm")
    b = with_metadata(orders.limit(100), 2, "2026-08-08", "crm")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    shuffle = plan(merge.merge_frames(t, b, "o_orderkey", strategy="shuffle"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "LeftOuter" in shuffle and "LeftAnti" in shuffle and "FullOuter" not in shuffle
    assert "SortMergeJoin" in shuffle
    bcast = plan(merge.merge_frames(t, b, "o_orderkey", strategy="broadcast"))
    assert "BroadcastHashJoin" in bcast and "SortMergeJoin" not in bcast


def test_unique_key_aggregates_partially_before_the_shuffle(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    p = plan(quality.evaluate(orders, [{"name": "unique_key", "columns": ["o_custkey"]}]))
    assert "partial_count" in p
