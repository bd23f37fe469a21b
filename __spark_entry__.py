"""

Every query reads the given parquet tables (or files Spark writes from them
into the session's shared checkpoint folder) and runs over the whole tables.
Timestamps are returned as TIMESTAMP_NTZ so they compare with DuckDB's
TIMESTAMP; every computed column is aliased the same on both sides.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable

if os.path.dirname(os.path.abspath(__file__)) not in sys.path:      # importable from any cwd
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from batchgate import schemas as S  # noqa: E402
from batchgate.functions import columns as C  # noqa: E402
from batchgate.functions import predicates as P  # noqa: E402
from batchgate.operators import audit, merge, quality  # noqa: E402
from batchgate.operators.rule_table import rules_from_table  # noqa: E402
from batchgate.plans import job, runs, sinks  # noqa: E402
from batchgate.session import TableRef, scratch_database, scratch_path  # noqa: E402
from batchgate.sources import files, tables  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF_1 = "2026-08-08 06:00:00"
AS_OF_2 = "2026-08-09 06:00:00"
RESULT = ["rule_name", "status", "severity", "records_checked", "records_failed"]


# --------------------------------------------------------------------------- helpers

def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _ntz(df: DataFrame) -> DataFrame:
    """TIMESTAMP (session zone) columns -> TIMESTAMP_NTZ for comparison."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def _write_csv(df: DataFrame, path: str, timestamp_format: str | None = None) -> None:
    w = df.write.option("header", True)
    if timestamp_format:
        w = w.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    w.csv(path)


def _customer_nulls(spark, d) -> DataFrame:
    """customer with NULLs made on purpose: segment BUILDING, nation 2."""
    c = _t(spark, d, "customer")
    return c.withColumns({"c_mktsegment": F.expr("nullif(c_mktsegment, 'BUILDING')"),
                          "c_nationkey": F.expr("nullif(c_nationkey, 2)")})


def _customer_codes(spark, d) -> DataFrame:
    """customer with a digit code (made non-numeric for negative balances) and
    the balance as text ('n/a' for segment BUILDING)."""
    c = _t(spark, d, "customer")
    return c.withColumns({
        "c_code": F.expr("concat(substring(c_name, 10), CASE WHEN c_acctbal < 0 THEN 'x' ELSE '' END)"),
        "c_acctbal_text": F.expr("CASE WHEN c_mktsegment = 'BUILDING' THEN 'n/a' ELSE cast(c_acctbal AS string) END"),
    })


def _results(df: DataFrame, rules) -> DataFrame:
    return quality.evaluate(df, rules).select(*RESULT)


# SQL fragments shared by oracles.
_CUST_NULLS = ("(SELECT c_custkey, c_name, NULLIF(c_nationkey, 2) AS c_nationkey, c_acctbal, "
               "NULLIF(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer)")
_CUST_CODES = ("(SELECT *, substring(c_name, 10) || CASE WHEN c_acctbal < 0 THEN 'x' ELSE '' END AS c_code, "
               "CASE WHEN c_mktsegment = 'BUILDING' THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR) END "
               "AS c_acctbal_text FROM customer)")


def _rule_sql(name: str, severity: str, checked: str, failed: str, source: str,
              fail_status: str = "FAIL") -> str:
    return (f"SELECT '{name}' AS rule_name, CASE WHEN f > 0 THEN '{fail_status}' ELSE 'PASS' END AS status, "
            f"'{severity}' AS severity, CAST(n AS BIGINT) AS records_checked, CAST(f AS BIGINT) AS records_failed "
            f"FROM (SELECT {checked} AS n, {failed} AS f FROM {source})")


def _unique_sql(keys: list[str], source: str, severity: str = "ERROR", status: str = "FAIL") -> str:
    kl = ", ".join(keys)
    anynull = " OR ".join(f"{k} IS NULL" for k in keys)
    nonull = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    g = f"(SELECT {kl}, count(*) AS n FROM {source} GROUP BY {kl})"
    return (f"SELECT 'unique_key' AS rule_name, CASE WHEN nulls + dups > 0 THEN '{status}' ELSE 'PASS' END AS status, "
            f"'{severity}' AS severity, checked AS records_checked, nulls + dups AS records_failed FROM ("
            f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS checked, "
            f"CAST(coalesce(sum(n) FILTER (WHERE {anynull}), 0) AS BIGINT) AS nulls, "
            f"CAST(coalesce(sum(n - 1) FILTER (WHERE {nonull} AND n > 1), 0) AS BIGINT) AS dups FROM {g})")


# --------------------------------------------------------------------------- scans

def q_scan_csv_schema(spark, d):
    cust = _t(spark, d, "customer")
    path = scratch_path(spark, "csv", "customer")
    _write_csv(cust, path)
    return files.scan_csv(spark, path, cust.schema, {"header": True, "delimiter": ","})


def q_scan_csv_infer(spark, d):
    cust = _t(spark, d, "customer")
    path = scratch_path(spark, "csv", "customer")
    _write_csv(cust, path)
    inferred = files.scan_csv_infer(spark, path)
    return inferred.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in cust.schema.fields])


def q_scan_catalog_schema(spark, d):
    cust = _t(spark, d, "customer")
    db = scratch_database(spark)
    raw = f"{db}.raw_customer"
    spark.catalog.createTable(raw, source="parquet",
                              schema=T.StructType(cust.schema.fields + S.METADATA_FIELDS))
    path = scratch_path(spark, "csv", "customer")
    _write_csv(cust, path)
    return files.scan_csv(spark, path, tables.table_schema(spark, raw), {"header": True})


def q_scan_csv_by_name(spark, d):
    """A drop whose header lists the columns in another order, bound by name."""
    cust = _t(spark, d, "customer")
    path = scratch_path(spark, "csv", "customer_reordered")
    _write_csv(cust.select(*reversed(cust.columns)), path)
    return files.scan_csv(spark, path, cust.schema, {"header": True, "binding": "name"})


def q_scan_csv_corrupt(spark, d):
    """Unparseable balances (text 'n/a' for segment BUILDING) become NULL and
    the raw line is kept in _corrupt_record."""
    cust = _t(spark, d, "customer")
    path = scratch_path(spark, "csv", "customer_corrupt")
    text = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    _write_csv(cust.withColumn("c_acctbal", text), path)
    parsed = files.scan_csv(spark, path, cust.schema, {"header": True}, corrupt=True)
    return parsed.select(*cust.columns, F.col(files.CORRUPT).isNotNull().alias("corrupt"))


def q_scan_by_name_two_headers(spark, d):
    """Two drops whose headers list the columns in different orders, read at once."""
    cust = _t(spark, d, "customer")
    base = scratch_path(spark, "csv", "customer_two")
    _write_csv(cust.filter("c_custkey % 2 = 0"), f"{base}/drop_01-01-2026.csv")
    _write_csv(cust.filter("c_custkey % 2 = 1").select(*reversed(cust.columns)), f"{base}/drop_02-01-2026.csv")
    src = {"type": "file", "format": "csv", "header": True, "binding": "name", "path": base,
           "file_format": "drop_{dd}-{MM}-{yyyy}.csv"}
    return files.scan_dated_files(spark, src, cust.schema)


def q_scan_by_name_recased(spark, d):
    """Three drops bound by name: names in another case, an optional column absent, a column that is read past."""
    cust = _t(spark, d, "customer")
    base = scratch_path(spark, "csv", "customer_recased")
    part = [cust.filter(f"c_custkey % 3 = {k}") for k in range(3)]
    _write_csv(part[0].toDF(*[c.upper() for c in cust.columns]), f"{base}/drop_01-01-2026.csv")
    _write_csv(part[1].drop("c_mktsegment"), f"{base}/drop_02-01-2026.csv")
    _write_csv(part[2].select(F.lit("x").alias("Loaded_By"), *reversed(cust.columns)), f"{base}/drop_03-01-2026.csv")
    src = {"type": "file", "format": "csv", "header": True, "binding": "name", "path": base, "file_format": "drop_{dd}-{MM}-{yyyy}.csv",
           "optional_columns": ["c_mktsegment"], "ignored_columns": ["loaded_by"]}
    return files.scan_dated_files(spark, src, cust.schema)


def q_scan_by_name_corrupt(spark, d):
    """As scan_csv_corrupt, the columns reordered and bound by name."""
    cust = _t(spark, d, "customer")
    path = scratch_path(spark, "csv", "customer_named_corrupt")
    text = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    _write_csv(cust.withColumn("c_acctbal", text).select(*reversed(cust.columns)), path)
    parsed = files.scan_csv(spark, path, cust.schema, {"header": True, "binding": "name"}, corrupt=True)
    return parsed.select(*cust.columns, F.col(files.CORRUPT).isNotNull().alias("corrupt"))


def q_scan_table(spark, d):
    db = scratch_database(spark)
    name = f"{db}.customer_copy"
    sinks.overwrite_table(_t(spark, d, "customer"), name)
    return tables.scan_table(spark, name)


_ORDERS_SOURCE = {"type": "file", "format": "csv", "header": True, "delimiter": ",",
                  "timestamp_format": "yyyy/MM/dd HH:mm:ss", "date_format": "dd/MM/yyyy",
                  "file_format": "_drop=orders_{dd}-{MM}-{yyyy}.csv"}


_DROPS: dict[tuple[str, str], tuple[dict, T.StructType]] = {}


def _orders_drops(spark, d) -> tuple[dict, T.StructType]:
    """orders written as one dated CSV drop per order day (once per session and table dir)."""
    key = (spark.sparkContext.applicationId, d)       # a later session has another id
    if key not in _DROPS:
        _DROPS[key] = _write_orders_drops(spark, d)
    return _DROPS[key]


def _write_orders_drops(spark, d) -> tuple[dict, T.StructType]:
    orders = _t(spark, d, "orders")
    base = scratch_path(spark, "drops", "orders")
    drop = F.concat(F.lit("orders_"), F.date_format("o_orderdate", "dd-MM-yyyy"), F.lit(".csv"))
    # An explicit partition count: AQE would otherwise coalesce the small
    # shuffle into one task writing every daily folder in turn.
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))
    (orders.withColumn("_drop", drop).repartition(parts, "_drop").write
           .option("header", True).option("timestampNTZFormat", "yyyy/MM/dd HH:mm:ss")
           .partitionBy("_drop").csv(base))
    return dict(_ORDERS_SOURCE, path=base), orders.schema


def q_scan_dated_files(spark, d):
    src, schema = _orders_drops(spark, d)
    return files.scan_dated_files(spark, src, schema)


def q_scan_dated_range(spark, d):
    src, schema = _orders_drops(spark, d)
    return files.scan_dated_files(spark, src, schema, start="1996-01-01", end="1996-12-31")


# --------------------------------------------------------------------------- sinks

def q_write_append(spark, d):
    part = _t(spark, d, "part")
    target = TableRef(path=scratch_path(spark, "tables", "part_append"))
    sinks.append_table(part, target)
    sinks.append_table(part, target)
    return tables.scan_table(spark, target)


def q_write_overwrite(spark, d):
    part = _t(spark, d, "part")
    target = TableRef(path=scratch_path(spark, "tables", "part_overwrite"))
    sinks.overwrite_table(part, target)
    sinks.overwrite_table(part.withColumn("p_retailprice", F.col("p_retailprice") + 1), target)
    return tables.scan_table(spark, target)


# --------------------------------------------------------------------------- projections

def q_project_metadata(spark, d):
    return _ntz(C.with_metadata(_t(spark, d, "customer"), 1, "2026-08-08", "crm", as_of=AS_OF_1))


def q_project_drop(spark, d):
    return C.drop_columns(_t(spark, d, "customer"), ["c_acctbal", "no_such_column"])


def q_prepared_projection(spark, d):
    enriched = C.with_metadata(_t(spark, d, "customer"), 1, "2026-08-08", "crm", as_of=AS_OF_1)
    cols = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "batch_id", "source_name",
            "record_version", "ingested_at", "updated_at"]
    return _ntz(C.prepared_projection(enriched, cols, casts={"c_nationkey": "bigint", "c_mktsegment": "bigint"},
                                      not_null=["c_custkey"]))


def _projected(spark, d) -> C.Projected:
    """Orders as text, some prices and dates unreadable, cast back."""
    o = _t(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).when(F.col("o_orderkey") % 11 == 0, F.lit(None))
         .otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("31/31/2026")).otherwise(F.col("o_orderdate").cast("string")).alias("o_orderdate"),
        "o_orderstatus")
    return C.projection_with_rejects(o, ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"],
                                     {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderdate": "date"},
                                     scratch_path(spark, "projected", "orders"), keys=["o_orderkey"], not_null=["o_orderkey"])


def q_prepared_rejects(spark, d):
    """Values that a typed projection could not cast: the row, the column and the text."""
    return _projected(spark, d).rejects


def q_prepared_reject_counts(spark, d):
    """The same projection's rows and its reject counts by column (observed on its write), and the values it kept."""
    done = _projected(spark, d)
    lost = F.create_map(*[F.lit(x) for c, n in done.counts.items() for x in (c, n)])
    kept = done.rows.agg(*[F.count(c).alias(c) for c in done.counts], F.count(F.lit(1)).alias("n"))
    return kept.select(F.col("n").alias("records"), F.explode(F.create_map(*[x for c in done.counts for x in (F.lit(c), F.col(c))]))
                       .alias("column_name", "kept")).withColumn("rejected", lost[F.col("column_name")].cast("bigint"))


def q_scalar_cast(spark, d):
    c = _t(spark, d, "customer")
    return c.select("c_custkey", F.col("c_custkey").cast("string").alias("key_text"),
                    F.col("c_nationkey").cast("bigint").alias("nation_big"),
                    F.col("c_name").try_cast("bigint").alias("name_number"))


def q_scalar_length(spark, d):
    p = _t(spark, d, "part")
    return p.select("p_partkey", F.length("p_name").alias("name_length"))


def q_scalar_case(spark, d):
    c = _t(spark, d, "customer")
    sign = (F.when(F.col("c_acctbal") < 0, "negative").when(F.col("c_acctbal") == 0, "zero")
             .otherwise("positive"))
    return c.select("c_custkey", sign.alias("balance_sign"))


def q_scalar_parse_ts(spark, d):
    o = _t(spark, d, "orders")
    text = F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss")) \
            .otherwise(F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss"))
    return _ntz(o.select("o_orderkey", C.parse_timestamp(text, "yyyy/MM/dd HH:mm:ss").alias("parsed_at")))


# --------------------------------------------------------------------------- filters

def q_filter_is_null(spark, d):
    return _customer_nulls(spark, d).filter(P.is_null("c_mktsegment"))


def q_filter_not_null(spark, d):
    return _customer_nulls(spark, d).filter(P.not_null("c_nationkey"))


def q_filter_any_null(spark, d):
    return _customer_nulls(spark, d).filter(P.any_null(["c_mktsegment", "c_nationkey"]))


def q_filter_not(spark, d):
    return _customer_nulls(spark, d).filter(~(F.col("c_nationkey") < 10))


def q_filter_and(spark, d):
    c = _t(spark, d, "customer")
    return c.filter((F.col("c_acctbal") < 0) & (F.col("c_mktsegment") == "BUILDING"))


def q_filter_outside_range(spark, d):
    c = _t(spark, d, "customer")
    return c.filter(P.outside_range("c_acctbal", 0, 9000, T.DoubleType()))


def q_filter_length(spark, d):
    return _t(spark, d, "part").filter(P.length_outside("p_name", 9, 11))


def q_filter_rlike(spark, d):
    return _customer_codes(spark, d).filter(P.not_digits("c_code")).select("c_custkey", "c_code")


def q_filter_not_in(spark, d):
    return _t(spark, d, "customer").filter(P.not_in("c_mktsegment", ["BUILDING", "MACHINERY", None]))


def q_filter_eq(spark, d):
    return _t(spark, d, "customer").filter(F.col("c_mktsegment") == "AUTOMOBILE")


# --------------------------------------------------------------------------- aggregates

def _failed_by_rule(results: DataFrame, names: list[str]) -> DataFrame:
    """One row: the failed records of each rule, in config order."""
    return results.agg(*[F.max(F.when(F.col("rule_index") == i, F.col("records_failed"))).alias(n) for i, n in enumerate(names)])


def q_agg_row_count(spark, d):
    r = quality.evaluate(_t(spark, d, "customer"), [{"name": "row_count", "min": 0}])
    return r.select(F.col("records_checked").alias("row_count"))


def q_agg_count_if(spark, d):
    c = _t(spark, d, "customer")
    return _failed_by_rule(quality.evaluate(c, [
        {"name": "expression", "expression": "c_acctbal >= 0"},
        {"name": "expression", "expression": "c_mktsegment <> 'BUILDING'"},
        {"name": "expression", "expression": "c_nationkey <= 20"},
    ]), ["negative_balance", "building", "high_nation"])


def q_agg_null_profile(spark, d):
    c = _customer_nulls(spark, d)
    names = ["c_custkey", "c_nationkey", "c_mktsegment"]
    return _failed_by_rule(quality.evaluate(c, [{"name": "non_nullable", "columns": [x]} for x in names]), names)


def q_agg_group_count(spark, d):
    return merge.key_counts(_t(spark, d, "orders"), ["o_custkey"]).withColumnRenamed("_bg_n", "n")


def q_agg_duplicate_excess(spark, d):
    r = quality.evaluate(_t(spark, d, "orders"), [{"name": "unique_key", "columns": ["o_custkey"]}])
    return r.select(F.col("records_failed").alias("duplicate_excess"))


# --------------------------------------------------------------------------- rules

def q_rule_non_nullable_rows(spark, d):
    return _results(_customer_nulls(spark, d),
                    [{"name": "non_nullable", "columns": ["c_mktsegment", "c_nationkey", "c_name"],
                      "count": "rows"}])


def q_rule_non_nullable_cells(spark, d):
    return _results(_customer_nulls(spark, d),
                    [{"name": "non_nullable", "columns": ["c_mktsegment", "c_nationkey", "c_name"],
                      "severity": "WARN"}])


def q_rule_unique_key(spark, d):
    return _results(_t(spark, d, "orders"), [{"name": "unique_key", "columns": ["o_custkey"]}])


def q_rule_unique_key_composite(spark, d):
    li = _t(spark, d, "lineitem").withColumn("l_linenumber", F.expr("nullif(l_linenumber, 7)"))
    return _results(li, [{"name": "unique_key", "columns": ["l_orderkey", "l_linenumber"]}])


def q_rule_length(spark, d):
    return _results(_t(spark, d, "part"), [{"name": "length", "column": "p_name", "min": 9, "max": 11}])


def q_rule_numeric_only(spark, d):
    return _results(_customer_codes(spark, d), [{"name": "numeric_only", "column": "c_code",
                                                 "severity": "WARN"}])


def q_rule_allowed_values(spark, d):
    return _results(_t(spark, d, "customer"),
                    [{"name": "allowed_values", "column": "c_mktsegment",
                      "values": ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", None]}])


def q_rule_range(spark, d):
    return _results(_t(spark, d, "customer"), [{"name": "range", "column": "c_acctbal", "min": 0, "max": 9000}])


def q_rule_range_text(spark, d):
    return _results(_customer_codes(spark, d),
                    [{"name": "range", "column": "c_acctbal_text", "min": 0, "max": 9000}])


def q_rule_range_text_exact(spark, d):
    """Amounts as text, around a bound that doubles cannot tell from its neighbours."""
    o = _t(spark, d, "orders").select(F.concat((F.col("o_orderkey") % 3 + F.lit(9007199254740991)).cast("string"),
                                               F.when(F.col("o_orderkey") % 5 == 0, "d").otherwise("")).alias("amount"))
    return _results(o, [{"name": "range", "column": "amount", "min": 0, "max": 9007199254740992}])


def q_rule_row_count(spark, d):
    return _results(_t(spark, d, "lineitem"), [{"name": "row_count", "min": 1, "max": 50000}])


def q_rule_column_block(spark, d):
    validation = {"rules": {"c_code": {"min_length": 9, "max_length": 9, "numeric_only": True,
                                       "severity": "WARN"}}}
    return _results(_customer_codes(spark, d), validation)


def q_rule_job_dialect(spark, d):
    """Job-config rules: a failure is FAIL whatever the severity; column blocks apply."""
    validation = {"non_nullable": {"columns": ["c_mktsegment", "c_name"], "severity": "WARN"},
                  "rules": {"c_code": {"min_length": 9, "max_length": 9, "numeric_only": True}}}
    df = _customer_codes(spark, d).withColumn("c_mktsegment", F.expr("nullif(c_mktsegment, 'BUILDING')"))
    return _results(df, validation)


def q_rule_mixed_dialects(spark, d):
    """Named rules before and after a rule list: all of them run, each under its own dialect."""
    validation = {"non_nullable": {"columns": ["c_mktsegment", "c_name"], "severity": "WARN"},
                  "rules": [{"name": "non_nullable", "columns": ["c_mktsegment", "c_nationkey"], "severity": "WARN"},
                            {"name": "length", "column": "c_name", "min": 18, "max": 18}],
                  "unique_key": {"columns": ["c_nationkey"], "severity": "INFO"}}
    return _results(_customer_nulls(spark, d), validation)


def q_dq_messages(spark, d):
    """Result rows with their messages (the full result contract)."""
    rules = [
        {"name": "non_nullable", "columns": ["c_mktsegment", "c_nationkey", "c_name"]},
        {"name": "unique_key", "columns": ["c_nationkey"]},
        {"name": "length", "column": "c_name", "min": 18, "max": 18},
        {"name": "allowed_values", "column": "c_mktsegment", "values": ["AUTOMOBILE", "FURNITURE"]},
        {"name": "range", "column": "c_acctbal", "min": 0, "max": 9000, "severity": "WARN"},
        {"name": "row_count", "max": 1000},
    ]
    return quality.evaluate(_customer_nulls(spark, d), rules).select(*RESULT, "message")


def q_rule_custom_expr(spark, d):
    return _results(_t(spark, d, "customer"),
                    [{"name": "expression", "expression": "c_acctbal >= -500", "severity": "WARN"}])


# --------------------------------------------------------------------------- rule sets

def _six_rules(cust: DataFrame) -> list[dict]:
    return [
        {"name": "non_nullable", "columns": ["c_custkey", "c_mktsegment"]},
        {"name": "unique_key", "columns": ["c_nationkey"], "severity": "WARN"},
        {"name": "length", "column": "c_name", "min": 18, "max": 18},
        {"name": "allowed_values", "column": "c_mktsegment",
         "values": ["AUTOMOBILE", "FURNITURE", "MACHINERY", "HOUSEHOLD"], "severity": "INFO"},
        {"name": "range", "column": "c_acctbal", "min": -1000, "max": 10000},
        {"name": "row_count", "min": 1},
        {"name": "schema", "expected_schema": cust.schema},
    ]


def q_dq_results(spark, d):
    cust = _customer_nulls(spark, d)
    return _results(cust, _six_rules(cust))


def q_dq_summary(spark, d):
    cust = _customer_nulls(spark, d)
    return quality.summarize(quality.evaluate(cust, _six_rules(cust)))


def q_dq_gate(spark, d):
    cust = _t(spark, d, "customer")
    rules = [r for r in _six_rules(cust) if r["name"] != "non_nullable"]
    results = quality.evaluate(cust, rules)
    quality.gate(results)   # raises if any rule FAILs; this set passes
    return results.select(*RESULT)


def q_dq_rules_table(spark, d):
    rows = [
        (1, "customers", "crm", "customer", "c_custkey,c_name", "not null keys", "non_nullable", None, None, "ERROR", True),
        (2, "customers", "crm", "customer", "c_acctbal", "balance range", "range", None, "0,9000", "WARN", True),
        (3, "customers", "crm", "customer", "c_mktsegment", "segments", "allowed_values", None,
         "AUTOMOBILE,BUILDING,FURNITURE,MACHINERY,HOUSEHOLD", "ERROR", True),
        (4, "customers", "crm", "customer", "c_name", "name length", "length", None, "19,", "ERROR", False),
        (5, "customers", "crm", "customer", "c_acctbal", "no big debt", "expression", "c_acctbal > -900", None, "WARN", True),
    ]
    ts = F.lit(AS_OF_1).cast("timestamp")
    rule_rows = spark.createDataFrame(rows, "rule_id bigint, job_name string, source_name string, table_name string, "
                                            "column_name string, rule_name string, rule_type string, expression string, "
                                            "threshold_value string, severity string, is_active boolean") \
                     .withColumns({"created_at": ts, "updated_at": ts})
    rules = rules_from_table(rule_rows, job_name="customers")
    for r in rules:
        r.pop("rule_name", None)
    return _results(_t(spark, d, "customer"), rules)


def q_dq_rules_table_exact(spark, d):
    """Thresholds of a rule table that doubles cannot tell from their neighbours, on whole numbers and on text."""
    big = "9007199254740993"
    rows = [(1, "orders", "amount", "range", f"0,{big}", "ERROR"), (2, "orders", "amount", "range", f"{big},", "WARN"),
            (3, "orders", "amount_text", "range", f"0,{big}.5", "ERROR"), (4, "orders", "amount", "row_count", "1,", "ERROR")]
    rule_rows = spark.createDataFrame([r + (None, None, True) for r in rows],
                                      "rule_id bigint, job_name string, column_name string, rule_type string, threshold_value string, "
                                      "severity string, rule_name string, expression string, is_active boolean")
    amount = F.lit(9007199254740992) + F.col("o_orderkey") % 4
    orders = _t(spark, d, "orders").select(amount.alias("amount"), F.concat(amount.cast("string"), F.lit(".25")).alias("amount_text"))
    return _results(orders, rules_from_table(rule_rows, job_name="orders"))


def _audit_rules() -> list[dict]:
    return [
        {"name": "non_nullable", "columns": ["c_mktsegment", "c_nationkey"]},
        {"name": "allowed_values", "column": "c_mktsegment",
         "values": ["AUTOMOBILE", "FURNITURE", "MACHINERY"], "severity": "WARN"},
        {"name": "range", "column": "c_acctbal", "min": 0, "max": 9000},
        {"name": "unique_key", "columns": ["c_nationkey"]},
    ]


def q_dq_failure_audit(spark, d):
    return audit.failure_audit(_customer_nulls(spark, d), _audit_rules(), ["c_custkey"])


def q_dq_split_valid(spark, d):
    rules = [r for r in _audit_rules() if r["name"] != "unique_key"]
    return audit.split_valid_invalid(_customer_nulls(spark, d), rules)[0]


def q_dq_split_invalid(spark, d):
    return audit.split_valid_invalid(_customer_nulls(spark, d), _audit_rules())[1]


# --------------------------------------------------------------------------- merge

def _merge_inputs(spark, d, null_keys: bool = False) -> tuple[DataFrame, DataFrame]:
    orders = _t(spark, d, "orders")
    if null_keys:
        orders = orders.withColumn("o_orderkey", F.expr("CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END"))
    target = C.with_metadata(orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")),
                             1, "2026-08-07", "crm", as_of=AS_OF_1)
    changed = orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) \
                    .withColumn("o_totalprice", F.col("o_totalprice") + 1)
    batch = C.with_metadata(changed, 2, "2026-08-08", "crm", as_of=AS_OF_2)
    return target, batch


def q_merge_upsert(spark, d):
    t, b = _merge_inputs(spark, d)
    return _ntz(merge.merge_frames(t, b, "o_orderkey", AS_OF_2))


def q_merge_broadcast(spark, d):
    t, b = _merge_inputs(spark, d)
    return _ntz(merge.merge_frames(t, b, "o_orderkey", AS_OF_2, strategy="broadcast"))


def q_merge_insert_only(spark, d):
    t, b = _merge_inputs(spark, d)
    return _ntz(merge.inserted_rows(t, b, "o_orderkey"))


def q_merge_update_only(spark, d):
    t, b = _merge_inputs(spark, d)
    return _ntz(merge.matched_rows(t, b, "o_orderkey", AS_OF_2))


def q_merge_key_types(spark, d):
    """A stored table with bigint keys, a batch whose keys are int: hashed under the stored type."""
    t, b = _merge_inputs(spark, d)
    target = TableRef(path=scratch_path(spark, "tables", "orders_keys"))
    big = t.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))
    merge.merge_into(spark, big, target, ["o_orderkey"], AS_OF_1, buckets=16)
    merge.merge_into(spark, b.withColumn("o_orderkey", F.col("o_orderkey").cast("int")), target, ["o_orderkey"], AS_OF_2, buckets=16)
    out = tables.scan_table(spark, target).drop(merge.BUCKET)
    return _ntz(out.withColumn("o_orderkey", F.col("o_orderkey").cast(t.schema["o_orderkey"].dataType)))


def q_merge_null_keys(spark, d):
    t, b = _merge_inputs(spark, d, null_keys=True)
    return _ntz(merge.merge_frames(t, b, "o_orderkey", AS_OF_2))


def q_merge_twice(spark, d):
    t, b = _merge_inputs(spark, d)
    once = merge.merge_frames(t, b, "o_orderkey", AS_OF_2)
    return _ntz(merge.merge_frames(once, b, ["o_orderkey"], "2026-08-10 06:00:00"))


def q_merge_dedupe(spark, d):
    """A batch holding two versions of recent orders; the later one wins."""
    t, b = _merge_inputs(spark, d)
    newer = b.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")) \
             .withColumn("o_totalprice", F.col("o_totalprice") + 1)
    batch = b.withColumn("_version", F.lit(1)).unionByName(newer.withColumn("_version", F.lit(2)))
    return _ntz(merge.merge_frames(t, merge.dedupe_latest(batch, ["o_orderkey"], "_version").drop("_version"),
                                   "o_orderkey", AS_OF_2))


def q_merge_metrics(spark, d):
    t, b = _merge_inputs(spark, d)
    return merge.merge_metrics(merge.merge_frames(t, b, "o_orderkey", AS_OF_2, with_action=True))


def q_merge_bucketed(spark, d):
    t, b = _merge_inputs(spark, d)
    target = TableRef(path=scratch_path(spark, "tables", "orders_bronze"))
    merge.merge_into(spark, t, target, ["o_orderkey"], AS_OF_1, buckets=16)
    merge.merge_into(spark, b, target, ["o_orderkey"], AS_OF_2, buckets=16)
    return _ntz(tables.scan_table(spark, target).drop(merge.BUCKET))


def q_merge_bucketed_table(spark, d):
    """The same two loads into a catalog table with Spark buckets on the key:
    the merge reads the target already partitioned and shuffles only the batch."""
    t, b = _merge_inputs(spark, d)
    name = f"{scratch_database(spark)}.orders_bronze"
    merge.merge_into(spark, t, name, ["o_orderkey"], AS_OF_1, buckets=16)
    merge.merge_into(spark, b, name, ["o_orderkey"], AS_OF_2, buckets=16, max_broadcast_bytes=0)
    return _ntz(tables.scan_table(spark, name).drop(merge.BUCKET))


# --------------------------------------------------------------------------- runs

def q_job_run_latest(spark, d):
    ev = _t(spark, d, "events")
    return runs.latest_runs(ev, run_id="user_id", order=("ts", "event_id")).select(*ev.columns)


def q_job_run_failed(spark, d):
    ev = _t(spark, d, "events")
    latest = runs.latest_runs(ev, run_id="user_id", order=("ts", "event_id"))
    return latest.filter(F.col("event_type") == "error").select(*ev.columns)


def q_job_run_counters(spark, d):
    ev = _t(spark, d, "events")
    invalid = F.count_if(F.col("event_type") == "error")
    return ev.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("records_read"),
        (F.count(F.lit(1)) - invalid).alias("records_valid"),
        invalid.alias("records_invalid"),
        F.max("ts").alias("finished_at"))


def _customer_job(base: str, target_root: str) -> dict:
    return {
        "job": {"name": "customers", "type": "batch", "frequency": "daily", "mode": "load"},
        "source": {"name": "crm", "type": "file", "format": "csv", "header": True, "delimiter": ",",
                   "path": base, "date_format": "dd/MM/yyyy", "timestamp_format": "yyyy/MM/dd HH:mm:ss",
                   "file_format": "crm_customer_{dd}-{MM}-{yyyy}.csv"},
        "target": {"raw": {"path": f"{target_root}/raw", "format": "parquet"},
                   "master": {"path": f"{target_root}/bronze", "format": "parquet"},
                   "write": {"mode": "merge", "keys": "c_custkey", "buckets": 16}},
        "validation": {"non_nullable": {"columns": ["c_custkey", "c_name"]},
                       "rules": {"c_name": {"min_length": 18, "max_length": 18}}},
    }


def _two_day_load(spark, d, mode: str) -> DataFrame:
    cust = _t(spark, d, "customer")
    base = scratch_path(spark, "drops", "crm")
    _write_csv(cust, f"{base}/crm_customer_08-08-2026.csv")
    _write_csv(cust.withColumn("c_acctbal", F.col("c_acctbal") + 1), f"{base}/crm_customer_09-08-2026.csv")
    cfg = _customer_job(base, scratch_path(spark, "tables", "customers"))
    cfg["target"]["write"] = {"mode": mode}
    for day, batch, as_of in (("2026-08-08", 1, AS_OF_1), ("2026-08-09", 2, AS_OF_2)):
        job.run_job(spark, cfg, {"business_date": day, "batch_id": batch, "source_name": "crm"},
                    schema=cust.schema, as_of=as_of)
    return _ntz(tables.scan_table(spark, TableRef.of(cfg["target"]["master"])))


def q_job_append_load(spark, d):
    """Two daily loads in append mode: the master keeps both batches."""
    return _two_day_load(spark, d, "append")


def q_job_overwrite_load(spark, d):
    """Two daily loads in overwrite mode: the master holds the last batch only."""
    return _two_day_load(spark, d, "overwrite")


def q_job_run_control(spark, d):
    """Run control after a load that succeeds and one the gate rejects."""
    cust = _t(spark, d, "customer")
    base = scratch_path(spark, "drops", "crm")
    _write_csv(cust, f"{base}/crm_customer_08-08-2026.csv")
    _write_csv(cust.withColumn("c_name", F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None))
                               .otherwise(F.col("c_name"))), f"{base}/crm_customer_09-08-2026.csv")
    cfg = _customer_job(base, scratch_path(spark, "tables", "customers"))
    control = TableRef(path=scratch_path(spark, "tables", "job_run_control"))
    job.run_job(spark, cfg, {"business_date": "2026-08-08", "batch_id": 1, "source_name": "crm"},
                schema=cust.schema, as_of=AS_OF_1, control=control, job_run_id=1)
    try:
        job.run_job(spark, cfg, {"business_date": "2026-08-09", "batch_id": 2, "source_name": "crm"},
                    schema=cust.schema, as_of=AS_OF_2, control=control, job_run_id=2)
    except quality.ValidationError:
        pass
    latest = runs.latest_runs(tables.scan_table(spark, control))
    return _ntz(latest.select("job_run_id", "job_name", "source_name", "business_date", "batch_id", "run_status",
                              "run_type", "records_read", "records_valid", "records_invalid", "records_inserted",
                              "records_updated", "records_merged", "retry_count"))


def _quarantine_runs(spark, d) -> tuple[dict, TableRef]:
    """Two days of customers under rules that some rows fail; day 2 repeats the keys of one segment."""
    cust = _t(spark, d, "customer")
    base, root = scratch_path(spark, "drops", "crm"), scratch_path(spark, "tables", "customers")
    day2 = cust.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    _write_csv(cust, f"{base}/crm_customer_08-08-2026.csv")
    _write_csv(day2.unionByName(day2.filter("c_mktsegment = 'MACHINERY'")), f"{base}/crm_customer_09-08-2026.csv")
    cfg = _customer_job(base, root)
    cfg["target"]["quarantine"] = {"path": f"{root}/quarantine", "format": "parquet"}
    cfg["validation"] = {"non_nullable": {"columns": ["c_custkey"]},
                         "rules": [{"name": "range", "column": "c_acctbal", "min": 0},
                                   {"name": "allowed_values", "column": "c_mktsegment", "values": ["AUTOMOBILE"], "severity": "WARN"},
                                   {"name": "length", "column": "c_name", "max": 18}, {"name": "unique_key", "columns": ["c_custkey"]}]}
    control = TableRef(path=f"{root}/control")
    for day, batch, as_of in (("2026-08-08", 1, AS_OF_1), ("2026-08-09", 2, AS_OF_2)):
        job.run_job(spark, cfg, {"business_date": day, "batch_id": batch, "source_name": "crm"},
                    schema=cust.schema, as_of=as_of, control=control, job_run_id=batch, skip_if_loaded=True)
    return cfg, control


def q_job_quarantine_load(spark, d):
    """Valid rows merged, invalid rows set aside with the rules they fail (one landed copy, two days)."""
    cfg, _ = _quarantine_runs(spark, d)
    master = tables.scan_table(spark, TableRef.of(cfg["target"]["master"])).drop(merge.BUCKET)
    aside = tables.scan_table(spark, TableRef.of(cfg["target"]["quarantine"]))
    rows = master.withColumn("failed_rules", F.lit(None).cast("string")).unionByName(
        aside.withColumn("failed_rules", F.concat_ws(",", F.array_sort("failed_rules"))))
    return _ntz(rows)


def q_job_run_counters_loaded(spark, d):
    """Counters of real runs, read from the control table: rows read, valid, set aside, inserted, updated."""
    _, control = _quarantine_runs(spark, d)
    return runs.latest_runs(tables.scan_table(spark, control)).select(
        "job_run_id", "batch_id", "run_status", "records_read", "records_valid", "records_invalid", "records_inserted",
        "records_updated", "records_merged", "retry_count")


def q_job_append_replayed(spark, d):
    """An append whose first attempt died: two thirds of its rows are in the table already; run again, all stand there once."""
    cust = _t(spark, d, "customer")
    target = TableRef(path=scratch_path(spark, "tables", "customers_once"))
    other = C.with_metadata(cust, 1, "2026-08-08", "crm", AS_OF_1)
    batch = C.with_metadata(cust.unionByName(cust.filter("c_custkey % 5 = 0")), 2, "2026-08-09", "crm", AS_OF_2)
    own = merge.own_rows(2, "2026-08-09", "crm")
    sinks.append_table(other, target)
    sinks.append_table(batch.filter("c_custkey % 3 <> 0"), target)
    rows = batch.count()
    for _ in range(2):                  # the second run finds everything in place
        sinks.append_once(batch, target, own, rows, AS_OF_2)
    return _ntz(tables.scan_table(spark, target))


def q_job_bronze_load(spark, d):
    cust = _t(spark, d, "customer")
    base = scratch_path(spark, "drops", "crm")
    _write_csv(cust, f"{base}/crm_customer_08-08-2026.csv")
    _write_csv(cust.withColumn("c_acctbal", F.col("c_acctbal") + 1), f"{base}/crm_customer_09-08-2026.csv")
    cfg = _customer_job(base, scratch_path(spark, "tables", "customers"))
    job.run_job(spark, cfg, {"business_date": "2026-08-08", "batch_id": 1, "source_name": "crm"},
                schema=cust.schema, as_of=AS_OF_1)
    job.run_job(spark, cfg, {"business_date": "2026-08-09", "batch_id": 2, "source_name": "crm"},
                schema=cust.schema, as_of=AS_OF_2)
    return _ntz(tables.scan_table(spark, TableRef.of(cfg["target"]["master"])).drop(merge.BUCKET))


def _lineitem_rules() -> list[dict]:
    return [
        {"name": "non_nullable", "columns": ["l_orderkey", "l_partkey", "l_suppkey"]},
        {"name": "unique_key", "columns": ["l_orderkey", "l_linenumber"]},
        {"name": "length", "column": "l_returnflag", "min": 1, "max": 1},
        {"name": "numeric_only", "column": "l_linenumber"},
        {"name": "allowed_values", "column": "l_linestatus", "values": ["O", "F"]},
        {"name": "range", "column": "l_discount", "min": 0, "max": 0.1},
        {"name": "range", "column": "l_quantity", "min": 1, "max": 50, "severity": "WARN"},
        {"name": "row_count", "min": 1},
    ]


def q_dq_lineitem_rules(spark, d):
    return _results(_t(spark, d, "lineitem"), _lineitem_rules())


def _orders_job(base: str, target_root: str) -> dict:
    return {
        "job": {"name": "orders", "type": "batch", "frequency": "daily", "mode": "load"},
        "source": {"name": "crm", "type": "file", "format": "csv", "header": True, "delimiter": ",",
                   "path": base, "date_format": "dd/MM/yyyy", "timestamp_format": "yyyy/MM/dd HH:mm:ss",
                   "file_format": "crm_orders_{dd}-{MM}-{yyyy}.csv"},
        "target": {"raw": {"path": f"{target_root}/raw", "format": "parquet"},
                   "master": {"path": f"{target_root}/bronze", "format": "parquet"},
                   "write": {"mode": "merge", "keys": "o_orderkey", "buckets": 32}},
        "validation": {"rules": [
            {"name": "non_nullable", "columns": ["o_orderkey", "o_custkey"]},
            {"name": "unique_key", "columns": ["o_orderkey"]},
            {"name": "allowed_values", "column": "o_orderstatus", "values": ["F", "O", "P"]},
            {"name": "range", "column": "o_totalprice", "min": 0},
        ]},
    }


def q_job_orders_load(spark, d):
    """Two daily drops of orders (older orders, then recent ones with new
    prices) through CSV parsing, rules, metadata and the bucketed merge."""
    orders = _t(spark, d, "orders")
    base = scratch_path(spark, "drops", "crm_orders")
    day1 = orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    day2 = orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) \
                 .withColumn("o_totalprice", F.col("o_totalprice") + 1)
    fmt = "yyyy/MM/dd HH:mm:ss"
    _write_csv(day1, f"{base}/crm_orders_07-08-2026.csv", fmt)
    _write_csv(day2, f"{base}/crm_orders_08-08-2026.csv", fmt)
    cfg = _orders_job(base, scratch_path(spark, "tables", "orders"))
    job.run_job(spark, cfg, {"business_date": "2026-08-07", "batch_id": 1, "source_name": "crm"},
                schema=orders.schema, as_of=AS_OF_1)
    job.run_job(spark, cfg, {"business_date": "2026-08-08", "batch_id": 2, "source_name": "crm"},
                schema=orders.schema, as_of=AS_OF_2)
    return _ntz(tables.scan_table(spark, TableRef.of(cfg["target"]["master"])).drop(merge.BUCKET))


# --------------------------------------------------------------------------- limits

def q_limit_preview(spark, d):
    return _t(spark, d, "customer").limit(10)


def q_limit_preview_ordered(spark, d):
    return _t(spark, d, "customer").orderBy("c_custkey").limit(10)


# --------------------------------------------------------------------------- contract

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: two daily CSV loads of customer (rules, metadata, merge) at sf0.001."""
    return q_job_bronze_load(spark, SMOKE_DIR)


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}


def _optional(module: str, attribute: str) -> dict:
    """``attribute`` of a module that may have been removed ({} then); any
    other import failure is raised."""
    try:
        return getattr(importlib.import_module(module), attribute)
    except ModuleNotFoundError as e:
        if e.name is None or not (module == e.name or e.name == "batchgate.llm"):
            raise
        return {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The core queries, and those of batchgate.llm and corpus_pipeline where present."""
    return {**core_queries(), **_optional("batchgate.llm.queries", "QUERIES"),
            **_optional("corpus_pipeline", "QUERIES")}


_META_T = ("CAST(1 AS BIGINT) AS batch_id, TIMESTAMP '2026-08-07 00:00:00' AS buisness_date, 'crm' AS source_name, "
           "CAST(1 AS BIGINT) AS record_version, TIMESTAMP '2026-08-08 06:00:00' AS ingested_at, "
           "CAST(NULL AS TIMESTAMP) AS updated_at")
_META_B = ("CAST(2 AS BIGINT) AS batch_id, TIMESTAMP '2026-08-08 00:00:00' AS buisness_date, 'crm' AS source_name, "
           "CAST(1 AS BIGINT) AS record_version, TIMESTAMP '2026-08-09 06:00:00' AS ingested_at, "
           "CAST(NULL AS TIMESTAMP) AS updated_at")
_O_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_O_B_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority"
_ALL_M = _O_COLS + ", batch_id, buisness_date, source_name, record_version, ingested_at, updated_at"


def _merge_sql(key_expr: str = "o_orderkey", as_of: str = "2026-08-09 06:00:00",
               b_cols: str = _O_B_COLS) -> str:
    src = f"(SELECT {key_expr} AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders)"
    upd_cols = ", ".join(f"b.{c}" for c in _O_COLS.split(", "))
    return (
        f"WITH t AS (SELECT {_O_COLS}, {_META_T} FROM {src} WHERE o_orderdate < TIMESTAMP '1999-01-01'), "
        f"b AS (SELECT {b_cols}, {_META_B} FROM {src} WHERE o_orderdate >= TIMESTAMP '1998-01-01') "
        f"SELECT {_ALL_M}, 'keep' AS _action FROM t WHERE o_orderkey IS NULL OR NOT EXISTS "
        f"(SELECT 1 FROM b WHERE b.o_orderkey = t.o_orderkey) "
        f"UNION ALL SELECT {_ALL_M}, 'insert' AS _action FROM b WHERE o_orderkey IS NULL OR NOT EXISTS "
        f"(SELECT 1 FROM t WHERE t.o_orderkey = b.o_orderkey) "
        f"UNION ALL SELECT {upd_cols}, b.batch_id, b.buisness_date, b.source_name, "
        f"t.record_version + b.record_version AS record_version, b.ingested_at, "
        f"TIMESTAMP '{as_of}' AS updated_at, 'update' AS _action FROM t JOIN b ON t.o_orderkey = b.o_orderkey")


def _no_action(sql: str, where: str | None = None) -> str:
    cond = f" WHERE {where}" if where else ""
    return f"SELECT {_ALL_M} FROM ({sql}){cond}"


def _events_latest() -> str:
    return ("SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER "
            "(PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")


def _six_rules_sql(source: str, with_non_nullable: bool = True) -> list[str]:
    parts = []
    if with_non_nullable:
        parts.append(_rule_sql("non_nullable", "ERROR", "count(*)",
                               "count(*) FILTER (WHERE c_custkey IS NULL) + count(*) FILTER (WHERE c_mktsegment IS NULL)",
                               source))
    parts += [
        _unique_sql(["c_nationkey"], source, "WARN", "WARN"),
        _rule_sql("length", "ERROR", "count(*)",
                  "count(*) FILTER (WHERE c_name IS NOT NULL AND (length(c_name) < 18 OR length(c_name) > 18))", source),
        _rule_sql("allowed_values", "INFO", "count(*)",
                  "count(*) FILTER (WHERE c_mktsegment IS NOT NULL AND c_mktsegment NOT IN "
                  "('AUTOMOBILE', 'FURNITURE', 'MACHINERY', 'HOUSEHOLD'))", source, "WARN"),
        _rule_sql("range", "ERROR", "count(*)",
                  "count(*) FILTER (WHERE c_acctbal IS NOT NULL AND (c_acctbal < -1000 OR c_acctbal > 10000))", source),
        ("SELECT 'row_count' AS rule_name, CASE WHEN n < 1 THEN 'FAIL' ELSE 'PASS' END AS status, 'ERROR' AS severity, "
         f"CAST(n AS BIGINT) AS records_checked, CAST(CASE WHEN n < 1 THEN n ELSE 0 END AS BIGINT) AS records_failed "
         f"FROM (SELECT count(*) AS n FROM {source})"),
        ("SELECT 'schema' AS rule_name, 'PASS' AS status, 'ERROR' AS severity, CAST(0 AS BIGINT) AS records_checked, "
         "CAST(0 AS BIGINT) AS records_failed"),
    ]
    return parts


def _audit_sql() -> str:
    src = _CUST_NULLS
    key = "CAST(c_custkey AS VARCHAR)"
    return " UNION ALL ".join([
        f"SELECT {key} AS record_key, 'c_mktsegment' AS column_name, 'non_nullable' AS validation_rule, "
        f"'FAIL' AS validation_status, 'NULL value' AS error_details FROM {src} WHERE c_mktsegment IS NULL",
        f"SELECT {key}, 'c_nationkey', 'non_nullable', 'FAIL', 'NULL value' FROM {src} WHERE c_nationkey IS NULL",
        f"SELECT {key}, 'c_mktsegment', 'allowed_values', 'WARN', 'not allowed: ' || c_mktsegment FROM {src} "
        f"WHERE c_mktsegment IS NOT NULL AND c_mktsegment NOT IN ('AUTOMOBILE', 'FURNITURE', 'MACHINERY')",
        f"SELECT {key}, 'c_acctbal', 'range', 'FAIL', 'outside [0, 9000]: ' || CAST(c_acctbal AS VARCHAR) FROM {src} "
        f"WHERE c_acctbal IS NOT NULL AND (c_acctbal < 0 OR c_acctbal > 9000)",
        f"SELECT {key}, 'c_nationkey', 'unique_key', 'FAIL', 'NULL key' FROM {src} WHERE c_nationkey IS NULL",
        f"SELECT {key}, 'c_nationkey', 'unique_key', 'FAIL', 'duplicate key, ' || CAST(g.n AS VARCHAR) || ' occurrences' "
        f"FROM {src} s JOIN (SELECT c_nationkey, count(*) AS n FROM {src} WHERE c_nationkey IS NOT NULL "
        f"GROUP BY c_nationkey HAVING count(*) > 1) g USING (c_nationkey)",
    ])


_AUDIT_FAIL = ("c_mktsegment IS NULL OR c_nationkey IS NULL OR c_mktsegment NOT IN ('AUTOMOBILE', 'FURNITURE', 'MACHINERY') "
               "OR c_acctbal < 0 OR c_acctbal > 9000")

_CUST_META = ("c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(1 AS BIGINT) AS batch_id, "
              "TIMESTAMP '2026-08-08 00:00:00' AS buisness_date, 'crm' AS source_name, CAST(1 AS BIGINT) AS record_version, "
              "TIMESTAMP '2026-08-08 06:00:00' AS ingested_at, CAST(NULL AS TIMESTAMP) AS updated_at")


def _quarantine_sql() -> str:
    """Master and quarantine of two days, day 2 holding the MACHINERY rows twice with balances one higher."""
    def failed(balance: str, again: str) -> str:
        return (f"concat_ws(',', CASE WHEN length(c_name) > 18 THEN 'length' END, CASE WHEN {balance} < 0 THEN 'range' END, "
                f"CASE WHEN {again} THEN 'unique_key' END)")
    def meta(batch: int, day: str, version: int, ingested: str, updated: str) -> str:
        return (f"CAST({batch} AS BIGINT) AS batch_id, TIMESTAMP '{day} 00:00:00' AS buisness_date, 'crm' AS source_name, "
                f"CAST({version} AS BIGINT) AS record_version, TIMESTAMP '{ingested} 06:00:00' AS ingested_at, {updated} AS updated_at")
    null = "CAST(NULL AS TIMESTAMP)"
    one, two = meta(1, "2026-08-08", 1, "2026-08-08", null), meta(2, "2026-08-09", 1, "2026-08-09", null)
    both = meta(2, "2026-08-09", 2, "2026-08-09", "TIMESTAMP '2026-08-09 06:00:00'")
    cols, up = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment", "c_custkey, c_name, c_nationkey, c_acctbal + 1, c_mktsegment"
    machine = "c_mktsegment = 'MACHINERY'"
    return (f"WITH f AS (SELECT *, {failed('c_acctbal', 'false')} AS f1, {failed('c_acctbal + 1', machine)} AS f2 FROM customer) "
            f"SELECT {cols}, {one}, CAST(NULL AS VARCHAR) AS failed_rules FROM f WHERE f1 = '' AND f2 <> '' "
            f"UNION ALL SELECT {up}, {both}, NULL FROM f WHERE f1 = '' AND f2 = '' "
            f"UNION ALL SELECT {up}, {two}, NULL FROM f WHERE f1 <> '' AND f2 = '' "
            f"UNION ALL SELECT {cols}, {one}, f1 FROM f WHERE f1 <> '' "
            f"UNION ALL SELECT {up}, {two}, f2 FROM (SELECT * FROM f UNION ALL SELECT * FROM f WHERE {machine}) WHERE f2 <> ''")


def oracle_sql() -> dict[str, str]:
    return {**core_oracle_sql(), **_optional("batchgate.llm.queries", "ORACLE_SQL"),
            **_optional("corpus_pipeline", "ORACLE_SQLS")}


def core_oracle_sql() -> dict[str, str]:
    merge_all = _merge_sql()
    union = lambda parts: " UNION ALL ".join(parts)
    six = union(_six_rules_sql(_CUST_NULLS))
    twice_first = _merge_sql()
    return {
        "scan_csv_schema": "SELECT * FROM customer",
        "scan_csv_infer": "SELECT * FROM customer",
        "scan_catalog_schema": "SELECT * FROM customer",
        "scan_table": "SELECT * FROM customer",
        "scan_dated_files": "SELECT *, CAST(o_orderdate AS DATE) AS business_date FROM orders",
        "scan_dated_range": ("SELECT *, CAST(o_orderdate AS DATE) AS business_date FROM orders "
                             "WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"),
        "write_append": "SELECT * FROM part UNION ALL SELECT * FROM part",
        "write_overwrite": ("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice + 1 AS p_retailprice "
                            "FROM part"),
        "project_metadata": f"SELECT {_CUST_META} FROM customer",
        "project_drop": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
        "prepared_projection": ("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, "
                                "TRY_CAST(c_mktsegment AS BIGINT) AS c_mktsegment, CAST(1 AS BIGINT) AS batch_id, "
                                "'crm' AS source_name, CAST(1 AS BIGINT) AS record_version, "
                                "TIMESTAMP '2026-08-08 06:00:00' AS ingested_at, CAST(NULL AS TIMESTAMP) AS updated_at "
                                "FROM customer"),
        "scalar_cast": ("SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS key_text, CAST(c_nationkey AS BIGINT) AS nation_big, "
                        "TRY_CAST(c_name AS BIGINT) AS name_number FROM customer"),
        "scalar_length": "SELECT p_partkey, CAST(length(p_name) AS INTEGER) AS name_length FROM part",
        "scalar_case": ("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal = 0 THEN 'zero' "
                        "ELSE 'positive' END AS balance_sign FROM customer"),
        "scalar_parse_ts": ("SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderdate END "
                            "AS parsed_at FROM orders"),
        "filter_is_null": f"SELECT * FROM {_CUST_NULLS} WHERE c_mktsegment IS NULL",
        "filter_not_null": f"SELECT * FROM {_CUST_NULLS} WHERE c_nationkey IS NOT NULL",
        "filter_any_null": f"SELECT * FROM {_CUST_NULLS} WHERE c_mktsegment IS NULL OR c_nationkey IS NULL",
        "filter_not": f"SELECT * FROM {_CUST_NULLS} WHERE NOT (c_nationkey < 10)",
        "filter_and": "SELECT * FROM customer WHERE c_acctbal < 0 AND c_mktsegment = 'BUILDING'",
        "filter_outside_range": "SELECT * FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000",
        "filter_length": "SELECT * FROM part WHERE length(p_name) < 9 OR length(p_name) > 11",
        "filter_rlike": f"SELECT c_custkey, c_code FROM {_CUST_CODES} WHERE NOT regexp_full_match(c_code, '[0-9]+')",
        "filter_not_in": "SELECT * FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')",
        "filter_eq": "SELECT * FROM customer WHERE c_mktsegment = 'AUTOMOBILE'",
        "agg_row_count": "SELECT count(*) AS row_count FROM customer",
        "agg_count_if": ("SELECT count(*) FILTER (WHERE c_acctbal < 0) AS negative_balance, "
                         "count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS building, "
                         "count(*) FILTER (WHERE c_nationkey > 20) AS high_nation FROM customer"),
        "agg_null_profile": ("SELECT " + ", ".join(
            f"CAST(coalesce(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS {c}"
            for c in ["c_custkey", "c_nationkey", "c_mktsegment"]) + f" FROM {_CUST_NULLS}"),
        "agg_group_count": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey",
        "agg_duplicate_excess": ("SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_excess FROM "
                                 "(SELECT count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1)"),
        "rule_non_nullable_rows": _rule_sql(
            "non_nullable", "ERROR", "count(*)",
            "count(*) FILTER (WHERE c_mktsegment IS NULL OR c_nationkey IS NULL OR c_name IS NULL)", _CUST_NULLS),
        "rule_non_nullable_cells": _rule_sql(
            "non_nullable", "WARN", "count(*)",
            "count(*) FILTER (WHERE c_mktsegment IS NULL) + count(*) FILTER (WHERE c_nationkey IS NULL) "
            "+ count(*) FILTER (WHERE c_name IS NULL)", _CUST_NULLS, "WARN"),
        "rule_unique_key": _unique_sql(["o_custkey"], "orders"),
        "rule_unique_key_composite": _unique_sql(
            ["l_orderkey", "l_linenumber"],
            "(SELECT l_orderkey, NULLIF(l_linenumber, 7) AS l_linenumber FROM lineitem)"),
        "rule_length": _rule_sql("length", "ERROR", "count(*)",
                                 "count(*) FILTER (WHERE p_name IS NOT NULL AND (length(p_name) < 9 OR length(p_name) > 11))",
                                 "part"),
        "rule_numeric_only": _rule_sql("numeric_only", "WARN", "count(*)",
                                       "count(*) FILTER (WHERE c_code IS NOT NULL AND NOT regexp_full_match(c_code, '[0-9]+'))",
                                       _CUST_CODES, "WARN"),
        "rule_allowed_values": _rule_sql(
            "allowed_values", "ERROR", "count(*)",
            "count(*) FILTER (WHERE c_mktsegment IS NOT NULL AND c_mktsegment NOT IN "
            "('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY'))", "customer"),
        "rule_range": _rule_sql("range", "ERROR", "count(*)",
                                "count(*) FILTER (WHERE c_acctbal IS NOT NULL AND (c_acctbal < 0 OR c_acctbal > 9000))",
                                "customer"),
        "rule_range_text": _rule_sql(
            "range", "ERROR", "count(*)",
            "count(*) FILTER (WHERE c_acctbal_text IS NOT NULL AND (TRY_CAST(c_acctbal_text AS DOUBLE) IS NULL "
            "OR TRY_CAST(c_acctbal_text AS DOUBLE) < 0 OR TRY_CAST(c_acctbal_text AS DOUBLE) > 9000))", _CUST_CODES),
        "rule_row_count": ("SELECT 'row_count' AS rule_name, CASE WHEN n < 1 OR n > 50000 THEN 'FAIL' ELSE 'PASS' END "
                           "AS status, 'ERROR' AS severity, CAST(n AS BIGINT) AS records_checked, "
                           "CAST(CASE WHEN n < 1 OR n > 50000 THEN n ELSE 0 END AS BIGINT) AS records_failed "
                           "FROM (SELECT count(*) AS n FROM lineitem)"),
        "rule_column_block": union([
            _rule_sql("length", "WARN", "count(*)",
                      "count(*) FILTER (WHERE c_code IS NOT NULL AND (length(c_code) < 9 OR length(c_code) > 9))",
                      _CUST_CODES),
            _rule_sql("numeric_only", "WARN", "count(*)",
                      "count(*) FILTER (WHERE c_code IS NOT NULL AND NOT regexp_full_match(c_code, '[0-9]+'))",
                      _CUST_CODES),
        ]),
        "dq_messages": (
            f"WITH s AS (SELECT * FROM {_CUST_NULLS}), "
            "a AS (SELECT count(*) AS n, count(*) FILTER (WHERE c_mktsegment IS NULL) AS n_seg, "
            "count(*) FILTER (WHERE c_nationkey IS NULL) AS n_nat, count(*) FILTER (WHERE c_name IS NULL) AS n_name, "
            "count(*) FILTER (WHERE c_name IS NOT NULL AND length(c_name) <> 18) AS n_len, "
            "count(*) FILTER (WHERE c_mktsegment IS NOT NULL AND c_mktsegment NOT IN ('AUTOMOBILE', 'FURNITURE')) AS n_allowed, "
            "count(*) FILTER (WHERE c_acctbal < 0 OR c_acctbal > 9000) AS n_range FROM s), "
            "g AS (SELECT c_nationkey, count(*) AS k FROM s GROUP BY c_nationkey), "
            "u AS (SELECT CAST(coalesce(sum(k) FILTER (WHERE c_nationkey IS NULL), 0) AS BIGINT) AS nulls, "
            "CAST(coalesce(sum(k - 1) FILTER (WHERE c_nationkey IS NOT NULL AND k > 1), 0) AS BIGINT) AS dups FROM g) "
            "SELECT 'non_nullable' AS rule_name, CASE WHEN n_seg + n_nat + n_name > 0 THEN 'FAIL' ELSE 'PASS' END AS status, "
            "'ERROR' AS severity, n AS records_checked, n_seg + n_nat + n_name AS records_failed, "
            "CASE WHEN n_seg + n_nat + n_name > 0 THEN 'Null values found in mandatory columns: ' || concat_ws(', ', "
            "CASE WHEN n_seg > 0 THEN 'c_mktsegment=' || n_seg END, CASE WHEN n_nat > 0 THEN 'c_nationkey=' || n_nat END, "
            "CASE WHEN n_name > 0 THEN 'c_name=' || n_name END) "
            "ELSE 'All mandatory columns passed null validation.' END AS message FROM a "
            "UNION ALL SELECT 'unique_key', CASE WHEN nulls + dups > 0 THEN 'FAIL' ELSE 'PASS' END, 'ERROR', n, nulls + dups, "
            "CASE WHEN nulls + dups > 0 THEN 'Key validation failed. null_key_records=' || nulls || ', duplicate_records=' "
            "|| dups ELSE 'Key validation passed for columns: [''c_nationkey'']' END FROM a, u "
            "UNION ALL SELECT 'length', CASE WHEN n_len > 0 THEN 'FAIL' ELSE 'PASS' END, 'ERROR', n, n_len, "
            "CASE WHEN n_len > 0 THEN 'Length validation failed for ''c_name''. min=18, max=18' "
            "ELSE 'Length validation passed for ''c_name''.' END FROM a "
            "UNION ALL SELECT 'allowed_values', CASE WHEN n_allowed > 0 THEN 'FAIL' ELSE 'PASS' END, 'ERROR', n, n_allowed, "
            "CASE WHEN n_allowed > 0 THEN 'Invalid values found in ''c_mktsegment''. Allowed=[''AUTOMOBILE'', ''FURNITURE'']' "
            "ELSE 'Allowed-value validation passed for ''c_mktsegment''.' END FROM a "
            "UNION ALL SELECT 'range', CASE WHEN n_range > 0 THEN 'WARN' ELSE 'PASS' END, 'WARN', n, n_range, "
            "CASE WHEN n_range > 0 THEN 'Range validation failed for ''c_acctbal''. min=0, max=9000' "
            "ELSE 'Range validation passed for ''c_acctbal''.' END FROM a "
            "UNION ALL SELECT 'row_count', CASE WHEN n > 1000 THEN 'FAIL' ELSE 'PASS' END, 'ERROR', n, "
            "CASE WHEN n > 1000 THEN n ELSE 0 END, CASE WHEN n > 1000 THEN 'Row count validation failed. actual=' || n "
            "|| ', min=None, max=1000' ELSE 'Row count validation passed. actual=' || n END FROM a"),
        "rule_custom_expr": _rule_sql("expression", "WARN", "count(*)",
                                      "count(*) FILTER (WHERE NOT (c_acctbal >= -500))", "customer", "WARN"),
        "dq_results": six,
        "dq_summary": ("SELECT CASE WHEN count(*) FILTER (WHERE status = 'FAIL' AND severity IN ('ERROR', 'FATAL')) > 0 "
                       "THEN 'FAIL' WHEN count(*) FILTER (WHERE status = 'WARN') > 0 THEN 'WARN' ELSE 'PASS' END "
                       "AS overall_status, count(*) AS total_rules, count(*) FILTER (WHERE status = 'PASS') AS passed_rules, "
                       "count(*) FILTER (WHERE status = 'FAIL') AS failed_rules, "
                       f"count(*) FILTER (WHERE status = 'WARN') AS warning_rules FROM ({six})"),
        "dq_gate": union(_six_rules_sql("customer", with_non_nullable=False)),
        "dq_rules_table": union([
            _rule_sql("non_nullable", "ERROR", "count(*)",
                      "count(*) FILTER (WHERE c_custkey IS NULL) + count(*) FILTER (WHERE c_name IS NULL)", "customer"),
            _rule_sql("range", "WARN", "count(*)",
                      "count(*) FILTER (WHERE c_acctbal IS NOT NULL AND (c_acctbal < 0 OR c_acctbal > 9000))",
                      "customer", "WARN"),
            _rule_sql("allowed_values", "ERROR", "count(*)",
                      "count(*) FILTER (WHERE c_mktsegment IS NOT NULL AND c_mktsegment NOT IN "
                      "('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY', 'HOUSEHOLD'))", "customer"),
            _rule_sql("expression", "WARN", "count(*)", "count(*) FILTER (WHERE NOT (c_acctbal > -900))",
                      "customer", "WARN"),
        ]),
        "dq_rules_table_exact": union([
            _rule_sql("range", "ERROR", "count(*)", "count(*) FILTER (WHERE o_orderkey % 4 > 1)", "orders"),
            _rule_sql("range", "WARN", "count(*)", "count(*) FILTER (WHERE o_orderkey % 4 < 1)", "orders", "WARN"),
            _rule_sql("range", "ERROR", "count(*)", "count(*) FILTER (WHERE o_orderkey % 4 > 1)", "orders"),
            _rule_sql("row_count", "ERROR", "count(*)", "0", "orders"),
        ]),
        "rule_mixed_dialects": union([
            _rule_sql("non_nullable", "WARN", "count(*)", "count(*) FILTER (WHERE c_mktsegment IS NULL OR c_name IS NULL)", _CUST_NULLS),
            _rule_sql("non_nullable", "WARN", "count(*)",
                      "count(*) FILTER (WHERE c_mktsegment IS NULL) + count(*) FILTER (WHERE c_nationkey IS NULL)", _CUST_NULLS, "WARN"),
            _rule_sql("length", "ERROR", "count(*)",
                      "count(*) FILTER (WHERE c_name IS NOT NULL AND length(c_name) <> 18)", _CUST_NULLS),
            _unique_sql(["c_nationkey"], _CUST_NULLS, "INFO"),
        ]),
        "dq_failure_audit": _audit_sql(),
        "dq_split_valid": (f"SELECT * FROM {_CUST_NULLS} WHERE NOT coalesce(c_mktsegment IS NULL OR c_nationkey IS NULL "
                           "OR (c_mktsegment IS NOT NULL AND c_mktsegment NOT IN ('AUTOMOBILE', 'FURNITURE', 'MACHINERY')) "
                           "OR (c_acctbal IS NOT NULL AND (c_acctbal < 0 OR c_acctbal > 9000)), false)"),
        "dq_split_invalid": (f"SELECT * FROM {_CUST_NULLS} s WHERE coalesce({_AUDIT_FAIL}, false) "
                             f"OR c_nationkey IN (SELECT c_nationkey FROM {_CUST_NULLS} WHERE c_nationkey IS NOT NULL "
                             "GROUP BY c_nationkey HAVING count(*) > 1)"),
        "merge_upsert": _no_action(merge_all),
        "merge_broadcast": _no_action(merge_all),
        "merge_bucketed": _no_action(merge_all),
        "merge_bucketed_table": _no_action(merge_all),
        "merge_insert_only": _no_action(merge_all, "_action = 'insert'"),
        "merge_update_only": _no_action(merge_all, "_action = 'update'"),
        "merge_null_keys": _no_action(_merge_sql("CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END")),
        "merge_twice": (
            f"WITH once AS ({_no_action(twice_first)}), "
            f"b AS (SELECT {_O_B_COLS}, {_META_B} FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01') "
            f"SELECT {_ALL_M} FROM once WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey = once.o_orderkey) "
            f"UNION ALL SELECT {', '.join('b.' + c for c in _O_COLS.split(', '))}, b.batch_id, b.buisness_date, "
            f"b.source_name, once.record_version + b.record_version AS record_version, b.ingested_at, "
            f"TIMESTAMP '2026-08-10 06:00:00' AS updated_at FROM once JOIN b ON once.o_orderkey = b.o_orderkey"),
        "merge_dedupe": _no_action(_merge_sql(b_cols=(
            "o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' "
            "THEN (o_totalprice + 1) + 1 ELSE o_totalprice + 1 END AS o_totalprice, o_orderdate, o_orderpriority"))),
        "merge_metrics": ("SELECT count(*) FILTER (WHERE _action = 'insert') AS records_inserted, "
                          "count(*) FILTER (WHERE _action = 'update') AS records_updated, "
                          "count(*) FILTER (WHERE _action <> 'keep') AS records_merged, "
                          "count(*) FILTER (WHERE _action = 'keep') AS records_kept, "
                          f"count(*) AS records_total FROM ({merge_all})"),
        "job_run_latest": _events_latest(),
        "job_run_failed": f"SELECT * FROM ({_events_latest()}) WHERE event_type = 'error'",
        "job_run_counters": ("SELECT user_id, count(*) AS records_read, "
                             "count(*) - count(*) FILTER (WHERE event_type = 'error') AS records_valid, "
                             "count(*) FILTER (WHERE event_type = 'error') AS records_invalid, max(ts) AS finished_at "
                             "FROM events GROUP BY user_id"),
        "scan_csv_by_name": "SELECT * FROM customer",
        "scan_by_name_two_headers": ("SELECT *, CASE WHEN c_custkey % 2 = 0 THEN DATE '2026-01-01' ELSE DATE '2026-01-02' END "
                                     "AS business_date FROM customer"),
        "scan_by_name_recased": ("SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_custkey % 3 = 1 THEN NULL ELSE c_mktsegment END "
                                 "AS c_mktsegment, DATE '2026-01-01' + CAST(c_custkey % 3 AS INTEGER) AS business_date FROM customer"),
        "scan_by_name_corrupt": ("SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL "
                                 "ELSE c_acctbal END AS c_acctbal, c_mktsegment, c_mktsegment = 'BUILDING' AS corrupt "
                                 "FROM customer"),
        "merge_key_types": _no_action(merge_all),
        "rule_range_text_exact": _rule_sql(
            "range", "ERROR", "count(*)",
            "count(*) FILTER (WHERE o_orderkey % 5 = 0 OR o_orderkey % 3 + 9007199254740991 > 9007199254740992)", "orders"),
        "scan_csv_corrupt": ("SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL "
                             "ELSE c_acctbal END AS c_acctbal, c_mktsegment, c_mktsegment = 'BUILDING' AS corrupt "
                             "FROM customer"),
        "rule_job_dialect": union([
            _rule_sql("non_nullable", "WARN", "count(*)",
                      "count(*) FILTER (WHERE c_mktsegment = 'BUILDING' OR c_name IS NULL)", _CUST_CODES),
            _rule_sql("length", "ERROR", "count(*)",
                      "count(*) FILTER (WHERE c_code IS NOT NULL AND (length(c_code) < 9 OR length(c_code) > 9))",
                      _CUST_CODES),
            _rule_sql("numeric_only", "ERROR", "count(*)",
                      "count(*) FILTER (WHERE c_code IS NOT NULL AND NOT regexp_full_match(c_code, '[0-9]+'))",
                      _CUST_CODES),
        ]),
        "job_append_load": (
            f"SELECT {_CUST_META} FROM customer UNION ALL "
            "SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1, c_mktsegment, CAST(2 AS BIGINT), "
            "TIMESTAMP '2026-08-09 00:00:00', 'crm', CAST(1 AS BIGINT), TIMESTAMP '2026-08-09 06:00:00', "
            "CAST(NULL AS TIMESTAMP) FROM customer"),
        "job_overwrite_load": (
            "SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment, "
            "CAST(2 AS BIGINT) AS batch_id, TIMESTAMP '2026-08-09 00:00:00' AS buisness_date, 'crm' AS source_name, "
            "CAST(1 AS BIGINT) AS record_version, TIMESTAMP '2026-08-09 06:00:00' AS ingested_at, "
            "CAST(NULL AS TIMESTAMP) AS updated_at FROM customer"),
        "job_run_control": (
            "SELECT CAST(1 AS BIGINT) AS job_run_id, 'customers' AS job_name, 'crm' AS source_name, "
            "TIMESTAMP '2026-08-08 00:00:00' AS business_date, CAST(1 AS BIGINT) AS batch_id, 'SUCCEEDED' AS run_status, "
            "'load' AS run_type, count(*) AS records_read, count(*) AS records_valid, CAST(0 AS BIGINT) AS records_invalid, "
            "count(*) AS records_inserted, CAST(0 AS BIGINT) AS records_updated, count(*) AS records_merged, "
            "0 AS retry_count FROM customer "
            "UNION ALL SELECT 2, 'customers', 'crm', TIMESTAMP '2026-08-09 00:00:00', 2, 'FAILED', 'load', count(*), "
            "NULL, NULL, NULL, NULL, NULL, 0 FROM customer"),
        "prepared_rejects": (
            "SELECT CAST(o_orderkey AS VARCHAR) AS record_key, 'o_custkey' AS column_name, 'n/a' AS value, 'bigint' AS wanted_type "
            "FROM orders WHERE o_orderkey % 7 = 0 UNION ALL "
            "SELECT CAST(o_orderkey AS VARCHAR), 'o_orderdate', '31/31/2026', 'date' FROM orders WHERE o_orderkey % 5 = 0"),
        "prepared_reject_counts": (
            "SELECT count(*) AS records, 'o_orderkey' AS column_name, count(*) AS kept, CAST(0 AS BIGINT) AS rejected FROM orders UNION ALL "
            "SELECT count(*), 'o_custkey', count(*) FILTER (WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0), "
            "count(*) FILTER (WHERE o_orderkey % 7 = 0) FROM orders UNION ALL "
            "SELECT count(*), 'o_orderdate', count(*) FILTER (WHERE o_orderkey % 5 <> 0), count(*) FILTER (WHERE o_orderkey % 5 = 0) FROM orders"),
        "job_quarantine_load": _quarantine_sql(),
        "job_run_counters_loaded": (
            "WITH c AS (SELECT c_custkey, c_acctbal, c_mktsegment, length(c_name) > 18 AS long FROM customer), "
            "n AS (SELECT count(*) AS n, count(*) FILTER (WHERE c_acctbal < 0 OR long) AS bad1, "
            "count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS twice, "
            "count(*) FILTER (WHERE c_mktsegment <> 'MACHINERY' AND (c_acctbal + 1 < 0 OR long)) AS bad2, "
            "count(*) FILTER (WHERE c_mktsegment <> 'MACHINERY' AND NOT (c_acctbal + 1 < 0 OR long) AND c_acctbal < 0) AS fresh FROM c) "
            "SELECT CAST(1 AS BIGINT) AS job_run_id, CAST(1 AS BIGINT) AS batch_id, 'SUCCEEDED' AS run_status, n AS records_read, "
            "n - bad1 AS records_valid, bad1 AS records_invalid, n - bad1 AS records_inserted, CAST(0 AS BIGINT) AS records_updated, "
            "n - bad1 AS records_merged, 0 AS retry_count FROM n UNION ALL "
            "SELECT 2, 2, 'SUCCEEDED', n + twice, n - twice - bad2, bad2 + 2 * twice, fresh, n - twice - bad2 - fresh, n - twice - bad2, 0 FROM n"),
        "job_append_replayed": (
            f"SELECT {_CUST_META} FROM customer UNION ALL "
            "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(2 AS BIGINT), TIMESTAMP '2026-08-09 00:00:00', 'crm', "
            "CAST(1 AS BIGINT), TIMESTAMP '2026-08-09 06:00:00', CAST(NULL AS TIMESTAMP) "
            "FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 5 = 0)"),
        "job_bronze_load": ("SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment, "
                            "CAST(2 AS BIGINT) AS batch_id, TIMESTAMP '2026-08-09 00:00:00' AS buisness_date, "
                            "'crm' AS source_name, CAST(2 AS BIGINT) AS record_version, "
                            "TIMESTAMP '2026-08-09 06:00:00' AS ingested_at, TIMESTAMP '2026-08-09 06:00:00' AS updated_at "
                            "FROM customer"),
        "dq_lineitem_rules": union([
            _rule_sql("non_nullable", "ERROR", "count(*)",
                      "count(*) FILTER (WHERE l_orderkey IS NULL) + count(*) FILTER (WHERE l_partkey IS NULL) "
                      "+ count(*) FILTER (WHERE l_suppkey IS NULL)", "lineitem"),
            _unique_sql(["l_orderkey", "l_linenumber"], "lineitem"),
            _rule_sql("length", "ERROR", "count(*)",
                      "count(*) FILTER (WHERE l_returnflag IS NOT NULL AND (length(l_returnflag) < 1 "
                      "OR length(l_returnflag) > 1))", "lineitem"),
            _rule_sql("numeric_only", "ERROR", "count(*)",
                      "count(*) FILTER (WHERE l_linenumber IS NOT NULL AND NOT regexp_full_match("
                      "CAST(l_linenumber AS VARCHAR), '[0-9]+'))", "lineitem"),
            _rule_sql("allowed_values", "ERROR", "count(*)",
                      "count(*) FILTER (WHERE l_linestatus IS NOT NULL AND l_linestatus NOT IN ('O', 'F'))", "lineitem"),
            _rule_sql("range", "ERROR", "count(*)",
                      "count(*) FILTER (WHERE l_discount IS NOT NULL AND (l_discount < 0 OR l_discount > 0.1))",
                      "lineitem"),
            _rule_sql("range", "WARN", "count(*)",
                      "count(*) FILTER (WHERE l_quantity IS NOT NULL AND (l_quantity < 1 OR l_quantity > 50))",
                      "lineitem", "WARN"),
            ("SELECT 'row_count' AS rule_name, CASE WHEN n < 1 THEN 'FAIL' ELSE 'PASS' END AS status, "
             "'ERROR' AS severity, CAST(n AS BIGINT) AS records_checked, "
             "CAST(CASE WHEN n < 1 THEN n ELSE 0 END AS BIGINT) AS records_failed FROM (SELECT count(*) AS n FROM lineitem)"),
        ]),
        "job_orders_load": _no_action(merge_all),
        "limit_preview_ordered": "SELECT * FROM customer ORDER BY c_custkey LIMIT 10",
    }
