"""Run every registered query against its DuckDB oracle and report matches.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if os.environ.get("ORACLE_EXACT") else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
            "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN", "smallint": "SMALLINT",
            "float": "FLOAT", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_diffs(spark_dtypes, duck_description):
    duck = {c[0]: str(c[1]) for c in duck_description}
    return [(n, t, duck.get(n)) for n, t in spark_dtypes if TYPE_MAP.get(t, t) != duck.get(n)]


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return ([cols[i] for i in order],
            sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr))


def main() -> int:
    import duckdb
    from pyspark.sql import SparkSession

    import __spark_entry__ as E

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", os.environ.get("ORACLE_TZ", "UTC"))
             .config("spark.sql.ansi.enabled", os.environ.get("ORACLE_ANSI", "true"))
             .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="batchgate-oracle-wh-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"ERROR  {name}: spark {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        secs = time.time() - t0
        if name not in sqls:
            print(f"ROWS   {name}: {len(rows)} rows (no oracle) {secs:.1f}s")
            continue
        try:
            cur = con.execute(sqls[name])
            ocols = [c[0] for c in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"ERROR  {name}: duckdb {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        a, b = canon(cols, rows), canon(ocols, orows)
        tdiff = type_diffs(df.dtypes, cur.description)
        if a == b and tdiff:
            bad += 1
            print(f"TYPES  {name}: {tdiff}")
        elif a == b:
            print(f"OK     {name}: {len(rows)} rows {secs:.1f}s")
        else:
            bad += 1
            print(f"DIFF   {name}: spark {len(rows)} rows {a[0]} vs oracle {len(orows)} rows {b[0]}")
            sa, sb = set(a[1]), set(b[1])
            print("   spark-only:", list(sa - sb)[:3])
            print("   oracle-only:", list(sb - sa)[:3])
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
