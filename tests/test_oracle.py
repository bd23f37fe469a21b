"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as E
from oracle_check import TABLES, canon

SF = "/root/testdata/sf0.001"
SQL = E.core_oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle_or_is_rows_only():
    rows_only = set(E.core_queries()) - set(SQL)
    assert rows_only == {"limit_preview"}
    assert set(SQL) <= set(E.core_queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = E.core_queries()[name](spark, SF)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(SQL[name])
    want = canon([c[0] for c in cur.description], cur.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
