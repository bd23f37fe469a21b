"""Queries with SQL against DuckDB on the smallest tables, the others for their columns."""

import os

import duckdb
import pytest
from oracle_check import TABLES, canon

from batchgate.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": ["doc_id", "fingerprint", "component_id"], "op2": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op3": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], "op4": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op5": ["doc_id", "held_out", "score", "predicted"],
    "op6": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op7": ["doc_id", "size", "source_size", "target", "taken"], "op8": ["vec_id", "n_links", "component_id", "kept"],
    "op9": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"], "op10": ["doc_id", "held_out", "lang_pred", "score"],
    "op11": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op12": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op13": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
}


def test_one_query_for_each_operator():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(COLUMNS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    assert df.columns[:len(COLUMNS[name.split("_")[0]])] == COLUMNS[name.split("_")[0]]
    rows = [tuple(r) for r in df.collect()]
    if name in ORACLE_SQL:
        cur = con.execute(ORACLE_SQL[name])
        assert canon(df.columns, rows) == canon([c[0] for c in cur.description], cur.fetchall())
    else:
        table = "embeddings" if name.startswith("op8") else "documents"
        assert len(rows) == con.execute(f"SELECT count(*) FROM {table}").fetchall()[0][0]
