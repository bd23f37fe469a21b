"""Random small inputs vs brute-force Python versions of the semantics."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from batchgate.operators import merge, quality

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.sampled_from(list("abcdefgh")))


def brute_merge(target, batch):
    """SQL MERGE semantics: matched -> batch value, version m+r; new -> insert; rest kept."""
    by_key = {k: v for k, v in batch if k is not None}
    out = []
    for k, v, ver in target:
        if k is not None and k in by_key:
            out.append((k, by_key[k], None if ver is None else ver + 1, "u"))
        else:
            out.append((k, v, ver, "k"))
    tkeys = {k for k, _, _ in target if k is not None}
    out += [(k, v, 1, "i") for k, v in batch if k is None or k not in tkeys]
    return sorted(out, key=repr)


@SETTINGS
@given(st.lists(st.tuples(keys, st.integers(0, 9), st.one_of(st.none(), st.integers(1, 3))), max_size=8),
       st.lists(st.tuples(keys, st.integers(10, 19)), max_size=8),
       st.sampled_from(["shuffle", "broadcast"]))
def test_merge_matches_brute_force(spark, target, batch, strategy):
    # keys unique among non-NULL rows on each side (duplicates are refused separately)
    seen, t_rows = set(), []
    for k, v, ver in target:
        if k is None or k not in seen:
            seen.add(k) if k is not None else None
            t_rows.append((k, v, ver))
    seen, b_rows = set(), []
    for k, v in batch:
        if k is None or k not in seen:
            seen.add(k) if k is not None else None
            b_rows.append((k, v))
    t = spark.createDataFrame(t_rows, "k string, v long, record_version long")
    b = spark.createDataFrame([(k, v, 1) for k, v in b_rows], "k string, v long, record_version long")
    got = merge.merge_frames(t, b, "k", "2026-08-09 06:00:00", strategy=strategy, with_action=True)
    mark = {"update": "u", "keep": "k", "insert": "i"}
    rows = sorted(((r["k"], r["v"], r["record_version"], mark[r["_action"]]) for r in got.collect()), key=repr)
    assert rows == brute_merge(t_rows, b_rows)


values = st.one_of(st.none(), st.text(alphabet="ab1 2", max_size=4))
numbers = st.one_of(st.none(), st.floats(-5, 15), st.just(float("nan")))


@SETTINGS
@given(st.lists(st.tuples(values, numbers, keys), max_size=12))
def test_rules_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "s string, x double, k string")
    rules = [{"name": "non_nullable", "columns": ["s", "x"]},
             {"name": "length", "column": "s", "min": 1, "max": 3},
             {"name": "numeric_only", "column": "s"},
             {"name": "allowed_values", "column": "s", "values": ["a", "1", None]},
             {"name": "range", "column": "x", "min": 0, "max": 10},
             {"name": "unique_key", "columns": ["k"]},
             {"name": "row_count", "min": 1, "max": 10}]
    got = [(r["records_checked"], r["records_failed"], r["status"])
           for r in quality.collect_results(quality.evaluate(df, rules))]
    n = len(rows)
    s_vals = [s for s, _, _ in rows]
    x_vals = [x for _, x, _ in rows]
    nulls = sum(v is None for v in s_vals) + sum(v is None for v in x_vals)
    length = sum(v is not None and not (1 <= len(v) <= 3) for v in s_vals)
    numeric = sum(v is not None and not (v != "" and all(c in "0123456789" for c in v)) for v in s_vals)
    allowed = sum(v is not None and v not in ("a", "1") for v in s_vals)
    rng = sum(v is not None and (math.isnan(v) or v < 0 or v > 10) for v in x_vals)
    counts = {}
    for _, _, k in rows:
        counts[k] = counts.get(k, 0) + 1
    uniq = counts.get(None, 0) + sum(c - 1 for k, c in counts.items() if k is not None and c > 1)
    rc_fail = not (1 <= n <= 10)
    expected_failed = [nulls, length, numeric, allowed, rng, uniq, n if rc_fail else 0]
    assert [f for _, f, _ in got] == expected_failed
    assert all(c == n for c, _, _ in got)
    statuses = [("FAIL" if f else "PASS") for f in expected_failed[:6]] + ["FAIL" if rc_fail else "PASS"]
    assert [st_ for _, _, st_ in got] == statuses
