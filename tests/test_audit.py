"""Failure audit and the valid/invalid split."""

from batchgate.operators import audit


def test_audit_rows_per_violation(spark):
    df = spark.createDataFrame([(1, None, 5.0), (2, "a", -1.0), (2, "b", 3.0), (None, "z", 1.0)],
                               "id long, s string, x double")
    rules = [{"name": "non_nullable", "columns": ["s"]},
             {"name": "allowed_values", "column": "s", "values": ["a", "b"], "severity": "WARN"},
             {"name": "range", "column": "x", "min": 0},
             {"name": "unique_key", "columns": ["id"]}]
    got = sorted(tuple(r) for r in audit.failure_audit(df, rules, ["id"]).collect())
    assert got == sorted([
        ("1", "s", "non_nullable", "FAIL", "NULL value"),
        ("2", "x", "range", "FAIL", "outside [0, None]: -1.0"),
        ("", "s", "allowed_values", "WARN", "not allowed: z"),
        ("", "id", "unique_key", "FAIL", "NULL key"),
        ("2", "id", "unique_key", "FAIL", "duplicate key, 2 occurrences"),
        ("2", "id", "unique_key", "FAIL", "duplicate key, 2 occurrences"),
    ])
    valid, invalid = audit.split_valid_invalid(df, rules)
    assert valid.count() == 0 and invalid.count() == 4
    valid, invalid = audit.split_valid_invalid(df, rules, failing_only=True)
    assert valid.count() == 0 and {r["id"] for r in invalid.collect()} == {1, 2, None}
    valid, _ = audit.split_valid_invalid(df, rules[:2], failing_only=True)
    assert valid.count() == 3
