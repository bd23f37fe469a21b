"""Projections: metadata columns, prepared layout, NOT NULL enforcement."""

import pytest

from batchgate import schemas as S
from batchgate.functions import columns as C


def test_with_metadata_types(spark):
    df = C.with_metadata(spark.createDataFrame([("a",)], "k string"), 7, "2026-08-08", "crm", "2026-08-08 06:00:00")
    assert df.dtypes[1:] == [("batch_id", "bigint"), ("buisness_date", "timestamp"), ("source_name", "string"),
                             ("record_version", "bigint"), ("ingested_at", "timestamp"), ("updated_at", "timestamp")]
    r = df.collect()[0]
    assert (r["batch_id"], r["record_version"], r["updated_at"]) == (7, 1, None)


def test_project_to_prepared_customers(spark):
    bronze = C.with_metadata(spark.createDataFrame(
        [("C1", "Mona", "a@x", "5550101010", "Brayford"), ("C2", "Odo", "p@x", "98x", "Brayford")],
        "customer_id string, customer_name string, email string, phone string, city string"), 1, "2026-08-08", "crm")
    out = C.project_to_schema(bronze, S.PREPARED_CUSTOMERS)
    assert out.columns == S.PREPARED_CUSTOMERS.fieldNames()
    rows = {r["customer_id"]: r for r in out.collect()}
    assert rows["C1"]["phone"] == 5550101010 and rows["C2"]["phone"] is None
    assert rows["C1"]["customer_status"] is None
    bad = bronze.withColumn("customer_id", bronze["customer_id"].substr(5, 1))   # empty -> not NULL
    assert C.project_to_schema(bad, S.PREPARED_CUSTOMERS).count() == 2
    null_key = C.with_metadata(spark.createDataFrame([(None, "x")], "customer_id string, customer_name string"),
                               1, "2026-08-08", "crm")
    with pytest.raises(Exception, match="NOT NULL"):
        C.project_to_schema(null_key, S.PREPARED_CUSTOMERS).collect()


def test_rejected_values_are_counted_and_listed_in_one_write(spark, tmp_dir):
    from batchgate.functions import projection_with_rejects
    df = spark.createDataFrame([("1", "2", "x"), ("k", "3.5", "y"), (None, "", "z"), ("4", None, "w")], "a string, b string, c string")
    done = projection_with_rejects(df, ["c", "a", "b"], {"a": "int", "b": "int", "unused": "int"}, tmp_dir, keys=["c", "a"])
    assert done.counts == {"a": 1, "b": 2} and done.rows.columns == ["c", "a", "b"]
    assert sorted(map(tuple, done.rows.collect())) == [("w", 4, None), ("x", 1, 2), ("y", None, None), ("z", None, None)]
    assert sorted(map(tuple, done.rejects.collect())) == [("y|k", "a", "k", "int"), ("y|k", "b", "3.5", "int"), ("z|", "b", "", "int")]
    with pytest.raises(Exception, match="NOT NULL constraint violated: a"):
        projection_with_rejects(df, ["a"], {"a": "int"}, tmp_dir + "-null", not_null=["a"])
    plain = projection_with_rejects(df.limit(0), ["c"], {}, tmp_dir + "-plain")
    assert plain.counts == {} and plain.rows.count() == plain.rejects.count() == 0
