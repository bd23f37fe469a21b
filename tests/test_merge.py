"""Merge semantics and invariants (section 7.5 of the blueprint)."""

import os

import pytest
from pyspark.sql import functions as F

from batchgate.functions.columns import with_metadata
from batchgate.operators import merge
from batchgate.session import TableRef

AS_OF = "2026-08-09 06:00:00"
SCHEMA = "k string, v long"


def frames(spark, target_rows, batch_rows):
    t = with_metadata(spark.createDataFrame(target_rows, SCHEMA), 1, "2026-08-08", "crm", "2026-08-08 06:00:00")
    b = with_metadata(spark.createDataFrame(batch_rows, SCHEMA), 2, "2026-08-09", "crm", AS_OF)
    return t, b


def rows(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (str(r["k"]), r["v"] or 0, r["_action"]))


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
def test_matched_new_untouched_and_null_keys(spark, strategy):
    t, b = frames(spark, [("a", 1), ("b", 2), (None, 3)], [("a", 10), ("c", 30), (None, 40)])
    out = rows(merge.merge_frames(t, b, "k", AS_OF, strategy=strategy, with_action=True))
    by = {(r["k"], r["v"]): r for r in out}
    assert len(out) == 3 + 2 + 0          # target + inserted (c, NULL)
    assert by[("a", 10)]["_action"] == "update" and by[("a", 10)]["record_version"] == 2
    assert by[("a", 10)]["updated_at"] is not None and by[("a", 10)]["batch_id"] == 2
    assert by[("b", 2)]["_action"] == "keep" and by[("b", 2)]["batch_id"] == 1
    assert by[("c", 30)]["_action"] == "insert" and by[("c", 30)]["updated_at"] is None
    assert by[(None, 3)]["_action"] == "keep" and by[(None, 40)]["_action"] == "insert"


def test_same_batch_twice_only_versions_change(spark):
    t, b = frames(spark, [("a", 1), ("b", 2)], [("a", 10), ("c", 30), (None, 5)])
    once = merge.merge_frames(t, b, "k", AS_OF)
    twice = merge.merge_frames(once, b, "k", "2026-08-10 06:00:00")
    got = {(r["k"], r["v"]): r for r in twice.collect()}
    assert got[("a", 10)]["record_version"] == 3 and got[("c", 30)]["record_version"] == 2
    assert got[("b", 2)]["record_version"] == 1
    assert sum(1 for r in twice.collect() if r["k"] is None) == 2      # NULL keys grow each run


def test_composite_key_and_null_version(spark):
    t = spark.createDataFrame([("a", 1, None, None), ("a", 2, 1, None)],
                              "k1 string, k2 int, record_version long, updated_at timestamp")
    b = spark.createDataFrame([("a", 1, 1, None), ("a", 2, 1, None)],
                              "k1 string, k2 int, record_version long, updated_at timestamp")
    out = {(r["k1"], r["k2"]): r for r in merge.merge_frames(t, b, ["k1", "k2"], AS_OF).collect()}
    assert out[("a", 1)]["record_version"] is None      # NULL + 1 stays NULL
    assert out[("a", 2)]["record_version"] == 2


def test_duplicate_batch_key_rules(spark):
    t, b = frames(spark, [("a", 1)], [("a", 10), ("a", 11)])
    with pytest.raises(merge.MergeConflictError):
        merge.check_duplicate_matches(t, b, ["k"])
    t, b = frames(spark, [("a", 1)], [("z", 10), ("z", 11)])
    merge.check_duplicate_matches(t, b, ["k"])           # new key twice: both inserted
    counts = merge.key_counts(b, ["k"])
    hot = merge.heavy_keys(counts, batch_rows=2, max_keys=10, min_rows=1)
    out = merge.merge_frames(t, b, "k", AS_OF, insert_only_keys=hot, with_action=True)
    assert sorted(r["_action"] for r in out.collect()) == ["insert", "insert", "keep"]


def test_heavy_keys_bound(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("k"))
    hot = merge.heavy_keys(merge.key_counts(df, ["k"]), batch_rows=1000, max_keys=5, min_rows=100)
    assert hot.count() == 3     # each key has ~333 rows > max(100, 1000/5)
    assert merge.heavy_keys(merge.key_counts(df, ["k"]), 1000, max_keys=2, min_rows=400).count() == 0


def test_bucketed_merge_rewrites_only_touched_buckets(spark, tmp_dir):
    t, _ = frames(spark, [(f"k{i}", i) for i in range(200)], [])
    target = TableRef(path=tmp_dir)
    merge.merge_into(spark, t, target, ["k"], buckets=16)
    local = tmp_dir.removeprefix("file:")
    before = {d: os.path.getmtime(os.path.join(local, d)) for d in os.listdir(local) if d.startswith("_bucket=")}
    _, b = frames(spark, [], [("k7", 700), ("new", 1)])
    counters = merge.merge_into(spark, b, target, ["k"], AS_OF, buckets=16)
    assert counters == {"records_inserted": 1, "records_updated": 1, "records_merged": 2}
    touched = {r[0] for r in b.select(merge.bucket_expr(["k"], 16, b.columns)).collect()}
    after = {d: os.path.getmtime(os.path.join(local, d)) for d in os.listdir(local) if d.startswith("_bucket=")}
    changed = {int(d.split("=")[1]) for d in after if before.get(d) != after[d]}
    assert changed == touched
    data = spark.read.parquet(tmp_dir)
    assert data.count() == 201
    assert data.filter("k = 'k7'").select("v", "record_version").collect()[0].asDict() == {"v": 700, "record_version": 2}


def test_dedupe_latest_keeps_one_row_per_key(spark, tmp_dir):
    b = spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("b", 3, 1), (None, 4, 1), (None, 5, 1)],
                              "k string, v long, ts long")
    got = sorted(((r["k"], r["v"]) for r in merge.dedupe_latest(b, ["k"], "ts").collect()), key=str)
    assert got == sorted([("a", 2), ("b", 3), (None, 4), (None, 5)], key=str)
    t, _ = frames(spark, [("a", 1)], [])
    target = TableRef(path=tmp_dir)
    merge.merge_into(spark, t.withColumn("ts", F.lit(0).cast("long")), target, ["k"], buckets=4)
    batch = with_metadata(b, 2, "2026-08-09", "crm", AS_OF)
    counters = merge.merge_into(spark, batch, target, ["k"], AS_OF, buckets=4, dedupe_by="ts")
    assert counters == {"records_inserted": 3, "records_updated": 1, "records_merged": 4}


def test_merge_into_bucket_not_yet_present(spark, tmp_dir):
    t, _ = frames(spark, [("a", 1)], [])
    target = TableRef(path=tmp_dir)
    merge.merge_into(spark, t, target, ["k"], buckets=64)
    present = {r[0] for r in t.select(merge.bucket_expr(["k"], 64, t.columns)).collect()}
    cand = spark.createDataFrame([(f"n{i}", i) for i in range(200)], SCHEMA)
    cand = cand.withColumn("_b", merge.bucket_expr(["k"], 64, ["k", "v"]))
    new_key = cand.filter(~F.col("_b").isin(list(present))).first()["k"]
    _, b = frames(spark, [], [(new_key, 5)])
    counters = merge.merge_into(spark, b, target, ["k"], AS_OF, buckets=64)
    assert counters["records_inserted"] == 1
    assert spark.read.parquet(tmp_dir).count() == 2


def test_bucketed_merge_into_catalog_table(spark):
    from batchgate.session import scratch_database
    db = scratch_database(spark)
    name = f"{db}.bronze_k"
    t, b = frames(spark, [("a", 1), ("b", 2), ("c", 3)], [("a", 10), ("d", 40)])
    merge.merge_into(spark, t, name, ["k"], buckets=8)
    counters = merge.merge_into(spark, b, name, ["k"], AS_OF, buckets=8)
    assert counters == {"records_inserted": 1, "records_updated": 1, "records_merged": 2}
    got = {r["k"]: (r["v"], r["record_version"]) for r in spark.table(name).collect()}
    assert got == {"a": (10, 2), "b": (2, 1), "c": (3, 1), "d": (40, 1)}


def test_bucketed_layout_merge_does_not_shuffle_the_target(spark):
    import contextlib
    import io

    from batchgate.session import scratch_database
    name = f"{scratch_database(spark)}.bronze_orders"
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    t = with_metadata(orders, 1, "2026-08-07", "crm")
    merge.merge_into(spark, t, name, ["o_orderkey"], buckets=8)
    assert merge.BUCKET in spark.table(name).columns
    b = with_metadata(orders.withColumn("o_totalprice", F.col("o_totalprice") + 1), 2, "2026-08-08", "crm")
    staged = b.withColumn(merge.BUCKET, merge.bucket_expr(["o_orderkey"], 8, b.columns, "bucketed"))
    current = spark.table(name).filter(F.col(merge.BUCKET).isin(list(range(8))))
    plan = io.StringIO()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with contextlib.redirect_stdout(plan):
            merge.merge_frames(current, staged, "o_orderkey", strategy="shuffle", colocated=True).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    text = plan.getvalue()
    assert "Bucketed: true" in text and "LeftOuter" in text and "LeftAnti" in text
    assert text.count("Exchange hashpartitioning") == 2          # the batch side of either join only
    counters = merge.merge_into(spark, b, name, ["o_orderkey"], AS_OF, buckets=8, max_broadcast_bytes=0)
    assert counters["records_updated"] == orders.count() and counters["records_inserted"] == 0
    got = spark.table(name)
    assert got.count() == orders.count() and got.agg(F.min("record_version")).first()[0] == 2
    with pytest.raises(ValueError, match="layout=bucketed buckets=8"):
        merge.merge_into(spark, b, name, ["o_orderkey"], AS_OF, buckets=16)


def test_target_without_bucket_layout(spark, tmp_dir):
    from batchgate import schemas as S
    made = S.create_tables(spark, database_prefix="bgadopt_", tables=["bronze.crm_accounts"])[0]
    batch = with_metadata(spark.createDataFrame([("A1", "Acme")], "account_id string, account_name string"),
                          1, "2026-08-08", "crm")
    batch = batch.select(*[F.col(c) if c in batch.columns else F.lit(None).cast(t).alias(c)
                           for c, t in spark.table(made).dtypes])
    counters = merge.merge_into(spark, batch, made, ["account_id"], buckets=4)   # empty DDL table adopted
    assert counters["records_inserted"] == 1 and merge.BUCKET in spark.table(made).columns
    plain = TableRef(path=tmp_dir)
    spark.createDataFrame([("a", 1)], SCHEMA).write.parquet(tmp_dir)
    with pytest.raises(ValueError, match="no _bucket column"):
        merge.merge_into(spark, spark.createDataFrame([("a", 2)], SCHEMA), plain, ["k"], buckets=4)


def test_path_table_bucket_count_is_checked(spark, tmp_dir):
    t, b = frames(spark, [("a", 1)], [("a", 2)])
    merge.merge_into(spark, t, TableRef(path=tmp_dir), ["k"], buckets=4)
    assert spark.read.parquet(tmp_dir).columns[-1] == merge.BUCKET        # marker folder not read as data
    with pytest.raises(ValueError, match="buckets=4"):
        merge.merge_into(spark, b, TableRef(path=tmp_dir), ["k"], AS_OF, buckets=8)
    assert merge.merge_into(spark, b, TableRef(path=tmp_dir), ["k"], AS_OF, buckets=4)["records_updated"] == 1


def test_null_key_buckets_ignore_the_run_clock(spark, tmp_dir):
    """With ingested_at = current time, NULL-key rows must land in buckets the
    merge read; otherwise the dynamic overwrite would drop a bucket's rows."""
    target = TableRef(path=tmp_dir)
    base = with_metadata(spark.range(400).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")),
                         1, "2026-08-08", "crm")                       # as_of None: current_timestamp()
    merge.merge_into(spark, base, target, ["k"], buckets=8)
    nulls = with_metadata(spark.range(40).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("v")),
                          2, "2026-08-09", "crm")
    merge.merge_into(spark, nulls, target, ["k"], buckets=8)
    out = spark.read.parquet(tmp_dir)
    assert out.count() == 440 and out.filter("k IS NOT NULL").count() == 400


def _keyed(spark, n, kind, *extra):
    return spark.range(n).selectExpr(f"cast(id AS {kind}) AS k", "id * 10 AS v", *extra, "1L AS record_version",
                                     "cast(NULL AS timestamp) AS updated_at")


@pytest.mark.parametrize("named", [False, True])
def test_batch_keys_take_the_stored_type(spark, tmp_dir, named):
    from batchgate.session import scratch_database
    target = TableRef(name=f"{scratch_database(spark)}.t") if named else TableRef(path=tmp_dir)
    merge.merge_into(spark, _keyed(spark, 20, "bigint"), target, ["k"], buckets=8)
    got = merge.merge_into(spark, _keyed(spark, 20, "int"), target, ["k"], buckets=8)
    assert (got["records_inserted"], got["records_updated"]) == (0, 20)
    assert target.read(spark).count() == 20 and dict(target.read(spark).dtypes)["k"] == "bigint"
    with pytest.raises(ValueError, match="keep their values"):
        merge.merge_into(spark, _keyed(spark, 20, "string"), target, ["k"], buckets=8)
    with pytest.raises(ValueError, match="keys="):
        merge.merge_into(spark, _keyed(spark, 20, "bigint"), target, ["k", "v"], buckets=8)


def test_unknown_batch_columns_are_refused(spark, tmp_dir):
    target = TableRef(path=tmp_dir)
    merge.merge_into(spark, _keyed(spark, 5, "bigint"), target, ["k"], buckets=4)
    more = _keyed(spark, 5, "bigint", "'x' AS extra")
    with pytest.raises(ValueError, match="extra"):
        merge.merge_into(spark, more, target, ["k"], buckets=4)
    base = target.read(spark).drop(merge.BUCKET)
    with pytest.raises(ValueError, match="extra"):
        merge.merge_frames(base, more, "k")
    added = merge.merge_frames(base, more.limit(2), "k", add_columns=True)
    assert added.columns[-1] == "extra" and added.where("extra = 'x'").count() == 2 and added.count() == 5


def test_path_append_refuses_another_schema(spark, tmp_dir):
    from batchgate.plans.sinks import append_table
    append_table(spark.range(3).selectExpr("id", "id AS a"), TableRef(path=tmp_dir))
    append_table(spark.range(3).selectExpr("id", "id AS a"), TableRef(path=tmp_dir))
    with pytest.raises(ValueError, match="'b'"):
        append_table(spark.range(3).selectExpr("id", "id AS a", "id AS b"), TableRef(path=tmp_dir))
    assert spark.read.parquet(tmp_dir).count() == 6


def test_branches_alone(spark):
    t = spark.createDataFrame([(1, 10, 1), (2, 20, 1), (None, 30, 1)], "k int, v int, record_version int")
    b = spark.createDataFrame([(2, 21, 1), (3, 31, 1), (None, 41, 1)], "k int, v int, record_version int")
    assert sorted(tuple(r) for r in merge.matched_rows(t, b, "k").collect()) == [(2, 21, 2)]
    assert sorted(merge.inserted_rows(t, b, "k").select("v").toPandas().v) == [31, 41]
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (merge.matched_rows(t, b, "k"), merge.inserted_rows(t, b, "k"))]
    assert all("FullOuter" not in p for p in plans)


def test_key_counts_are_taken_once_and_shared(spark):
    from batchgate.operators import audit, quality
    from batchgate.operators.key_counts import KeyCounts
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1), (None, 1), (None, 2), ("c", 5), ("c", 6)], "k string, v long")
    counts = KeyCounts(df)
    c = counts.of(["k"])
    assert (c.rows, c.null_rows, c.repeated_rows, c.excess, c.top) == (8, 2, 5, 3, 3)
    assert sorted(tuple(r) for r in c.repeated.collect()) == [("a", 3), ("c", 2)]
    rules = [{"name": "unique_key", "columns": ["k"]}, {"name": "row_count", "min": 1}]
    assert quality.evaluate(df, rules, counts).collect() == quality.evaluate(df, rules).collect()
    by = lambda rows: sorted(map(tuple, rows), key=repr)
    assert by(audit.failure_audit(df, rules, ["v"], counts).collect()) == by(audit.failure_audit(df, rules, ["v"]).collect())
    split = [by(x.collect()) for x in audit.split_valid_invalid(df, rules, counts=counts)]
    assert split == [by(x.collect()) for x in audit.split_valid_invalid(df, rules)]
    assert counts.passes == 1
    counts.of(["k", "v"])
    assert counts.passes == 2
    empty = KeyCounts(df.limit(0)).of(["k"])
    assert (empty.rows, empty.top, empty.repeated.count()) == (0, 0, 0)


def test_the_session_keeps_its_overwrite_mode(spark, monkeypatch):
    """Bucket rewrites of a catalog table take the mode from the table, so a concurrent statement sees no change."""
    from batchgate.session import scratch_database
    name = f"{scratch_database(spark)}.t"
    rows = with_metadata(spark.range(100).selectExpr("id AS k", "id AS v"), 1, "2026-08-07", "crm")
    merge.merge_into(spark, rows, name, ["k"], buckets=4)
    touched = []
    monkeypatch.setattr(type(spark.conf), "set", lambda self, k, v: touched.append(k))
    counters = merge.merge_into(spark, rows.where("k < 3").withColumn("v", F.lit(7).cast("long")), name, ["k"], buckets=4)
    monkeypatch.undo()
    assert counters["records_updated"] == 3 and not [k for k in touched if "partitionOverwriteMode" in k]
    assert spark.table(name).count() == 100 and spark.table(name).where("v = 7").count() == 4


def test_dedupe_runs_once_and_lands(spark, tmp_dir):
    target = TableRef(path=tmp_dir)
    base = with_metadata(spark.range(50).selectExpr("id AS k", "id AS v"), 1, "2026-08-07", "crm")
    merge.merge_into(spark, base, target, ["k"], buckets=4)
    batch = with_metadata(spark.range(60).selectExpr("id % 20 + 40 AS k", "id AS v").union(spark.sql("SELECT NULL, 3L")), 2, "2026-08-08", "crm")
    calls = []
    real = merge.dedupe_latest
    merge.dedupe_latest = lambda *a: calls.append(1) or real(*a)
    try:
        counters = merge.merge_into(spark, batch, target, ["k"], "2026-08-09 06:00:00", buckets=4, dedupe_by="v")
    finally:
        merge.dedupe_latest = real
    assert len(calls) == 1 and (counters["records_updated"], counters["records_inserted"]) == (10, 11)
    rows = {r["k"]: r["v"] for r in spark.read.parquet(tmp_dir).collect()}
    assert len(rows) == 61 and all(rows[k] == 40 + k - 40 for k in range(40, 60)) and rows[None] == 3


def test_a_bucket_grown_too_large_is_merged_in_splits(spark):
    """A hot inserted key: its bucket is recorded, read in splits and joined by a shuffle; results as in the folders layout."""
    from batchgate.session import scratch_database
    db = scratch_database(spark)
    hot = spark.range(4000).select(F.when(F.col("id") % 2 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    first = with_metadata(spark.range(50).selectExpr("cast(id as string) as k", "id as v"), 1, "2026-08-07", "crm", "2026-08-07 06:00:00")
    grown = with_metadata(hot.repartition(6), 2, "2026-08-08", "crm", "2026-08-08 06:00:00")
    update = with_metadata(spark.sql("SELECT 'HOT' AS k, -1L AS v UNION ALL SELECT '7', -7L UNION ALL SELECT 'new', -9L"), 3, "2026-08-09", "crm",
                           "2026-08-09 06:00:00")
    out = {}
    for name, split in (("split", 1000), ("whole", 10 ** 9)):
        table, steps = f"{db}.{name}", []
        for batch in (first, grown, update):
            steps.append(merge.merge_into(spark, batch, table, ["k"], "2026-08-09 06:00:00", buckets=4, max_broadcast_bytes=0, split_rows=split))
        out[name] = (steps, sorted(map(tuple, spark.table(table).drop(merge.BUCKET).collect()), key=repr))
    assert out["split"] == out["whole"] and out["split"][0][2]["records_updated"] == 2001
    assert merge.split_buckets(spark, TableRef.of(f"{db}.whole")) == []
    large = merge.split_buckets(spark, TableRef.of(f"{db}.split"))
    assert len(large) == 1
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        bucketed = spark.table(f"{db}.split").where(F.col(merge.BUCKET).isin(large)).groupBy("k").count()
        assert "Bucketed: true" in bucketed._jdf.queryExecution().toString()                   # control: one task a bucket
        assert merge._split_scan(spark, TableRef.of(f"{db}.split"), large).rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    # A merge that writes few rows shows that the bucket has shrunk.
    merge._record_large_buckets(spark, TableRef.of(f"{db}.split"), large, 10, 1000)
    assert merge.split_buckets(spark, TableRef.of(f"{db}.split")) == []
