"""One key holding a third of all rows: results stay whole and exact."""

import contextlib
import io

from pyspark.sql import functions as F

from batchgate.functions.columns import with_metadata
from batchgate.operators import audit, merge, quality
from batchgate.session import TableRef

N = 30000


def hot_frame(spark, hot_share=3):
    # every third row has key 'HOT'; the rest are unique
    return spark.range(N).select(
        F.when(F.col("id") % hot_share == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"))


def test_unique_key_with_hot_key(spark):
    df = hot_frame(spark)
    r = quality.collect_results(quality.evaluate(df, [{"name": "unique_key", "columns": ["k"]}]))[0]
    assert (r["records_checked"], r["records_failed"]) == (N, N // 3 - 1)


def test_audit_and_split_with_hot_key(spark):
    df = hot_frame(spark)
    rows = audit.failure_audit(df, [{"name": "unique_key", "columns": ["k"]}], ["k"])
    assert rows.count() == N // 3
    valid, invalid = audit.split_valid_invalid(df, [{"name": "unique_key", "columns": ["k"]}])
    assert (valid.count(), invalid.count()) == (N - N // 3, N // 3)


def test_merge_routes_hot_new_key_around_the_join(spark, tmp_dir):
    target = TableRef(path=tmp_dir)
    base = with_metadata(spark.range(1000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")),
                         1, "2026-08-08", "crm")
    merge.merge_into(spark, base, target, ["k"], buckets=8)
    batch = with_metadata(hot_frame(spark), 2, "2026-08-09", "crm")
    counters = merge.merge_into(spark, batch, target, ["k"], "2026-08-09 06:00:00", buckets=8,
                                max_broadcast_bytes=0, hot_key_rows=1000)   # shuffle plan, HOT routed
    # ids 1..999 not divisible by 3 are updates (666); the rest of the batch inserts
    assert counters["records_updated"] == 666
    assert counters["records_inserted"] == N - 666
    out = spark.read.parquet(tmp_dir)
    assert out.count() == 1000 + N - 666
    assert out.filter("k = 'HOT'").count() == N // 3


def test_hot_keys_take_the_broadcast_route(spark):
    t = with_metadata(spark.range(100).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")),
                      1, "2026-08-08", "crm")
    b = with_metadata(hot_frame(spark), 2, "2026-08-09", "crm")
    hot = merge.heavy_keys(merge.key_counts(b, ["k"]), N, min_rows=1000)
    assert [r["k"] for r in hot.collect()] == ["HOT"]
    m = merge.merge_frames(t, b, "k", insert_only_keys=hot)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        m.explain()
    assert "LeftSemi" in buf.getvalue() and "LeftAnti" in buf.getvalue()
    assert m.count() == 100 + N - 66      # 66 of the 100 target keys are updated


def test_empty_batch_merge_is_a_no_op(spark, tmp_dir):
    target = TableRef(path=tmp_dir)
    base = with_metadata(spark.range(10).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")),
                         1, "2026-08-08", "crm")
    merge.merge_into(spark, base, target, ["k"], buckets=4)
    counters = merge.merge_into(spark, base.limit(0), target, ["k"], buckets=4)
    assert counters["records_merged"] == 0 and spark.read.parquet(tmp_dir).count() == 10


def _splits(spark, df) -> bool:
    """Whether adaptive execution splits a skewed join partition when ``df`` runs."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df.write.format("noop").mode("overwrite").save()
        df = df.select("*")
        df.collect()
        return "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_keys_are_split_over_tasks(spark, tmp_dir):
    # Several map tasks, so that a skewed partition has map outputs to split at.
    hot_frame(spark).repartition(12).write.parquet(f"{tmp_dir}/hot")
    df = spark.read.option("maxPartitionBytes", "64k").parquet(f"{tmp_dir}/hot")
    keys = spark.range(N).select(F.col("id").cast("string").alias("k")).union(spark.sql("SELECT 'HOT' AS k"))
    assert _splits(spark, df.join(keys, "k"))                                     # control
    rule = [{"name": "unique_key", "columns": ["k"]}]
    assert _splits(spark, audit.failure_audit(df, rule, ["v"]))
    assert _splits(spark, audit.split_valid_invalid(df, rule)[0])
    target = with_metadata(df, 1, "2026-08-08", "crm", "2026-08-08 06:00:00")     # a hot key of the target
    batch = with_metadata(keys.withColumn("v", F.lit(0).cast("long")), 2, "2026-08-09", "crm", "2026-08-09 06:00:00")
    assert _splits(spark, merge.merge_frames(target, batch, "k", "2026-08-09 06:00:00"))


def _rows_in_largest_partition(df) -> int:
    return max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_the_insert_branch_alone_with_a_hot_target_key(spark, tmp_dir):
    """The anti join checked by itself: its right side cannot be split, so it must not hold a key twice."""
    hot_frame(spark).repartition(12).write.parquet(f"{tmp_dir}/hot")
    target = spark.read.option("maxPartitionBytes", "64k").parquet(f"{tmp_dir}/hot")
    batch = spark.range(N).select(F.col("id").cast("string").alias("k"), F.lit(0).cast("long").alias("v"))
    batch = batch.union(spark.sql("SELECT 'HOT' AS k, 1L AS v"))
    raw = target.select("k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _rows_in_largest_partition(raw.repartition("k")) > N // 3                                  # control: the raw right side
        reduced = merge.reduced_keys(target, batch, ["k"], N)
        assert _rows_in_largest_partition(reduced.repartition("k")) < N // 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert reduced.count() == reduced.distinct().count() == target.select("k").distinct().count()
    inserted = merge.inserted_rows(target, batch, "k")
    assert inserted.count() == N // 3 and inserted.where("k = 'HOT'").isEmpty()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        inserted.explain()
    plan = buf.getvalue()
    assert "getbit" in plan and "LeftAnti" in plan


def test_a_hot_batch_key_is_split_in_the_insert_branch(spark, tmp_dir):
    hot_frame(spark).repartition(12).write.parquet(f"{tmp_dir}/hot")
    batch = spark.read.option("maxPartitionBytes", "64k").parquet(f"{tmp_dir}/hot")
    target = spark.range(N).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    control = batch.join(target.select("k"), "k", "left_anti")
    assert _splits(spark, control) and _splits(spark, merge.inserted_rows(target, batch, "k"))


def test_keys_that_the_batch_lacks_are_dropped_before_the_shuffle(spark):
    target = spark.range(200_000).select(F.col("id").alias("k"))
    batch = spark.range(0, 200_000, 1000).select(F.col("id").alias("k"))
    kept = merge.reduced_keys(target, batch, ["k"], 200)
    assert kept.join(batch, "k").count() == 200 and kept.count() < 2000
    other_type = batch.select(F.col("k").cast("int").alias("k"))            # hashes differ: no filter, whole keys
    assert merge.reduced_keys(target, other_type, ["k"], 200).count() == 200_000
    zeros = spark.createDataFrame([(0.0,), (float("nan"),)], "k double"), spark.createDataFrame([(-0.0,), (float("nan"),)], "k double")
    assert merge.inserted_rows(zeros[0], zeros[1], ["k"]).count() == 0
