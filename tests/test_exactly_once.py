"""Loads that die after (or during) their write and are run again; quarantine loads."""

import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchgate.functions.columns import with_metadata
from batchgate.operators import merge
from batchgate.operators.quality import ValidationError
from batchgate.plans import job, runs, sinks
from batchgate.session import TableRef, scratch_database
from batchgate.streaming.drops import stream_loads

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
DAY1 = [("a", 1), ("b", 2), ("c", 3), ("d", 4), ("n", 5), (None, 6)]
DAY2 = [("b", 20), ("c", 30), ("x", 7), ("y", 8), ("y", 9), (None, 10), (None, 10), ("d", 40)]     # y: a new key twice


class Killed(BaseException):
    """Not an Exception: the job's own error handling must not see it, as if the driver had died."""


def drops(spark, base, rows=DAY2):
    for day, content in (("08-08-2026", DAY1), ("09-08-2026", rows)):
        spark.createDataFrame(content, "k string, v long").coalesce(1).write.option("header", True).csv(f"{base}/d_{day}.csv")


def config(base, root, mode, master=None):
    return {"job": {"name": "j", "mode": "load"},
            "source": {"name": "crm", "path": base, "file_format": "d_{dd}-{MM}-{yyyy}.csv"},
            "target": {"raw": {"path": f"{root}/raw"}, "master": master or {"path": f"{root}/master"},
                       "write": {"mode": mode, "keys": "k", "buckets": 4}},
            "validation": {"rules": [{"name": "row_count", "min": 1}]}}


def load(spark, cfg, day, batch, control, as_of="2026-08-10 06:00:00", **kw):
    return job.run_job(spark, cfg, {"business_date": day, "batch_id": batch, "source_name": "crm"}, schema=SCHEMA, as_of=as_of,
                       control=control, skip_if_loaded=True, **kw)


def content(spark, cfg, *drop):
    rows = TableRef.of(cfg["target"]["master"]).read(spark).drop(merge.BUCKET, *drop)
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def kill_at_the_end(monkeypatch):
    real = job.record_event

    def record(spark, control, event):
        if event["run_status"] == runs.SUCCEEDED:
            raise Killed
        real(spark, control, event)

    monkeypatch.setattr(job, "record_event", record)


COUNTERS = ("records_read", "records_valid", "records_invalid", "records_inserted", "records_updated", "records_merged")


@pytest.mark.parametrize("mode", ["merge", "merge-table", "append"])
def test_a_run_that_dies_after_its_write_is_repeated_without_effect(spark, tmp_dir, monkeypatch, mode):
    base = f"{tmp_dir}/landing"
    drops(spark, base)
    got = {}
    for name in ("once", "twice"):
        master = {"schema": scratch_database(spark), "table": "master"} if mode == "merge-table" else None
        cfg = config(base, f"{tmp_dir}/{name}", mode.split("-")[0], master)
        control = TableRef(path=f"{tmp_dir}/{name}/control")
        load(spark, cfg, "2026-08-08", 1, control)
        if name == "twice":
            with monkeypatch.context() as m:
                kill_at_the_end(m)
                with pytest.raises(Killed):
                    load(spark, cfg, "2026-08-09", 2, control)
        out = load(spark, cfg, "2026-08-09", 2, control)
        got[name] = (content(spark, cfg), {c: out[c] for c in COUNTERS})
        last = [r for r in runs.latest_runs(spark.read.parquet(control.path)).collect() if r["run_status"] == "SUCCEEDED" and r["batch_id"] == 2]
        assert [r["retry_count"] for r in last] == [1 if name == "twice" else 0]
    assert got["once"] == got["twice"]
    if mode.startswith("merge"):
        versions = {r[0]: r[-3] for r in got["twice"][0] if r[0] in ("b", "c", "d", "x")}
        assert versions == {"b": 2, "c": 2, "d": 2, "x": 1}


def test_without_the_control_a_second_run_counts_again(spark, tmp_dir):
    """The control of the test above: a plain rerun bumps versions, as a merge of a new batch must."""
    base = f"{tmp_dir}/landing"
    drops(spark, base, [("b", 20)])
    cfg = config(base, tmp_dir, "merge")
    for day, batch in (("2026-08-08", 1), ("2026-08-09", 2), ("2026-08-09", 2)):
        job.run_job(spark, cfg, {"business_date": day, "batch_id": batch, "source_name": "crm"}, schema=SCHEMA)
    assert spark.read.parquet(f"{tmp_dir}/master").where("k = 'b'").first()["record_version"] == 3


def test_a_write_that_reached_some_buckets_only(spark, tmp_dir, monkeypatch):
    base = f"{tmp_dir}/landing"
    drops(spark, base)
    whole, half = (config(base, f"{tmp_dir}/{n}", "merge") for n in ("whole", "half"))
    for cfg in (whole, half):
        load(spark, cfg, "2026-08-08", 1, TableRef(path=f"{cfg['target']['raw']['path']}-control"))
    load(spark, whole, "2026-08-09", 2, TableRef(path=f"{whole['target']['raw']['path']}-control"))
    local = half["target"]["master"]["path"].removeprefix("file:")
    shutil.copytree(local, local + "-before")
    control = TableRef(path=f"{half['target']['raw']['path']}-control")
    with monkeypatch.context() as m:
        kill_at_the_end(m)
        with pytest.raises(Killed):
            load(spark, half, "2026-08-09", 2, control)
    spark.catalog.clearCache()
    back = [b for b in sorted(os.listdir(local)) if b.startswith("_bucket=")][::2]       # every other bucket as it was
    for bucket in back:
        shutil.rmtree(f"{local}/{bucket}")
        if os.path.exists(f"{local}-before/{bucket}"):
            shutil.copytree(f"{local}-before/{bucket}", f"{local}/{bucket}")
    out = load(spark, half, "2026-08-09", 2, control)
    assert content(spark, half) == content(spark, whole)
    assert (out["records_inserted"], out["records_updated"]) == (5, 3)


def test_a_hot_new_key_is_not_inserted_again(spark, tmp_dir):
    target = TableRef(path=tmp_dir)
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    merge.merge_into(spark, with_metadata(spark.range(10).selectExpr("cast(id as string) as k", "id as v"), 1, "2026-08-08", "crm"), target, ["k"], buckets=4)
    batch = with_metadata(rows, 2, "2026-08-09", "crm", "2026-08-09 06:00:00")
    done = merge.own_rows(2, "2026-08-09", "crm")
    args = dict(buckets=4, hot_key_rows=100, max_broadcast_bytes=0, done=done)
    first = merge.merge_into(spark, batch, target, ["k"], "2026-08-09 06:00:00", **args)
    before = sorted(map(tuple, spark.read.parquet(tmp_dir).collect()))
    assert merge.merge_into(spark, batch, target, ["k"], "2026-08-09 06:00:00", **args) == first
    assert sorted(map(tuple, spark.read.parquet(tmp_dir).collect())) == before and len(before) == 3004
    other = with_metadata(rows.where("k = 'HOT'"), 3, "2026-08-10", "crm")
    with pytest.raises(merge.MergeConflictError):                       # rows of another load are no fence
        merge.merge_into(spark, other, target, ["k"], buckets=4, done=merge.own_rows(3, "2026-08-10", "crm"))


@pytest.mark.parametrize("share", [0, 1, 3])
def test_append_once_adds_what_is_missing(spark, tmp_dir, share):
    batch = with_metadata(spark.createDataFrame([(i % 7, None if i % 5 else "x") for i in range(30)], "k long, s string"), 2, "2026-08-09", "crm",
                          "2026-08-09 06:00:00")
    other = with_metadata(spark.createDataFrame([(1, "x")], "k long, s string"), 1, "2026-08-09", "crm", "2026-08-09 06:00:00")
    sinks.append_table(other, TableRef(path=tmp_dir))
    if share:
        sinks.append_table(batch.limit(10 * share).withColumn("ingested_at", F.lit("2026-08-09 01:00:00").cast("timestamp")), TableRef(path=tmp_dir))
    sinks.append_once(batch, TableRef(path=tmp_dir), merge.own_rows(2, "2026-08-09", "crm"), 30, "2026-08-09 06:00:00")
    drop = ["ingested_at"]
    want = sorted(map(tuple, batch.drop(*drop).union(other.drop(*drop)).collect()), key=repr)
    assert sorted(map(tuple, spark.read.parquet(tmp_dir).drop(*drop).collect()), key=repr) == want


def test_a_stream_replayed_after_its_write(spark, tmp_dir, monkeypatch):
    base = f"{tmp_dir}/landing"
    os.makedirs(base.removeprefix("file:"))
    for day, rows in (("08-08-2026", DAY1), ("09-08-2026", DAY2)):
        with open(f"{base.removeprefix('file:')}/d_{day}.csv", "w") as f:
            f.write("k,v\n" + "".join(f"{k or ''},{v}\n" for k, v in rows))
    cfg, control = config(base, tmp_dir, "merge"), TableRef(path=f"{tmp_dir}/control")
    real = job.record_event

    def record(spark, table, event):
        if event["run_status"] == runs.SUCCEEDED and "2026-08-09" in str(event["business_date"]):
            raise OSError("event lost")
        real(spark, table, event)

    def run():
        q = stream_loads(spark, cfg, SCHEMA, "crm", checkpoint=f"{tmp_dir}/cp", control=control, as_of="2026-08-10 06:00:00")
        q.awaitTermination()

    with monkeypatch.context() as m:
        m.setattr(job, "record_event", record)
        with pytest.raises(Exception, match="event lost"):
            run()
    run()
    versions = {r["k"]: r["record_version"] for r in spark.read.parquet(f"{tmp_dir}/master").where("k IS NOT NULL").collect()}
    assert versions == {"a": 1, "b": 2, "c": 2, "d": 2, "n": 1, "x": 1, "y": 1}
    assert spark.read.parquet(f"{tmp_dir}/master").count() == len(DAY1) + 5


# ---------------------------------------------------------------------------------------------- quarantine

RULES = {"rules": [{"name": "non_nullable", "columns": ["k"]}, {"name": "range", "column": "v", "max": 35},
                   {"name": "range", "column": "v", "max": 1, "severity": "WARN"}, {"name": "unique_key", "columns": ["k"]},
                   {"name": "row_count", "min": 3}]}


def test_quarantine_splits_and_counts(spark, tmp_dir):
    base = f"{tmp_dir}/landing"
    drops(spark, base, DAY2 + [("y", 99)])
    cfg = dict(config(base, tmp_dir, "merge"), validation=RULES)
    control, aside = TableRef(path=f"{tmp_dir}/control"), TableRef(path=f"{tmp_dir}/quarantine")
    first = load(spark, cfg, "2026-08-08", 1, control, quarantine=aside)
    second = load(spark, cfg, "2026-08-09", 2, control, quarantine=aside, audit={"path": f"{tmp_dir}/audit"})
    assert [first[c] for c in COUNTERS] == [6, 5, 1, 5, 0, 5]
    assert [second[c] for c in COUNTERS] == [9, 3, 6, 1, 2, 3]
    rows = sorted((r["k"] or "", r["v"], r["batch_id"], sorted(r["failed_rules"])) for r in spark.read.parquet(aside.path).collect())
    assert rows == [("", 6, 1, ["non_nullable", "unique_key"]), ("", 10, 2, ["non_nullable", "unique_key"]),
                    ("", 10, 2, ["non_nullable", "unique_key"]), ("d", 40, 2, ["range"]), ("y", 8, 2, ["unique_key"]),
                    ("y", 9, 2, ["unique_key"]), ("y", 99, 2, ["range", "unique_key"])]
    events = {r["batch_id"]: r for r in runs.latest_runs(spark.read.parquet(control.path)).collect()}
    assert [events[2][c] for c in COUNTERS] == [second[c] for c in COUNTERS]
    assert spark.read.parquet(f"{tmp_dir}/audit").where("validation_rule = 'range' AND validation_status = 'FAIL'").count() == 2


def test_a_batch_rule_still_rejects_the_whole_batch(spark, tmp_dir):
    base = f"{tmp_dir}/landing"
    drops(spark, base, [("z", 1)])
    cfg = dict(config(base, tmp_dir, "append"), validation=RULES)
    cfg["target"]["quarantine"] = {"path": f"{tmp_dir}/quarantine"}
    control = TableRef(path=f"{tmp_dir}/control")
    with pytest.raises(ValidationError, match="row_count"):
        load(spark, cfg, "2026-08-09", 2, control)
    event = runs.latest_runs(spark.read.parquet(control.path)).first()
    assert (event["run_status"], event["records_read"], event["records_valid"]) == ("FAILED", 1, None)
    missing = dict(cfg, validation={"rules": [{"name": "length", "column": "no_such", "max": 1}]})
    with pytest.raises(ValidationError, match="not found"):
        load(spark, missing, "2026-08-08", 3, control)


def test_a_clean_batch_and_one_without_valid_rows(spark, tmp_dir):
    base = f"{tmp_dir}/landing"
    drops(spark, base, [(None, 1), (None, 2), (None, 3)])
    cfg = dict(config(base, tmp_dir, "merge"), validation={"non_nullable": {"columns": ["k"]}})
    control, aside = TableRef(path=f"{tmp_dir}/control"), TableRef(path=f"{tmp_dir}/quarantine")
    out = load(spark, cfg, "2026-08-09", 2, control, quarantine=aside)
    assert [out[c] for c in COUNTERS] == [3, 0, 3, 0, 0, 0] and spark.read.parquet(aside.path).count() == 3
    clean = dict(cfg, validation={"rules": [{"name": "row_count", "min": 1}]})
    out = load(spark, clean, "2026-08-08", 1, control, quarantine=aside)
    assert out["records_invalid"] == 0 and out["records_valid"] == 6 and spark.read.parquet(aside.path).count() == 3


def test_quarantine_rows_are_not_repeated_by_a_rerun(spark, tmp_dir, monkeypatch):
    base = f"{tmp_dir}/landing"
    drops(spark, base)
    cfg = dict(config(base, tmp_dir, "append"), validation=RULES)
    control, aside = TableRef(path=f"{tmp_dir}/control"), TableRef(path=f"{tmp_dir}/quarantine")
    with monkeypatch.context() as m:
        kill_at_the_end(m)
        with pytest.raises(Killed):
            load(spark, cfg, "2026-08-09", 2, control, quarantine=aside)
    out = load(spark, cfg, "2026-08-09", 2, control, quarantine=aside)
    assert spark.read.parquet(aside.path).count() == out["records_invalid"] == 5
    assert spark.read.parquet(f"{tmp_dir}/master").count() == out["records_valid"] == 3


def test_one_key_count_pass_serves_the_run(spark, tmp_dir, monkeypatch):
    """Unique-key rule, audit, duplicate check and hot-key routing of one load group the batch once."""
    from batchgate.operators.key_counts import KeyCounts
    base, made = f"{tmp_dir}/landing", []
    drops(spark, base, [("y", 1), ("y", 2), ("q", 3)])
    real = KeyCounts.__init__
    monkeypatch.setattr(KeyCounts, "__init__", lambda self, df: made.append(self) or real(self, df))
    cfg = dict(config(base, tmp_dir, "merge"), validation={"rules": [{"name": "unique_key", "columns": ["k"], "severity": "WARN"}]})
    control = TableRef(path=f"{tmp_dir}/control")
    load(spark, cfg, "2026-08-08", 1, control)
    made.clear()
    load(spark, cfg, "2026-08-09", 2, control, audit={"path": f"{tmp_dir}/audit"})
    assert sum(c.passes for c in made) == 1 and spark.read.parquet(f"{tmp_dir}/audit").count() == 2
