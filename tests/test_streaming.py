"""File drops picked up by Structured Streaming run the same load."""

import pytest
from pyspark.sql import types as T

from batchgate.streaming import stream_loads


def test_stream_loads_new_drops(spark, tmp_dir):
    base = f"{tmp_dir}/drops"
    for day, rows in (("08-08-2026", ["a,1", "b,2"]), ("09-08-2026", ["a,10", "c,3"])):
        spark.createDataFrame([(l,) for l in ["k,v"] + rows], "value string").coalesce(1) \
             .write.text(f"{base}/tmp_{day}")
    # rename the single part file of each folder into the dated name
    import glob
    import os
    import shutil
    local = base.removeprefix("file:")
    for folder in glob.glob(f"{local}/tmp_*"):
        part = glob.glob(f"{folder}/part-*")[0]
        shutil.move(part, f"{local}/drop_{folder.rsplit('_', 1)[1]}.csv")
    cfg = {"job": {"name": "s"}, "source": {"type": "file", "format": "csv", "header": True, "path": base,
                                             "file_format": "drop_{dd}-{MM}-{yyyy}.csv"},
           "target": {"master": {"path": f"{tmp_dir}/bronze"}, "write": {"mode": "merge", "keys": "k",
                                                                          "buckets": 4}},
           "validation": {"non_nullable": {"columns": ["k"]}}}
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    control = f"{tmp_dir}/control"
    q = stream_loads(spark, cfg, schema, "crm", checkpoint=f"{tmp_dir}/ckpt", control={"path": control})
    q.awaitTermination(120)
    out = spark.read.parquet(f"{tmp_dir}/bronze")
    assert out.count() == 3
    days = {r["k"]: str(r["buisness_date"])[:10] for r in out.collect()}
    assert days["b"] == "2026-08-08" and days["c"] == "2026-08-09"
    versions = {r["k"]: r["record_version"] for r in out.collect()}
    # the same micro-batch again (its commit was lost): the control table has its runs, nothing changes
    ckpt = f"{tmp_dir}/ckpt".removeprefix("file:")
    for name in ("0", ".0.crc"):
        if os.path.exists(f"{ckpt}/commits/{name}"):
            os.remove(f"{ckpt}/commits/{name}")
    q = stream_loads(spark, cfg, schema, "crm", checkpoint=f"{tmp_dir}/ckpt", control={"path": control})
    q.awaitTermination(120)
    again = spark.read.parquet(f"{tmp_dir}/bronze")
    assert {r["k"]: r["record_version"] for r in again.collect()} == versions
    # a corrected drop under a new checkpoint is another load, not "already loaded"
    with open(f"{local}/drop_08-08-2026.csv", "w") as out_file:
        out_file.write("k,v\na,100\nb,200\nd,4\n")
    q = stream_loads(spark, cfg, schema, "crm", checkpoint=f"{tmp_dir}/ckpt2", control={"path": control})
    q.awaitTermination(120)
    final = {r["k"]: r["v"] for r in spark.read.parquet(f"{tmp_dir}/bronze").collect()}
    assert final["b"] == 200 and final["d"] == 4 and len(final) == 4


def test_stream_checks_the_header_and_records_failures(spark, tmp_dir):
    import os
    base = f"{tmp_dir}/drops".removeprefix("file:")
    os.makedirs(base)
    with open(f"{base}/drop_08-08-2026.csv", "w") as f:
        f.write("v,k\n1,Ann\n")
    cfg = {"job": {"name": "s"}, "source": {"type": "file", "format": "csv", "header": True, "path": base,
                                             "file_format": "drop_{dd}-{MM}-{yyyy}.csv"},
           "target": {"master": {"path": f"{tmp_dir}/bronze"}, "write": {"mode": "merge", "keys": "k", "buckets": 4}}}
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    q = stream_loads(spark, cfg, schema, "crm", checkpoint=f"{tmp_dir}/c", control={"path": f"{tmp_dir}/control"})
    with pytest.raises(Exception):
        q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_dir}/control").where("run_status = 'FAILED'").count() == 1
    cfg["source"]["binding"] = "name"
    q = stream_loads(spark, cfg, schema, "crm", checkpoint=f"{tmp_dir}/c2", control={"path": f"{tmp_dir}/control"})
    q.awaitTermination(120)
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_dir}/bronze").select("k", "v").collect()] == [("Ann", 1)]
