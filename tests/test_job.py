"""The bronze load job end to end, with run control events."""

import pytest
from pyspark.sql import functions as F

from batchgate import schemas as S
from batchgate.operators.quality import ValidationError
from batchgate.plans import job, runs
from batchgate.session import TableRef

CSV = ["customer_id,customer_name,email,phone,city,state,country,created_at,updated_at_raw",
       "C001,Mona Quill,mona@quill.test,5550101010,Brayford,BF,ZZ,2026/03/02 07:05:00,2026/03/03 06:20:00",
       "C002,Odo Fenn,odo@fenn.test,5550202020,Brayford,BF,ZZ,2026/03/02 11:40:00,2026/03/03 06:45:00"]


def write_text(spark, path, lines):
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(path)


def config(base, root, validation=None):
    return {
        "job": {"name": "customers", "type": "batch", "frequency": "daily", "mode": "load"},
        "source": {"name": "crm", "type": "file", "format": "csv", "header": True, "delimiter": ",",
                   "path": base, "date_format": "dd/MM/yyyy", "timestamp_format": "yyyy/MM/dd HH:mm:ss",
                   "file_format": "crm_customers_{dd}-{MM}-{yyyy}.csv"},
        "target": {"raw": {"path": f"{root}/raw", "format": "parquet", "table": "crm_customers"},
                   "master": {"path": f"{root}/bronze", "format": "parquet"},
                   "write": {"mode": "merge", "keys": "customer_id", "buckets": 4}},
        "validation": validation or {"non_nullable": {"columns": ["customer_id", "customer_name", "phone"]},
                                     "rules": {"phone": {"min_length": 9, "max_length": 10, "numeric_only": True}}},
    }


def test_success_then_gate_failure(spark, tmp_dir):
    base, root = f"{tmp_dir}/landing", f"{tmp_dir}/tables"
    write_text(spark, f"{base}/crm_customers_08-08-2026.csv", CSV)
    write_text(spark, f"{base}/crm_customers_09-08-2026.csv", CSV[:2] + [CSV[2].replace("5550202020", "55502x2020")])
    cfg = config(base, root)
    control = TableRef(path=f"{tmp_dir}/control")
    schema = S.entity_schema("crm_customers", with_metadata=False)
    out = job.run_job(spark, cfg, {"business_date": "2026-08-08", "batch_id": 1, "source_name": "crm"},
                      schema=schema, control=control, job_run_id=1)
    assert (out["run_status"], out["records_read"], out["records_inserted"]) == ("SUCCEEDED", 2, 2)
    with pytest.raises(ValidationError, match="numeric_only"):
        job.run_job(spark, cfg, {"business_date": "2026-08-09", "batch_id": 2, "source_name": "crm"},
                    schema=schema, control=control, job_run_id=2)
    latest = {r["job_run_id"]: r for r in runs.latest_runs(spark.read.parquet(control.path)).collect()}
    assert latest[1]["run_status"] == "SUCCEEDED" and latest[1]["records_valid"] == 2
    assert latest[2]["run_status"] == "FAILED" and latest[2]["records_read"] == 2
    assert latest[2]["records_valid"] is None and "numeric_only" in latest[2]["error_summary"]
    bronze = spark.read.parquet(f"{root}/bronze")
    assert bronze.count() == 2 and bronze.agg(F.max("record_version")).collect()[0][0] == 1
    raw = spark.read.parquet(f"{root}/raw")          # raw keeps the last published batch only
    assert raw.filter("batch_id = 1").count() == 2


def test_schema_from_registry_and_unknown_mode(spark, tmp_dir):
    cfg = config(f"{tmp_dir}/l", f"{tmp_dir}/t")
    spec = job.JobSpec.of(cfg)
    assert job.source_schema(spark, spec).fieldNames()[0] == "customer_id"
    cfg["target"]["write"]["mode"] = "upsert"
    with pytest.raises(ValueError, match="write mode"):
        job.JobSpec.of(cfg)


def test_error_text_is_stored_verbatim(spark, tmp_dir):
    control = TableRef(path=f"{tmp_dir}/control")
    run = runs.new_run("j", "2026-08-08", 1, "crm", "load", job_run_id=7)
    runs.record_event(spark, control, run)
    msg = "it's a \\path\\ with\nnewline"
    runs.record_event(spark, control, runs.finish(run, runs.FAILED, error_summary=msg))
    got = runs.latest_runs(spark.read.parquet(control.path)).collect()[0]
    assert got["error_summary"] == msg and got["run_status"] == "FAILED"


def test_latest_runs_with_a_hot_run(spark):
    ev = spark.range(30000).select(
        F.when(F.col("id") < 10000, F.lit(0)).otherwise(F.col("id") % 50).alias("run"),
        F.col("id").alias("seq"))
    latest = runs.latest_runs(ev, run_id="run", order=("seq",))
    got = {r["run"]: r["seq"] for r in latest.collect()}
    assert got[0] == 29950 and len(got) == 50


def test_failing_batch_leaves_audit_rows(spark, tmp_dir):
    base, root = f"{tmp_dir}/landing", f"{tmp_dir}/tables"
    write_text(spark, f"{base}/crm_customers_09-08-2026.csv", CSV[:2] + [CSV[2].replace("Odo Fenn", "")])
    cfg = config(base, root)
    audit = TableRef(path=f"{tmp_dir}/audit")
    with pytest.raises(ValidationError):
        job.run_job(spark, cfg, {"business_date": "2026-08-09", "batch_id": 3, "source_name": "crm"},
                    schema=S.entity_schema("crm_customers", with_metadata=False), audit=audit, job_run_id=9)
    rows = spark.read.parquet(audit.path).collect()
    assert [(r["job_run_id"], r["record_key"], r["column_name"], r["validation_rule"]) for r in rows] == [
        (9, "C002", "customer_name", "non_nullable")]
    assert spark.read.parquet(audit.path).schema.fieldNames() == S.DQ_FAILURE_AUDIT.fieldNames()


def test_registry_and_table_provisioning(spark):
    reg = S.registry()
    assert len(reg) == 24 and reg["raw.crm_customers"] == reg["bronze.crm_customers"]
    assert reg["raw.crm_contacts"].fieldNames()[:2] == ["contact_id", "customer_id"]
    frame = S.registry_frame(spark)
    assert frame.filter("table_name = 'control.job_run_control'").count() == 19
    made = S.create_tables(spark, database_prefix="bgtest_", tables=["raw.crm_accounts", "control.dq_rules"])
    assert made == ["bgtest_raw.crm_accounts", "bgtest_control.dq_rules"]
    assert spark.table("bgtest_raw.crm_accounts").columns[-6:] == S.METADATA_COLUMNS


def test_skip_if_loaded(spark, tmp_dir):
    base, root = f"{tmp_dir}/landing", f"{tmp_dir}/tables"
    write_text(spark, f"{base}/crm_customers_08-08-2026.csv", CSV)
    cfg = config(base, root)
    control = TableRef(path=f"{tmp_dir}/control")
    schema = S.entity_schema("crm_customers", with_metadata=False)
    details = {"business_date": "2026-08-08", "batch_id": 1, "source_name": "crm"}
    assert job.run_job(spark, cfg, details, schema=schema, control=control)["run_status"] == "SUCCEEDED"
    again = job.run_job(spark, cfg, details, schema=schema, control=control, skip_if_loaded=True)
    assert again["run_status"] == "SKIPPED"
    assert spark.read.parquet(f"{root}/bronze").agg(F.max("record_version")).collect()[0][0] == 1


def test_run_events_in_a_catalog_table(spark):
    from batchgate.session import scratch_database
    name = f"{scratch_database(spark)}.job_run_control"
    run = runs.new_run("accounts", "2026-08-08", 4, "crm", "load", job_run_id=11)
    runs.record_event(spark, name, run)
    runs.record_event(spark, name, runs.finish(run, runs.SUCCEEDED, records_read=3, records_valid=3,
                                               records_invalid=0))
    got = runs.latest_runs(spark.table(name)).collect()
    assert [(r["job_run_id"], r["run_status"], r["records_read"]) for r in got] == [(11, "SUCCEEDED", 3)]
    assert job.already_loaded(spark, name, "accounts", "2026-08-08", 4)
    assert not job.already_loaded(spark, name, "accounts", "2026-08-09", 4)


def test_source_text_is_parsed_once(spark, tmp_dir, monkeypatch):
    """After landing, the CSV drop is moved away: every later pass (rules,
    metadata, raw overwrite, merge) must run from the landed copy."""
    import shutil
    base, root = f"{tmp_dir}/landing", f"{tmp_dir}/tables"
    write_text(spark, f"{base}/crm_customers_08-08-2026.csv", CSV)
    real_land = job.land
    calls = []

    def land_then_hide(df, path, *a, **k):
        out = real_land(df, path, *a, **k)
        local = base.removeprefix("file:")
        shutil.move(local, local + "-gone")
        calls.append(path)
        return out

    monkeypatch.setattr(job, "land", land_then_hide)
    cfg = config(base, root)
    cfg["validation"] = {"rules": [{"name": "non_nullable", "columns": ["customer_id", "phone"]},
                                   {"name": "unique_key", "columns": ["customer_id"]},
                                   {"name": "length", "column": "phone", "min": 10, "max": 10},
                                   {"name": "numeric_only", "column": "phone"},
                                   {"name": "row_count", "min": 1}]}
    out = job.run_job(spark, cfg, {"business_date": "2026-08-08", "batch_id": 1, "source_name": "crm"},
                      schema=S.entity_schema("crm_customers", with_metadata=False))
    assert len(calls) == 1 and out["run_status"] == "SUCCEEDED" and out["records_inserted"] == 2


def test_entity_job_configs(spark, tmp_dir):
    from batchgate.jobs import entity_job
    cfg = entity_job("accounts", "/landing/crm/")
    spec = job.JobSpec.of(cfg)
    assert (spec.keys, spec.master.name, spec.raw.name) == (["account_id"], "bronze.crm_accounts", "raw.crm_accounts")
    assert [r["name"] for r in spec.rules] == ["non_nullable"]
    cust = job.JobSpec.of(entity_job("customers", "/l", table_root="/t"))
    assert [r["name"] for r in cust.rules] == ["non_nullable", "length", "numeric_only"]
    assert cust.master.path == "/t/bronze/crm_customers"
    # a standard config runs end to end with the registry schema
    base = f"{tmp_dir}/landing"
    write_text(spark, f"{base}/crm_customers_08-08-2026.csv", CSV)
    from batchgate.__main__ import main
    assert main(["customers", "2026-08-08", "1", "crm", "--landing", base, "--tables", f"{tmp_dir}/t"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/t/bronze/crm_customers").count() == 2


def test_run_events_in_the_ddl_control_table(spark):
    made = S.create_tables(spark, database_prefix="bgddl_", tables=["control.job_run_control"])
    name = made[0]
    run = runs.new_run("leads", "2026-08-08", 2, "crm", "load", job_run_id=21)
    runs.record_event(spark, name, run)
    runs.record_event(spark, name, runs.finish(run, runs.FAILED, error_summary="boom", now=run["started_at"]))
    got = runs.latest_runs(spark.table(name)).collect()
    assert [(r["job_run_id"], r["run_status"], r["error_summary"]) for r in got] == [(21, "FAILED", "boom")]


def test_write_failure_is_recorded(spark, tmp_dir):
    """The gate passes, then the merge refuses the batch (the existing master
    has a column the batch lacks): the run is FAILED with its counters."""
    base, root = f"{tmp_dir}/landing", f"{tmp_dir}/tables"
    write_text(spark, f"{base}/crm_customers_08-08-2026.csv", CSV)
    cfg = config(base, root)
    schema = S.entity_schema("crm_customers", with_metadata=False)
    from batchgate.functions.columns import with_metadata
    from batchgate.operators import merge
    seed = with_metadata(spark.createDataFrame([("C9", "x")], "customer_id string, extra string"), 0, "2026-08-01", "crm")
    merge.merge_into(spark, seed, TableRef(path=f"{root}/bronze"), ["customer_id"], buckets=4)
    control = TableRef(path=f"{tmp_dir}/control")
    with pytest.raises(ValueError, match="not in the target"):
        job.run_job(spark, cfg, {"business_date": "2026-08-08", "batch_id": 1, "source_name": "crm"},
                    schema=schema, control=control, job_run_id=31)
    r = runs.latest_runs(spark.read.parquet(control.path)).collect()[0]
    assert (r["run_status"], r["records_read"], r["records_valid"], r["records_invalid"]) == ("FAILED", 2, 2, 0)
    assert "not in the target" in r["error_summary"]


def test_job_with_catalog_tables(spark, tmp_dir):
    from batchgate.session import scratch_database
    db = scratch_database(spark)
    base = f"{tmp_dir}/landing"
    write_text(spark, f"{base}/crm_customers_08-08-2026.csv", CSV)
    write_text(spark, f"{base}/crm_customers_09-08-2026.csv", CSV[:2] + [CSV[2].replace("C002", "C003")])
    cfg = config(base, "unused")
    cfg["target"]["raw"] = {"schema": db, "table": "raw_customers", "format": "parquet"}
    cfg["target"]["master"] = {"schema": db, "table": "bronze_customers", "format": "parquet"}
    schema = S.entity_schema("crm_customers", with_metadata=False)
    job.run_job(spark, cfg, {"business_date": "2026-08-08", "batch_id": 1, "source_name": "crm"}, schema=schema)
    out = job.run_job(spark, cfg, {"business_date": "2026-08-09", "batch_id": 2, "source_name": "crm"},
                      schema=schema)
    assert (out["records_inserted"], out["records_updated"]) == (1, 1)
    bronze = {r["customer_id"]: r["record_version"] for r in spark.table(f"{db}.bronze_customers").collect()}
    assert bronze == {"C001": 2, "C002": 1, "C003": 1}
    assert spark.table(f"{db}.raw_customers").count() == 2
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {db}.bronze_customers").collect()}
    assert props["batchgate.layout"] == "bucketed"


def test_parse_errors_can_fail_the_run(spark, tmp_dir):
    base, root = f"{tmp_dir}/landing", f"{tmp_dir}/tables"
    write_text(spark, f"{base}/crm_customers_08-08-2026.csv", CSV[:2] + [CSV[2].replace("2026/03/02 11:40:00", "soon")])
    cfg = config(base, root)
    schema = S.entity_schema("crm_customers", with_metadata=False)
    details = {"business_date": "2026-08-08", "batch_id": 1, "source_name": "crm"}
    out = job.run_job(spark, cfg, details, schema=schema)
    assert (out["run_status"], out["corrupt_rows"]) == ("SUCCEEDED", 1)       # counted, not gating
    assert "_corrupt_record" not in spark.read.parquet(f"{root}/bronze").columns
    cfg["validation"]["no_parse_errors"] = {}
    with pytest.raises(ValidationError, match="no_parse_errors"):
        job.run_job(spark, cfg, dict(details, batch_id=2), schema=schema)


def test_run_business_date_follows_the_session_zone(spark):
    key = "spark.sql.session.timeZone"
    previous = spark.conf.get(key)
    spark.conf.set(key, "America/Los_Angeles")
    try:
        frame = runs.events_frame(spark, [runs.new_run("j", "2026-08-08", 1, "crm", "load", job_run_id=5)])
        same = frame.select((F.col("business_date") == F.lit("2026-08-08").cast("timestamp")).alias("eq")).first()
        assert same["eq"]
    finally:
        spark.conf.set(key, previous)


def test_cli_with_a_json_config(spark, tmp_dir, capsys):
    import json
    import os
    base, root = f"{tmp_dir}/landing", f"{tmp_dir}/tables"
    write_text(spark, f"{base}/crm_customers_08-08-2026.csv", CSV)
    local = tmp_dir.removeprefix("file:")
    os.makedirs(local, exist_ok=True)
    path = os.path.join(local, "job.json")
    with open(path, "w") as fh:
        json.dump(config(base, root), fh)
    from batchgate.__main__ import main
    assert main([path, "2026-08-08", "3", "crm"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (out["run_status"], out["records_read"], out["records_inserted"]) == ("SUCCEEDED", 2, 2)
