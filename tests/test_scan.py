"""CSV scans: header checks, binding, bad values, dated paths, landing."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from batchgate.sources import files
from batchgate.spec import SourceSpec

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType()),
                       T.StructField("created_at", T.TimestampType())])


def write_text(spark, path, lines):
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(path)


def src(**kw):
    return SourceSpec.of(dict({"header": True, "timestamp_format": "yyyy/MM/dd HH:mm:ss"}, **kw))


def test_dated_path_and_bad_date():
    s = {"path": "/landing/crm/", "file_format": "crm_customers_{dd}-{MM}-{yyyy}.csv"}
    assert files.dated_path(s, "2026-08-08") == "/landing/crm/crm_customers_08-08-2026.csv"
    with pytest.raises(ValueError):
        files.dated_path(s, "08-08-2026")


def test_bad_and_empty_values_become_null(spark, tmp_dir):
    write_text(spark, tmp_dir, ["id,name,created_at", "1,a,2026/08/08 10:00:00", "2,,25/09/2026 09:15:00",
                                "3, ,2026/08/08 11:00:00"])
    rows = {r["id"]: r for r in files.scan_csv(spark, tmp_dir, SCHEMA, src()).collect()}
    assert rows["1"]["created_at"] is not None
    assert rows["2"]["name"] is None and rows["2"]["created_at"] is None
    assert rows["3"]["name"] == " "


def test_header_mismatch_is_an_error_unless_position_parity(spark, tmp_dir):
    write_text(spark, tmp_dir, ["name,id,created_at", "a,1,2026/08/08 10:00:00"])
    with pytest.raises(Exception, match="(?i)header|schema"):
        files.scan_csv(spark, tmp_dir, SCHEMA, src()).collect()
    shifted = files.scan_csv(spark, tmp_dir, SCHEMA, src(check_header=False)).collect()[0]
    assert shifted["id"] == "a"      # by position, as the header is ignored
    by_name = files.scan_csv(spark, tmp_dir, SCHEMA, src(binding="name")).collect()[0]
    assert (by_name["id"], by_name["name"]) == ("1", "a") and by_name["created_at"] is not None


def test_by_name_absent_columns_and_surplus(spark, tmp_dir):
    write_text(spark, tmp_dir, ["id,extra", "1,x"])
    with pytest.raises(files.HeaderMismatchError, match="missing=.'name', 'created_at'.*unknown=.'extra'"):
        files.scan_csv(spark, tmp_dir, SCHEMA, src(binding="name"))
    stated = src(binding="name", optional_columns=["name", "CREATED_AT"], ignored_columns="Extra")
    r = files.scan_csv(spark, tmp_dir, SCHEMA, stated).collect()[0]
    assert (r["id"], r["name"], r["created_at"]) == ("1", None, None)


ROW = "2026/08/08 10:00:00"


@pytest.mark.parametrize("header", ["id,Name,created_at", "ID,NAME,Created_At", "\"id\",\"name\",created_at"])
def test_by_name_ignores_the_case_of_names(spark, tmp_dir, header):
    write_text(spark, tmp_dir, [header, f"1,a,{ROW}"])
    r = files.scan_csv(spark, tmp_dir, SCHEMA, src(binding="name"), corrupt=True).collect()[0]
    assert (r["id"], r["name"], str(r["created_at"]), r["_corrupt_record"]) == ("1", "a", "2026-08-08 10:00:00", None)


@pytest.mark.parametrize("header, fault", [("id,nmae,created_at", "missing=.'name'.*unknown=.'nmae'"),
                                           ("id,name,name,created_at", "repeated=.'name'"), ("id,name,NAME,created_at", "repeated=.'name'"),
                                           ("a,b,c", "missing=.'id', 'name', 'created_at'")])
def test_by_name_headers_that_do_not_fit_are_refused(spark, tmp_dir, header, fault):
    write_text(spark, tmp_dir, [header, f"1,a,{ROW},x"])
    with pytest.raises(files.HeaderMismatchError, match=fault):
        files.scan_csv(spark, tmp_dir, SCHEMA, src(binding="name"))


def test_by_name_follows_a_case_sensitive_session(spark, tmp_dir):
    names = files.match_header(["ID", "id", "name", "created_at"], SCHEMA, src(ignored_columns=["ID"]), case_sensitive=True)
    assert names.fits and names.positions == {"id": 1, "name": 2, "created_at": 3}
    assert not files.match_header(["ID", "name", "created_at"], SCHEMA, src(), case_sensitive=True).fits


def test_blank_first_lines_quoted_names_and_empty_files(spark, tmp_dir):
    write_text(spark, f"{tmp_dir}/a", ["", "  ", '"na,me",id,created_at', f'"x, y",1,{ROW}'])
    write_text(spark, f"{tmp_dir}/b", ["id,created_at,\"na,me\"", f"2,{ROW},z"])
    spark.createDataFrame([], "value string").coalesce(1).write.text(f"{tmp_dir}/c")
    schema = T.StructType([SCHEMA[0], T.StructField("na,me", T.StringType()), SCHEMA[2]])
    got = files.scan_csv(spark, [f"{tmp_dir}/{x}" for x in "abc"], schema, src(binding="name")).collect()
    assert sorted((r["id"], r["na,me"]) for r in got) == [("1", "x, y"), ("2", "z")]
    empty = files.scan_csv(spark, f"{tmp_dir}/c", SCHEMA, src(binding="name"), corrupt=True, path_column="p")
    assert empty.count() == 0 and empty.columns == ["id", "name", "created_at", "_corrupt_record", "p"]
    with pytest.raises(ValueError, match="header"):
        files.scan_csv(spark, tmp_dir, SCHEMA, src(binding="name", header=False))


def _jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_headers_of_many_files_take_one_job(spark, tmp_dir):
    headers = ["id,name,created_at", "created_at,ID,name", "name,id,created_at,more"]
    rows = ["1,a,", ",1,a", "a,1,,x"]
    for k in range(30):
        write_text(spark, f"{tmp_dir}/{k}", [headers[k % 3], *[rows[k % 3]] * 50])
    by_name = src(binding="name", ignored_columns=["more"])
    few = _jobs(spark, "few", lambda: files.match_headers(spark, [f"{tmp_dir}/{k}" for k in range(3)], SCHEMA, by_name))
    many = _jobs(spark, "many", lambda: files.match_headers(spark, [f"{tmp_dir}/{k}" for k in range(30)], SCHEMA, by_name))
    assert few == many
    everything = files.scan_csv(spark, f"{tmp_dir}/*", SCHEMA, by_name)
    assert everything.count() == 1500 and everything.where("id = '1' AND name = 'a'").count() == 1500
    report = {tuple(r["header"]): r for r in files.header_report(spark, f"{tmp_dir}/*", SCHEMA, src(binding="name")).collect()}
    assert {h: (r["files"], r["fits"]) for h, r in report.items()} == {
        ("id", "name", "created_at"): (10, True), ("created_at", "ID", "name"): (10, True), ("name", "id", "created_at", "more"): (10, False)}
    assert report["created_at", "ID", "name"]["recased"] == ["ID"] and report["name", "id", "created_at", "more"]["unknown"] == ["more"]


def test_corrupt_rows_counted_while_landing(spark, tmp_dir):
    write_text(spark, tmp_dir, ["id,name,created_at", "1,a,2026/08/08 10:00:00", "2,b,not a time",
                                "3,c,2026/08/08 10:00:00,surplus", "4"])
    parsed = files.scan_csv(spark, tmp_dir, SCHEMA, src(), corrupt=True)
    landed, counters = files.land(parsed, tmp_dir + "-landed")
    assert (counters["rows"], counters["corrupt_rows"]) == (4, 3)
    assert counters["bytes"] >= 4 * 16
    assert landed.count() == 4


def test_missing_path(spark, tmp_dir):
    with pytest.raises(AnalysisException):
        files.read_source(spark, {"type": "file", "path": tmp_dir, "file_format": "x_{dd}.csv"},
                          "2026-08-08", SCHEMA).collect()
    with pytest.raises(ValueError, match="Unsupported source type"):
        files.read_source(spark, {"type": "jdbc", "path": tmp_dir, "file_format": "x"}, "2026-08-08", SCHEMA)


def test_dated_scan_tags_rows_and_globs_range(spark, tmp_dir):
    for day in ("07-08-2026", "08-08-2026", "10-08-2026"):
        write_text(spark, f"{tmp_dir}/c_{day}.csv", ["id,name,created_at", f"{day},n,2026/08/08 10:00:00"])
    s = src(path=tmp_dir, file_format="c_{dd}-{MM}-{yyyy}.csv")
    all_days = files.scan_dated_files(spark, s, SCHEMA)
    assert sorted(str(r["business_date"]) for r in all_days.collect()) == ["2026-08-07", "2026-08-08", "2026-08-10"]
    rng = files.scan_dated_files(spark, s, SCHEMA, start="2026-08-08", end="2026-08-09")
    assert [r["id"] for r in rng.collect()] == ["08-08-2026"]
    assert "08-08-2026" in files.dated_glob(s, "2026-08-08", "2026-08-09")
    listed = files.scan_dated_files(spark, s, SCHEMA, dates=["2026-08-07", "2026-08-09", "2026-08-10"],
                                    missing_ok=True)                    # 09 has no drop
    assert sorted(r["id"] for r in listed.collect()) == ["07-08-2026", "10-08-2026"]
    with pytest.raises(AnalysisException):
        files.scan_dated_files(spark, s, SCHEMA, dates=["2026-08-09"]).collect()


def test_infer_schema(spark, tmp_dir):
    write_text(spark, tmp_dir, ["id,phone,created_at", "C1,5550101010,25/09/2026 09:15:00"])
    df = files.scan_csv_infer(spark, tmp_dir)
    assert dict(df.dtypes)["phone"] == "bigint"


SAMPLE_SHAPE = [  # the sample drop's layout, own rows
    "customer_id,customer_name,email,phone,city,created_at,source_updated_at,customer_status",
    "K101,Lena Moor,lena@example.org,9000000001,Pune,03/02/2026 10:00:00,04/02/2026 09:30:00,ACTIVE",
    "K102,Omar Said,omar@example.org,9000000002,Delhi,05/02/2026 11:15:00,06/02/2026 08:45:00,INACTIVE",
]


def test_sample_shaped_drop_by_name_and_mismatch(spark, tmp_dir):
    from batchgate import schemas as S
    schema = S.entity_schema("crm_customers", with_metadata=False)
    write_text(spark, tmp_dir, SAMPLE_SHAPE)
    fmt = {"header": True, "timestamp_format": "dd/MM/yyyy HH:mm:ss"}
    by_name = {r["customer_id"]: r for r in
               files.scan_csv(spark, tmp_dir, schema, dict(fmt, binding="name", optional_columns=["state", "country", "phone", "updated_at_raw"],
                                                           ignored_columns=["source_updated_at", "customer_status"])).collect()}
    k = by_name["K101"]
    assert (k["city"], k["state"], k["country"], k["updated_at_raw"]) == ("Pune", None, None, None)
    assert str(k["created_at"]) == "2026-02-03 10:00:00"
    with pytest.raises(Exception, match="(?i)header|schema"):          # reported, not shifted
        files.scan_csv(spark, tmp_dir, schema, fmt).collect()
    shifted = files.scan_csv(spark, tmp_dir, schema, dict(fmt, check_header=False, timestamp_format="yyyy/MM/dd HH:mm:ss"))
    row = {r["customer_id"]: r for r in shifted.collect()}["K101"]
    assert row["state"] == "03/02/2026 10:00:00" and row["created_at"] is None   # by-position parity
