"""Hand-made cases for the loaders: manifest outcomes, staleness edges,
freshness thresholds, keep-first, envelope."""

import glob
import os
import zoneinfo

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from carepulse.operators import ingest


def test_manifest_plan_all_outcomes(spark):
    ds = spark.createDataFrame([
        ("lim", "LIMITATION"), ("bad", "FAILED_FETCH"), ("cur", "NO_UPDATE"), ("new", "NO_UPDATE"),
        ("ok", "SUCCESS"), ("odd", "PARTIAL"), ("gone", "SUCCESS"), ("gone2", "NO_UPDATE")],
        "dataset_id string, status string")
    tables = spark.createDataFrame([("cur",)], "table_name string")
    fls = spark.createDataFrame([("new.csv",), ("ok.csv",), ("cur.csv",)], "file_name string")
    got = {r.DATASET_ID: r.ACTION for r in ingest.manifest_load_plan(ds, tables, fls).collect()}
    assert got == {"lim": "skip", "bad": "failed", "cur": "skip", "new": "first_time_load", "ok": "load",
                   "odd": "skip", "gone": "failed", "gone2": "failed"}
    s = ingest.load_summary(ingest.manifest_load_plan(ds, tables, fls)).first()
    assert (s.N_LOADED, s.N_SKIPPED, s.N_FAILED, s.OUTCOME) == (2, 3, 3, "failed")
    with pytest.raises(RuntimeError):
        ingest.raise_on_failures(s)


def test_tag_provenance_rejects_case_insensitive_clash(spark):
    df = spark.createDataFrame([(1, "x")], "a int, _run_id string")
    with pytest.raises(ValueError):
        ingest.tag_provenance(df, "r", "t", None)
    ok = ingest.tag_provenance(df.drop("_run_id"), "r", "t", "SCHEMA_DRIFT").first()
    assert (ok._RUN_ID, ok._RUN_AT, ok._DRIFT_FLAG) == ("r", "t", "SCHEMA_DRIFT")


def test_staleness_boundary(spark):
    md = spark.createDataFrame([
        ("AVA", "t30", 1, "2026-01-01 23:59:00"), ("AVA", "t31", 1, "2025-12-31 00:00:00"),
        ("OTHER", "x", 1, "2020-01-01 00:00:00")], "database string, table_name string, row_count long, last_altered string")
    md = md.withColumn("last_altered", F.to_timestamp_ntz("last_altered"))
    got = {r.TABLE_NAME: (r.DAYS_SINCE_UPDATE, r.STATUS)
           for r in ingest.table_staleness(md, "2026-01-31 00:01:00", ["AVA"]).collect()}
    assert got == {"t30": (30, "fresh"), "t31": (31, "stale")}


def test_freshness_thresholds(spark):
    loaded = spark.createDataFrame([
        ("A", "a_pass", "2026-01-02 00:00:00"), ("A", "a_warn", "2025-12-31 23:00:00"), ("A", "a_edge", "2026-01-01 00:00:00"),
        ("A", "a_err", "2025-12-30 00:00:00"), ("A", "a_off", "2020-01-01 00:00:00"),
        ("B", "b_none", "2020-01-01 00:00:00"), ("C", "c_nocfg", "2020-01-01 00:00:00"),
        ("B", "b_ov", "2025-12-01 00:00:00"), ("B", "a_off", "2025-12-30 00:00:00"), ("A", "a_part", "2020-01-01 00:00:00"),
        ("A", "a_part2", "2025-12-31 12:00:00"), ("A", "a_null", None)], "database string, table_name string, loaded_at string")
    loaded = loaded.withColumn("loaded_at", F.to_timestamp_ntz("loaded_at"))
    cfg = spark.createDataFrame([("A", 36, "hour", 72, "hour"), ("B", None, None, None, None)],
                                "database string, warn_count int, warn_period string, error_count int, error_period string")
    # a name in two databases, and overrides that give the warning alone
    ov = spark.createDataFrame([("A", "a_off", False, None, None, None, None), ("B", "b_ov", True, 10, "day", 90, "day"),
                                ("A", "a_part", True, 10, "day", None, None), ("A", "a_part2", True, 10, "day", None, None)],
                               "database string, table_name string, enabled boolean, warn_count int, warn_period string, "
                               "error_count int, error_period string")
    rows = ingest.source_freshness(loaded, cfg, ov, "2026-01-02 12:00:00").collect()
    got = {(r.DATABASE, r.TABLE_NAME): r.STATUS for r in rows}
    assert len(rows) == len(got)
    assert got == {("A", "a_pass"): "pass", ("A", "a_warn"): "warn", ("A", "a_edge"): "pass", ("A", "a_err"): "error",
                   ("A", "a_off"): "skipped", ("B", "b_none"): "skipped", ("C", "c_nocfg"): "skipped", ("B", "b_ov"): "warn",
                   ("B", "a_off"): "skipped", ("A", "a_part"): "error", ("A", "a_part2"): "pass", ("A", "a_null"): "unknown"}


def test_staleness_without_a_change_time(spark):
    meta = spark.createDataFrame([("A", "t", 1, None), ("A", "u", 1, "2026-01-01 00:00:00")], "database string, table_name string, row_count int, last_altered string")
    meta = meta.withColumn("last_altered", F.to_timestamp_ntz("last_altered"))
    got = {r.TABLE_NAME: r.STATUS for r in ingest.table_staleness(meta, "2026-01-02 12:00:00", ["A"]).collect()}
    assert got == {"t": "unknown", "u": "fresh"}


def test_repeated_directory_postcode_keeps_one_row_per_case(spark):
    report = spark.createDataFrame([("C1", "P1"), ("C2", "P2")], "`Case Reference` string, Postcode string")
    directory = spark.createDataFrame([("P1", "LA1", "X"), ("P1", "LA1", "X"), ("P1", "LA2", "Y")], "postcode string, la_name string, county string")
    existing = spark.createDataFrame([], "case_reference string")
    got = sorted(tuple(r) for r in ingest.enrich_postcode(report, existing, directory).collect())
    assert got == [("C1", "LA1", "X"), ("C2", None, None)]


def test_clean_demographics_keep_first(spark):
    raw = spark.createDataFrame([
        (" c1 ", "[Not Specified]", 2), ("C1", "18-24", 1), ("c1\t", "65+", 3), ("C2", "", 5)],
        "`Case Reference` string, `Age Range` string, ingest_seq int")
    got = sorted(tuple(r) for r in ingest.clean_demographics(raw).collect())
    assert got == [("C1", "18-24", 1), ("C2", None, 5)]
    with pytest.raises(ValueError):
        ingest.clean_demographics(raw.withColumnRenamed("Case Reference", "ref"))


def test_findings_envelope(spark):
    board = spark.createDataFrame([("f1", "G"), ("f2", "G"), ("x", "H")], "item_name string, group_title string")
    rows = ingest.findings_envelope(board, "G", "src", "b1", "2026-01-01T00:00:00Z").collect()
    assert sorted(r.item_name for r in rows) == ["f1", "f2"] and {r.N_FINDINGS for r in rows} == {2}
    with pytest.raises(ValueError):
        ingest.findings_envelope(board, "Z", "src", "b1", "t")


def test_narrative_missing_la(spark):
    docs = spark.createDataFrame([Row(json='{"run_date": "20240101", "las": {"A": {"total_signals": 3, '
                                           '"top_signal": "x"}}}')])
    a = ingest.narrative_for_la(docs, "A").first()
    b = ingest.narrative_for_la(docs, "B").first()
    assert (a.TOTAL_SIGNALS, a.TOP_SIGNAL) == (3, "x") and (b.TOTAL_SIGNALS, b.TOP_SIGNAL) == (0, None)


def test_ordered_reports(spark):
    orgs = spark.createDataFrame([("a", "X"), ("b", "Y"), ("c", "Y")], "monday_name string, service_type string")
    assert [r.SERVICE_TYPE for r in ingest.service_type_counts(orgs, ordered=True).collect()] == ["Y", "X"]
    md = spark.createDataFrame([("AVA", "t1", 1, "2026-01-20 00:00:00"), ("AVA", "t2", 1, "2025-06-01 00:00:00")],
                               "database string, table_name string, row_count long, last_altered string")
    md = md.withColumn("last_altered", F.to_timestamp_ntz("last_altered"))
    got = [r.TABLE_NAME for r in ingest.table_staleness(md, "2026-01-31 00:00:00", ["AVA"], ordered=True).collect()]
    assert got == ["t2", "t1"]


def test_narrative_keeps_every_field(spark):
    doc = '{"run_date": "20240101", "las": {"A": {"total_signals": 2, "topics": [{"name": "x", "deep": {"y": [1, null]}}], "note": "a \\"b\\""}}}'
    docs = spark.createDataFrame([(doc,)], "json string")
    import json
    got = json.loads(ingest.narrative_json(ingest.narrative_data(docs, "A", prose='say "x"')).first()[0])
    assert got == {"run_date": "20240101", "la": "A", "prose": 'say "x"', "data": json.loads(doc)["las"]["A"]}
    none = json.loads(ingest.narrative_json(ingest.narrative_data(docs, "B")).first()[0])
    assert none == {"run_date": "20240101", "la": "B", "prose": None, "data": {}}


def test_external_load_from_landed_files(spark, tmpdir_path):
    import json
    import os

    import pytest

    from carepulse.plans.external import list_tables, load_external_sources, read_manifest
    from carepulse.sources.versioned import read_table
    land, target = tmpdir_path + "/land", tmpdir_path + "/tables"
    os.makedirs(land)

    def put(run, datasets, **csv):
        with open(f"{land}/manifest.json", "w") as f:
            json.dump({"run_id": run, "run_at": "t", "datasets": datasets, "other": 1}, f, indent=2)
        for name, text in csv.items():
            with open(f"{land}/{name}.csv", "w") as f:
                f.write(text)
    drift = {"warnings": [{"code": "SCHEMA_DRIFT", "message": "m", "details": "d"}]}
    put("r1", [{"dataset_id": "d1", "status": "SUCCESS", "provenance": drift}, {"dataset_id": "d2", "status": "NO_UPDATE"},
               {"dataset_id": "gap", "status": "LIMITATION", "message": "none"}], d1="a,b\n1,x\n2,y\n", d2="c\n3.5\n")
    plan = {r.DATASET_ID: r.ACTION for r in load_external_sources(spark, land, target).collect()}
    assert plan == {"d1": "load", "d2": "first_time_load", "gap": "skip"}
    assert sorted(r[0] for r in list_tables(spark, target).collect()) == ["d1", "d2"]
    assert read_table(spark, f"{target}/d1").columns == ["a", "b", "_RUN_ID", "_RUN_AT", "_DRIFT_FLAG"]
    assert read_table(spark, f"{target}/d1").select("_DRIFT_FLAG").first()[0] is not None
    # second run: d1 replaced, d2 skipped, the failed one and the one without a file leave their tables alone
    put("r2", [{"dataset_id": "d1", "status": "SUCCESS"}, {"dataset_id": "d2", "status": "NO_UPDATE"},
               {"dataset_id": "d3", "status": "FAILED_FETCH"}, {"dataset_id": "d4", "status": "SUCCESS"}], d1="a,b\n9,z\n")
    with pytest.raises(RuntimeError, match="d3, d4"):
        load_external_sources(spark, land, target)
    assert [tuple(r)[:3] for r in read_table(spark, f"{target}/d1").collect()] == [(9, "z", "r2")]
    assert [r._RUN_ID for r in read_table(spark, f"{target}/d2").collect()] == ["r1"]
    assert read_manifest(spark, f"{land}/manifest.json").count() == 4
    put("r3", [{"dataset_id": "d1", "status": "NO_UPDATE"}])
    load_external_sources(spark, land, target)
    assert read_table(spark, f"{target}/d1").count() == 1
    # a load of d1 that dies while its rows are written: a value that its column can't hold, far down the file
    put("r4", [{"dataset_id": "d1", "status": "SUCCESS"}, {"dataset_id": "d5", "status": "SUCCESS"}],
        d1="a,b\n" + "".join(f"{i},x\n" for i in range(5000)) + "oops,x\n", d5="k\n1\n")
    with pytest.raises(RuntimeError, match="1 dataset.*d1"):
        load_external_sources(spark, land, target)
    assert [tuple(r)[:3] for r in read_table(spark, f"{target}/d1").collect()] == [(9, "z", "r2")]
    assert [r.k for r in read_table(spark, f"{target}/d5").collect()] == [1]
    # another header is another table
    put("r5", [{"dataset_id": "d1", "status": "SUCCESS"}], d1="a,extra\noops,2.5\n")
    load_external_sources(spark, land, target)
    assert [tuple(r)[:2] for r in read_table(spark, f"{target}/d1").collect()] == [("oops", 2.5)]


def test_table_metadata_feeds_monitoring(spark, tmpdir_path):
    spark.range(3).write.parquet(tmpdir_path + "/md_full")
    spark.range(0).write.parquet(tmpdir_path + "/md_none")
    found = ingest.table_metadata({("CASEWORK", "FULL"): spark.read.parquet(tmpdir_path + "/md_full"),
                                   ("CASEWORK", "NONE"): spark.read.parquet(tmpdir_path + "/md_none")})
    rows = {r.table_name: r for r in found.collect()}
    assert rows["FULL"].row_count == 3 and rows["FULL"].last_altered is not None
    assert rows["NONE"].row_count == 0 and rows["NONE"].last_altered is None
    stale = ingest.table_staleness(found, "2999-01-01 00:00:00", ["CASEWORK"])
    assert {r.TABLE_NAME: r.STATUS for r in stale.collect()} == {"FULL": "stale", "NONE": "unknown"}


def test_landed_metadata_reads_footers_only(spark, tmpdir_path):
    from test_plans import plan
    spark.range(30).repartition(3).write.parquet(tmpdir_path + "/lm_full")
    spark.range(0).write.parquet(tmpdir_path + "/lm_none")
    spark.range(0).write.mode("append").parquet(tmpdir_path + "/lm_full")
    found = ingest.landed_metadata(spark, {("CASEWORK", "FULL"): tmpdir_path + "/lm_full", ("CASEWORK", "NONE"): tmpdir_path + "/lm_none"})
    p = plan(found)
    assert p.count("PushedAggregation: [COUNT(*)]") == 2 and "ReadSchema: struct<id" not in p
    rows = {r.table_name: r for r in found.collect()}
    assert (rows["FULL"].row_count, rows["NONE"].row_count) == (30, 0)
    # the newest file's time, the empty file's here: a scan sees the times of files with rows only
    newest = max(os.stat(f).st_mtime for f in glob.glob(tmpdir_path + "/lm_full/*.parquet"))
    zone = zoneinfo.ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
    assert abs(rows["FULL"].last_altered.replace(tzinfo=zone).timestamp() - newest) < 0.01
    assert rows["FULL"].last_altered >= ingest.table_metadata({("CASEWORK", "FULL"): spark.read.parquet(tmpdir_path + "/lm_full")}).first().last_altered
    assert rows["NONE"].last_altered is not None
    stale = ingest.table_staleness(found, "2999-01-01 00:00:00", ["CASEWORK"])
    assert {r.TABLE_NAME: r.STATUS for r in stale.collect()} == {"FULL": "stale", "NONE": "stale"}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_declared_sources_in_full(spark, tmpdir_path):
    from carepulse.sources.schemas import FURTHER_COLUMNS, OPEN_SOURCES, SOURCE_SCHEMAS, full_schema
    from carepulse.sources.tables import scan_declared
    assert set(FURTHER_COLUMNS) <= set(SOURCE_SCHEMAS)
    for name in SOURCE_SCHEMAS:
        names = full_schema(name).names
        assert len(names) == len(set(names))
    spark.createDataFrame([("c1", "AB1 2CD")], "case_reference string, postcode string").write.parquet(tmpdir_path + "/casework_locality")
    r = scan_declared(spark, tmpdir_path, "casework_locality").first()
    assert (r.postcode, r.mso_area_name) == ("AB1 2CD", None)
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(tmpdir_path + "/" + OPEN_SOURCES["monday"][0])
    assert scan_declared(spark, tmpdir_path, OPEN_SOURCES["monday"][0]).columns == ["a", "b"]
    with pytest.raises(KeyError):
        full_schema("no_such_source")
