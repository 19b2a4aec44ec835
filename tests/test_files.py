"""File sources and sinks, and the streaming locality loader."""

import json
import os

from pyspark.sql import functions as F

from carepulse.sources import files


def test_scan_csv_and_latest(spark, tmpdir_path):
    for day, n in (("20240101", 1), ("20240103", 3), ("20240102", 2)):
        with open(os.path.join(tmpdir_path, f"la_peer_signals_{day}.csv"), "w") as f:
            f.write("unit,n\n" + "".join(f"LA{i},{i}\n" for i in range(n)))
    path = files.latest_file(spark, tmpdir_path, "la_peer_signals_*.csv")
    assert path.endswith("la_peer_signals_20240103.csv")
    assert files.read_latest_csv(spark, tmpdir_path, "la_peer_signals_*.csv").count() == 3
    df = files.scan_csv_dataset(spark, tmpdir_path, "la_peer_signals_20240102", "unit string, n int")
    assert [r.n for r in df.orderBy("n").collect()] == [0, 1]


def test_append_is_idempotent(spark, tmpdir_path):
    target = os.path.join(tmpdir_path, "locality")
    a = spark.createDataFrame([("C1", "x"), ("C2", "y")], "CASE_REFERENCE string, COUNTY string")
    assert files.append_new_rows(a, target, "CASE_REFERENCE") == 2
    b = spark.createDataFrame([("C2", "y"), ("C3", "z")], "CASE_REFERENCE string, COUNTY string")
    assert files.append_new_rows(b, target, "CASE_REFERENCE") == 1
    assert files.append_new_rows(b, target, "CASE_REFERENCE") == 0
    got = sorted(r[0] for r in spark.read.parquet(target).collect())
    assert got == ["C1", "C2", "C3"]


def test_export_json_keeps_nulls_and_skips(spark, tmpdir_path):
    t1 = spark.createDataFrame([("LA", None)], "LA_NAME string, QUERY_COUNT_DISPLAY string")
    empty = spark.createDataFrame([], "LA_NAME string")
    res = files.export_json([("b_empty", empty), ("a_mart", t1), ("raw", t1)], tmpdir_path,
                            refuse_unsuppressed=("raw",))
    assert res == {"a_mart": "ok", "b_empty": "empty", "raw": "refused"}
    lines = []
    for fn in os.listdir(os.path.join(tmpdir_path, "a_mart")):
        if fn.endswith(".json"):
            lines += [json.loads(x) for x in open(os.path.join(tmpdir_path, "a_mart", fn)) if x.strip()]
    assert lines == [{"LA_NAME": "LA", "QUERY_COUNT_DISPLAY": None}]


def test_locality_stream(spark, tmpdir_path):
    from carepulse.streaming.locality import start_locality_stream
    landing = os.path.join(tmpdir_path, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "r1.csv"), "w") as f:
        f.write("Case Reference,Postcode\nC1,P1\nC2,\nC3,P9\n")
    directory = spark.createDataFrame([("P1", "LA1", "County1")], "postcode string, la_name string, county string")
    target = os.path.join(tmpdir_path, "target")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    q = start_locality_stream(spark, landing, target, directory, checkpoint=ckpt)
    q.awaitTermination(120)
    with open(os.path.join(landing, "r2.csv"), "w") as f:
        f.write("Case Reference,Postcode\nC1,P1\nC4,P1\n")
    q = start_locality_stream(spark, landing, target, directory, checkpoint=ckpt)
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(target).select("CASE_REFERENCE", "LA_NAME").collect())
    assert got == [("C1", "LA1"), ("C3", None), ("C4", "LA1")]
    assert spark.read.parquet(target).filter(F.col("CASE_REFERENCE") == "C1").count() == 1


def test_append_check_unique(spark, tmpdir_path):
    import pytest
    target = os.path.join(tmpdir_path, "loc_dup")
    a = spark.createDataFrame([("C1", "x"), ("C1", "y")], "CASE_REFERENCE string, COUNTY string")
    with pytest.raises(ValueError):
        files.append_new_rows(a, target, "CASE_REFERENCE", check_unique=True)


def test_duplicates_are_refused_before_the_write(spark, tmpdir_path):
    import pytest
    target = os.path.join(tmpdir_path, "loc_dup2")
    files.append_new_rows(spark.createDataFrame([("C1", "x")], "CASE_REFERENCE string, COUNTY string"), target, "CASE_REFERENCE", check_unique=True)
    twice = spark.createDataFrame([("C2", "x"), ("C2", "y")], "CASE_REFERENCE string, COUNTY string")
    with pytest.raises(ValueError):
        files.append_new_rows(twice, target, "CASE_REFERENCE", check_unique=True)
    assert [r[0] for r in spark.read.parquet(target).collect()] == ["C1"]
    assert files.append_new_rows(spark.createDataFrame([("C3", "x")], "CASE_REFERENCE string, COUNTY string"), target, "CASE_REFERENCE", check_unique=True) == 1


def test_unreadable_target_fails_without_a_write(spark, tmpdir_path):
    import pytest

    from carepulse.streaming.locality import start_locality_stream
    target, landing = os.path.join(tmpdir_path, "t"), os.path.join(tmpdir_path, "landing")
    rows = spark.createDataFrame([("C1", "x", "y"), ("C2", "x", "y")], "CASE_REFERENCE string, LA_NAME string, COUNTY string")
    rows.write.parquet(target)
    with open(os.path.join(target, "part-99999-broken.parquet"), "w") as f:
        f.write("not parquet")
    before = sorted(os.listdir(target))
    os.makedirs(landing)
    with open(os.path.join(landing, "r1.csv"), "w") as f:
        f.write("Case Reference,Postcode\nC9,P1\n")
    directory = spark.createDataFrame([("P1", "LA1", "County1")], "postcode string, la_name string, county string")
    with pytest.raises(Exception):  # noqa: B017 - whatever the reader raises
        start_locality_stream(spark, landing, target, directory, checkpoint=os.path.join(tmpdir_path, "c")).awaitTermination(120)
    with pytest.raises(Exception):  # noqa: B017
        files.append_new_rows(rows, target, "CASE_REFERENCE")
    assert sorted(os.listdir(target)) == before


def test_skipped_failed_and_empty_datasets_survive_a_second_load(spark, tmpdir_path):
    target = os.path.join(tmpdir_path, "ext")
    schema = "dataset_id string, v int, _RUN_ID string"
    first = spark.createDataFrame([(d, i, "r1") for d in ("d1", "skipped", "failed", "empty") for i in range(3)], schema)
    files.replace_datasets(first, target)
    files.replace_datasets(spark.createDataFrame([("d1", 7, "r2"), ("new", 8, "r2")], schema), target)
    got = sorted((r.dataset_id, r.v, r._RUN_ID) for r in spark.read.parquet(target).collect())
    assert got == sorted([(d, i, "r1") for d in ("skipped", "failed", "empty") for i in range(3)] + [("d1", 7, "r2"), ("new", 8, "r2")])


def test_export_reports_broken_and_refused_tables(spark, tmpdir_path):
    import pytest
    good = spark.createDataFrame([("LA", "1-5")], "LA_NAME string, QUERY_COUNT_DISPLAY string")
    broken = good.select(F.raise_error(F.lit("broken")).alias("x"))
    with pytest.raises(RuntimeError, match="a_broken"):
        files.export_json([("a_broken", broken), ("b_good", good), ("mart_la_query_summary", good)], tmpdir_path)
    assert os.path.isdir(os.path.join(tmpdir_path, "b_good")) and not os.path.isdir(os.path.join(tmpdir_path, "mart_la_query_summary"))
    assert files.export_json([("mart_la_query_summary", good)], tmpdir_path) == {"mart_la_query_summary": "refused"}


def test_a_failing_or_empty_export_keeps_the_one_before(spark, tmpdir_path):
    import pytest
    good = spark.createDataFrame([("LA", "1-5")], "LA_NAME string, QUERY_COUNT_DISPLAY string")
    assert files.export_json([("a", good), ("b", good)], tmpdir_path) == {"a": "ok", "b": "ok"}
    with pytest.raises(RuntimeError, match="export failures: a"):
        files.export_json([("a", good.select(F.raise_error(F.lit("broken")).alias("x"))), ("b", good.limit(0))], tmpdir_path)
    assert [spark.read.json(f"{tmpdir_path}/{n}").count() for n in ("a", "b")] == [1, 1]
    assert files.export_json([("a", good.union(good))], tmpdir_path) == {"a": "ok"}
    assert spark.read.json(f"{tmpdir_path}/a").count() == 2


def _stream(spark, folder, name, text, target):
    from carepulse.streaming.locality import start_locality_stream
    landing = os.path.join(folder, "landing")
    os.makedirs(landing, exist_ok=True)
    with open(os.path.join(landing, name), "w") as f:
        f.write("Case Reference,Postcode\n" + text)
    directory = spark.createDataFrame([("P1", "LA1", "County1"), ("P2", "LA2", "County2")], "postcode string, la_name string, county string")
    start_locality_stream(spark, landing, target, directory, checkpoint=os.path.join(folder, "ckpt")).awaitTermination(120)
    return sorted(tuple(r) for r in spark.read.parquet(target).select("CASE_REFERENCE", "LA_NAME").collect())


def test_stream_writes_a_repeated_case_once(spark, tmpdir_path):
    target = os.path.join(tmpdir_path, "target")
    assert _stream(spark, tmpdir_path, "r1.csv", "C1,P2\nC1,P1\nC1,\nC2,P2\nC1,P2\n", target) == [("C1", "LA1"), ("C2", "LA2")]
    assert _stream(spark, tmpdir_path, "r2.csv", "C2,P1\nC3,P1\nC3,P1\n", target) == [("C1", "LA1"), ("C2", "LA2"), ("C3", "LA1")]


def test_replayed_batch_changes_nothing(spark, tmpdir_path):
    """A batch whose commit was lost is run again: with its marker it is skipped, without (it died while appending, some
    rows had arrived) only the missing rows are added."""
    target, ckpt = os.path.join(tmpdir_path, "target"), os.path.join(tmpdir_path, "ckpt")
    want = _stream(spark, tmpdir_path, "r1.csv", "C1,P1\nC2,P2\nC2,P1\nC3,P1\n", target)
    files_before = sorted(os.listdir(target))

    def lose_commit():
        for f in os.listdir(os.path.join(ckpt, "commits")):
            os.remove(os.path.join(ckpt, "commits", f))
    lose_commit()
    assert _stream(spark, tmpdir_path, "r1.csv", "C1,P1\nC2,P2\nC2,P1\nC3,P1\n", target) == want
    assert sorted(os.listdir(target)) == files_before
    lose_commit()
    for f in os.listdir(target + "_batches"):
        os.remove(os.path.join(target + "_batches", f))
    rest = spark.read.parquet(target).filter("CASE_REFERENCE != 'C2'").toPandas()
    for f in os.listdir(target):
        os.remove(os.path.join(target, f))
    spark.createDataFrame(rest).write.mode("append").parquet(target)
    assert _stream(spark, tmpdir_path, "r1.csv", "C1,P1\nC2,P2\nC2,P1\nC3,P1\n", target) == want
