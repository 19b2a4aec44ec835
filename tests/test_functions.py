"""Hand-made cases (FIXTURES.md part 3) for the column functions and the
small semantic rules."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from carepulse.functions.columns import drift_flag, parse_open_month, standardise_service_type, suppress_small
from carepulse.operators import chatbot, checks, explore, staging
from carepulse.operators.windows import window_start


def test_suppress_small(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.0,), (4.0,), (5.0,), (123.0,)], "n double")
    got = [r[0] for r in df.select(suppress_small("n")).collect()]
    assert got == [None, "1-5", "1-5", "1-5", "5", "123"]


def test_topics_unmatched_unmapped(spark):
    a = spark.createDataFrame(
        [("t1", "LA", None), ("t2", "LA", ""), ("t3", "LA", "a; "), ("t4", None, "a")],
        "transcript_id string, la_name string, topic_entry_point string")
    m = spark.createDataFrame([(" A ", "Seg A", "NA")], "topic_entry_point string, ut1 string, ut2 string")
    x = staging.map_topic_to_theme(staging.explode_topics(a), m)
    rows = sorted(((r.transcript_id, r.topic_value, r.SEGMENT, r.UT2) for r in x.collect()),
                  key=lambda t: (t[0], str(t[1])))
    assert rows == [("t1", None, "Unmatched", None), ("t2", "", "Unmapped", None),
                    ("t3", "", "Unmapped", None), ("t3", "a", "Seg A", None)]


def test_persona_bridge_drops_blanks(spark):
    a = spark.createDataFrame([("t1", None), ("t2", "a;;b; ")], "transcript_id string, persona string")
    got = sorted(tuple(r) for r in chatbot.persona_bridge(a).collect())
    assert got == [("t2", "a"), ("t2", "b")]


@pytest.mark.parametrize("codes,expected", [
    (None, None), ([], None), (["SCHEMA_DRIFT"], "SCHEMA_DRIFT"),
    (["SEMANTIC_DRIFT_SUSPECTED", "SCHEMA_DRIFT"], "SEMANTIC_DRIFT_SUSPECTED+SCHEMA_DRIFT"),
    (["SCHEMA_DRIFT", "OTHER", "SCHEMA_DRIFT"], "SCHEMA_DRIFT"), (["OTHER", None], None),
])
def test_drift_flag(spark, codes, expected):
    schema = "w array<struct<code:string,message:string,details:string>>"
    w = None if codes is None else [Row(code=c, message="m", details="d") for c in codes]
    df = spark.createDataFrame([(w,)], schema)
    assert df.select(drift_flag("w")).first()[0] == expected


def test_month_end_cutoff(spark):
    d = spark.range(1).select(window_start("2026-03-31", 1).alias("c"), window_start("2024-03-31", 1).alias("l"))
    r = d.first()
    assert str(r.c) == "2026-02-28" and str(r.l) == "2024-02-29"


def test_age_null_and_unknown_one_group(spark):
    from carepulse.operators.windows import demographics
    m = spark.createDataFrame([("LA", "2026-03-01", None), ("LA", "2026-03-02", "Unknown")],
                              "LA_NAME string, QUERY_DATE string, AGE_BAND string")
    m = m.withColumn("QUERY_DATE", F.to_date("QUERY_DATE")).withColumn("QUERY_COUNT", F.lit(1).cast("bigint"))
    rows = demographics(m, "2026-03-15", (1,)).collect()
    assert [(r.AGE_BAND, r.QUERY_COUNT_RAW) for r in rows] == [("Unknown", 2)]


def test_case_theme_null_supercategory_and_na(spark):
    rows = spark.createDataFrame([("c1", "id1"), ("c2", "id2")], "case_reference string, s_c_csi_id string")
    csi = spark.createDataFrame([(None, "Cat", "Issue", "id1"), ("Sup", "Cat", "x", "id2")],
                                "supercategory string, category string, case_specific_issue string, s_c_csi_id string")
    themes = spark.createDataFrame([("advicepro", " sup", "CAT ", "Theme", "NA")],
                                   "org string, t1 string, t2 string, ut1 string, ut2 string")
    got = sorted(tuple(r) for r in staging.map_case_to_theme(rows, csi, themes)
                 .select("case_reference", "SEGMENT", "UT2").collect())
    assert got == [("c1", "Unmapped", None), ("c2", "Theme", None)]


def test_open_month_strict_and_lenient(spark):
    df = spark.createDataFrame([("2026/02",), ("02/2026",)], "m string")
    with pytest.raises(Exception):
        df.select(parse_open_month("m")).collect()
    got = [r[0] for r in df.select(parse_open_month("m", strict=False)).collect()]
    assert str(got[0]) == "2026-02-01" and got[1] is None
    rej = staging.reject_bad_open_months(df.withColumnRenamed("m", "case_open_month")).collect()
    assert [r[0] for r in rej] == ["02/2026"]


def test_unmapped_share_edge(spark):
    mk = [("S1", "Unmapped", 2), ("S1", "Other", 98), ("S2", "Unmapped", 201), ("S2", "Other", 9799)]
    df = spark.createDataFrame(mk, "SOURCE_SYSTEM string, UT1 string, QUERY_COUNT bigint")
    got = {r.SOURCE_SYSTEM: str(r.UNMAPPED_PCT) for r in checks.unmapped_share(df).collect()}
    assert got == {"S2": "2.01"}


def test_uncount(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 3)], "k string, w int")
    got = sorted(r.k for r in explore.uncount(df, "w").collect())
    assert got == ["b", "c", "c", "c"]


def test_null_safe_value_map(spark):
    long = spark.createDataFrame([("f", None), ("f", "x")], "FEATURE string, ACCESSAVA string")
    m = spark.createDataFrame([("f", None, "missing"), ("f", "x", "X")], "FEATURE string, ACCESSAVA string, ILTA string")
    got = sorted((tuple(r) for r in explore.map_features(long, m, ["FEATURE", "ACCESSAVA"]).collect()),
                 key=lambda t: str(t))
    assert got == [("f", "x", "X"), ("f", None, "missing")]


def test_fanout_guard(spark):
    m = spark.createDataFrame([("advicepro", " A", "b "), ("advicepro", "a", "B"), ("cab", "a", "b")],
                              "org string, t1 string, t2 string")
    got = [tuple(r) for r in checks.fanout_guard(m, ["t1", "t2"], org="advicepro").collect()]
    assert got == [("a", "b", 2)]


def test_service_type_rules(spark):
    df = spark.createDataFrame([("Advice & Casework (bespoke)",), ("Advice Membership x",), ("Other",), (None,)],
                               "s string")
    got = [r[0] for r in df.select(standardise_service_type("s")).collect()]
    assert got == ["Casework & Advice", "Advice Membership", "Other", None]


def test_lookup_join_keeps_null_keys(spark):
    from carepulse.operators.lookup import lookup_join
    fact = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, None)], "id int, k string")
    lk = spark.createDataFrame([("a", 10), ("c", 30)], "k string, v int")
    got = sorted(tuple(r) for r in lookup_join(fact, lk, "k", "left").select("id", "k", "v").collect())
    assert got == [(1, "a", 10), (2, None, None), (3, "b", None), (4, None, None)]
