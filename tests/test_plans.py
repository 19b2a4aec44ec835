"""Physical plan shape: the properties the design relies on."""

import contextlib
import io
import os
import re

from pyspark.sql import functions as F

from carepulse.operators import checks, windows
from carepulse.operators.lookup import literal_lookup, lookup_join
from carepulse.sources.fixtures import Fixtures


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def nodes(p: str, name: str) -> int:
    """Number of physical operators called ``name`` (detail headers)."""
    return len(re.findall(rf"^\(\d+\) {re.escape(name)}\b", p, flags=re.M))


def _mentions_parquet(spark, path):
    rows = [("LA1" if i % 3 else "LA2", f"2026-0{1 + i % 3}-1{i % 9}", "AccessAva" if i % 2 else "Helplines",
             1 + i % 4, None if i % 5 else "65+", i % 2, None, "Carers") for i in range(300)]
    df = spark.createDataFrame(rows, "LA_NAME string, QUERY_DATE string, SOURCE_SYSTEM string, QUERY_COUNT bigint, "
                                     "AGE_BAND string, HAS_LETTER int, LOCALITY_NAME string, SEGMENT string")
    df.withColumn("QUERY_DATE", F.to_date("QUERY_DATE")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_windows_one_scan_two_exchanges(spark, tmpdir_path):
    m = _mentions_parquet(spark, os.path.join(tmpdir_path, "m"))
    p = plan(windows.query_source(m, "2026-03-31"))
    assert nodes(p, "Scan parquet") == 1
    assert nodes(p, "Exchange") == 2        # partial sums, then the small expanded result
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_grouping_sets_one_scan(spark, tmpdir_path):
    m = _mentions_parquet(spark, os.path.join(tmpdir_path, "m2"))
    p = plan(windows.family_aggregate(m, "2026-03-31"))
    assert nodes(p, "Scan parquet") == 1 and nodes(p, "Expand") == 1 and nodes(p, "Exchange") == 1


def test_lookup_broadcast_only_when_checked(spark):
    fact = spark.range(1000).select(F.col("id"), (F.col("id") % 7).cast("string").alias("k"))
    lk = spark.createDataFrame([(str(i), i) for i in range(7)], "k string, v int")
    assert "BroadcastHashJoin" in plan(lookup_join(fact, literal_lookup(lk), "k", "left"))
    big = plan(lookup_join(fact, lk, "k", "left"))     # nothing known of its size: shuffled, and left to AQE
    assert nodes(big, "BroadcastHashJoin") == 0 and nodes(big, "SortMergeJoin") == 1


def test_lookups_run_no_job_while_planning(spark, small_sf):
    from carepulse.plans.registry import REGISTRY
    Fixtures.forget()
    for key in ("stg_advicepro", "enrich_postcode", "source_freshness"):
        p = plan(REGISTRY[key](spark, small_sf))
        assert "LocalLimit" not in p and "GlobalLimit" not in p


def test_hot_key_of_a_large_lookup(spark):
    """A third of the facts on one key and a third on NULL: the shuffle join keeps every row."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id"))
    fact = spark.range(60_000).select("id", key.cast("long").alias("k"))
    lk = spark.range(40_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = lookup_join(fact, lk, "k", "left").agg(F.count("*"), F.count("v"), F.sum("v")).first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    matched = [i for i in range(60_000) if i % 3 == 1 and i < 40_000]
    assert tuple(got) == (60_000, 20_000 + len(matched), 20_000 * 14 + 2 * sum(matched))


def test_window_dates_reach_the_scan(spark, tmpdir_path):
    m = _mentions_parquet(spark, os.path.join(tmpdir_path, "m3"))
    for df in (windows.query_source(m, "2026-03-31"), windows.family_aggregate(m, "2026-03-31"), windows.query_source(m, "2026-03-31", (3,))):
        pushed = next(line for line in plan(df).splitlines() if "PushedFilters" in line)
        assert "GreaterThanOrEqual(QUERY_DATE" in pushed


def test_reconciled_month_reaches_the_scan(spark, tmpdir_path):
    rows = [("LA1", "2001-03-01", "2001/03", "t", "C1"), ("LA1", "2001-04-01", "2001/04", None, "C2"), ("LA1", "2001-03-31", "2001-03", "t", "C3")]
    df = spark.createDataFrame(rows, "la_name string, d string, case_open_month string, topic_entry_point string, case_reference string")
    df.withColumn("created_at", F.to_date("d")).withColumn("month_date", F.to_date("d")).write.parquet(tmpdir_path + "/r")
    x = spark.read.parquet(tmpdir_path + "/r").withColumn("ut1", F.lit("a")).withColumn("n", F.lit(1))
    bridge = spark.createDataFrame([("C1", "i"), ("C3", None), ("C2", "i")], "case_reference string, s_c_csi_id string")
    for out, column, want in ((checks.recon_helplines_raw(x, "LA1", "2001-03-01"), "month_date", ("a", 2)),
                              (checks.recon_accessava_raw(x, "LA1", "2001-03-01"), "created_at", (2, 2)),
                              (checks.recon_advicepro_raw(x, bridge, "LA1", "2001-03-01"), "case_open_month", (2, 1))):
        assert any("PushedFilters" in line and column in line for line in plan(out).splitlines())
        assert tuple(out.first()) == want


def test_filters_reach_the_scan(spark, small_sf):
    fx = Fixtures(spark, small_sf)
    p = plan(fx.advicepro_casework)
    assert "EqualTo(o_orderstatus,F)" in p
    scan = [line for line in p.splitlines() if line.startswith("ReadSchema") and "o_orderkey" in line][0]
    assert "o_totalprice" not in scan     # column pruning


def _counted(spark, df):
    """``df`` and the number of rows that were made for it so far."""
    made = spark.sparkContext.accumulator(0)
    return spark.createDataFrame(df.rdd.map(lambda r: (made.add(1), tuple(r))[1]), df.schema), made


def test_staged_mentions_are_made_once(spark, small_sf, tmpdir_path, monkeypatch):
    """Finding the ranges of the layout does not run what the mentions are made of again, nor do two readers of the bridge."""
    from carepulse.plans import pipeline, registry
    fx = Fixtures(spark, small_sf)
    staged = {n: _counted(spark, p) for n, p in pipeline.staged_parts(pipeline.Sources.from_fixtures(fx)).items()}
    pipeline.build_models(spark, pipeline.Sources.from_fixtures(fx), tmpdir_path, {n: p for n, (p, _) in staged.items()})
    for name, (p, made) in staged.items():
        n = made.value
        assert n == p.count() > 0, name
    fx.case_topic_bridge, made = _counted(spark, fx.case_topic_bridge)
    monkeypatch.setattr(Fixtures, "of", classmethod(lambda cls, *a: fx))
    rows = registry.REGISTRY["declared_tests"](spark, small_sf).collect()
    n = made.value
    assert rows and n == fx.case_topic_bridge.count() > 0
