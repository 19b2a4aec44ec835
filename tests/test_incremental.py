"""Windows kept up to date by adding and subtracting days, and the layout that prunes them."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from test_plans import plan

from carepulse.operators import incremental as inc
from carepulse.operators import windows
from carepulse.sources import layout, versioned

SCHEMA = "LA_NAME string, QUERY_DATE date, SOURCE_SYSTEM string, QUERY_COUNT bigint, SEGMENT string, UT2 string, AGE_BAND string, HAS_LETTER int, LOCALITY_NAME string"


def mentions(spark, seed, n, first, last):
    rnd, days = random.Random(seed), (last - first).days
    rows = [(rnd.choice(["A", "A", "A", "B", "C"]), first + dt.timedelta(rnd.randint(0, days)) if rnd.random() > 0.02 else None, rnd.choice(["AccessAva", "AdvicePro", "Helplines"]), rnd.randint(1, 4),
             rnd.choice(["Carers", None, "Unmatched", "Charging"]), None, rnd.choice([None, "65+", "Unknown"]), rnd.randint(0, 1), rnd.choice([None, "L1", "L2"])) for _ in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_updates_equal_a_rebuild(spark, tmpdir_path):
    """Three loads at three dates, late rows among them; the month's end clamps on the way."""
    dates = ["2026-02-28", "2026-03-31", "2026-05-30"]
    loads = [mentions(spark, i, 500, dt.date(2024, 12, 1), dt.date.fromisoformat(d)) for i, d in enumerate(dates)]
    loads[2] = loads[2].unionByName(mentions(spark, 9, 40, dt.date(2026, 5, 1), dt.date(2026, 6, 30)))   # dates to come are inside every window
    days = versioned.publish(inc.daily_sums(loads[0]), tmpdir_path + "/days", [windows.MONTH_COL])
    totals = inc.window_totals(days, dates[0])
    for i in (1, 2):
        new = inc.daily_sums(loads[i])
        totals = versioned.publish(inc.advance(totals, days, new, dates[i - 1], dates[i]), f"{tmpdir_path}/totals{i}")
        days = versioned.publish(inc.add_days(days, new), tmpdir_path + "/days", [windows.MONTH_COL])
    everything = loads[0].unionByName(loads[1]).unionByName(loads[2])
    for family, got in inc.families(totals).items():
        assert rows(got) == rows(windows.family_windows(everything, family, dates[2])), family
    assert rows(totals) == rows(inc.window_totals(inc.daily_sums(everything), dates[2]).select(totals.columns))


def test_mentions_can_be_taken_back(spark):
    first = mentions(spark, 3, 200, dt.date(2026, 1, 1), dt.date(2026, 3, 1))
    gone = first.filter("LA_NAME = 'B'")
    back = inc.daily_sums(gone)
    back = back.select(*[(-F.col(c)).alias(c) if c in ("_n", "_q", "_aa_n", "_aa_q", "_aa_l") else F.col(c) for c in back.columns])
    days = inc.daily_sums(first)
    totals = inc.advance(inc.window_totals(days, "2026-03-01"), days, back, "2026-03-01", "2026-03-01").checkpoint()
    for family, got in inc.families(totals).items():
        assert rows(got) == rows(windows.family_windows(first.filter("LA_NAME != 'B'"), family, "2026-03-01")), family


def test_time_does_not_run_back(spark):
    days = inc.daily_sums(mentions(spark, 1, 5, dt.date(2026, 1, 1), dt.date(2026, 2, 1)))
    with pytest.raises(ValueError, match="moved back"):
        inc.advance(inc.window_totals(days, "2026-02-01"), days, days, "2026-02-01", "2026-01-31")


def partition_filters(p):
    return [line for line in p.splitlines() if line.startswith("PartitionFilters")]


def test_windows_open_the_folders_of_their_months_only(spark, tmpdir_path):
    m = mentions(spark, 4, 900, dt.date(2023, 1, 1), dt.date(2026, 3, 31))
    laid = versioned.publish(layout.by_month(m), tmpdir_path + "/m", [windows.MONTH_COL])
    assert rows(laid.drop(windows.MONTH_COL)) == rows(m)
    for df in (windows.query_source(laid, "2026-03-31"), windows.family_aggregate(laid, "2026-03-31"), windows.query_source(laid, "2026-03-31", (3,))):
        assert any(f"{windows.MONTH_COL}" in line and ">=" in line for line in partition_filters(plan(df)))
    recent = windows.since(laid, windows.window_start("2026-03-31", 1))
    months = {f.split(f"{windows.MONTH_COL}=")[1][:7] for f in recent.select("*", F.input_file_name().alias("f")).agg(F.collect_set("f")).head()[0]}
    assert months <= {"2026-02", "2026-03"}
    for family in windows.FAMILIES:
        assert rows(windows.family_windows(laid, family, "2026-03-31")) == rows(windows.family_windows(m, family, "2026-03-31"))


def test_leaving_days_are_read_from_their_months_only(spark, tmpdir_path):
    days = versioned.publish(inc.daily_sums(mentions(spark, 5, 300, dt.date(2025, 1, 1), dt.date(2026, 3, 1))), tmpdir_path + "/d", [windows.MONTH_COL])
    p = plan(inc.advance(inc.window_totals(days, "2026-03-01"), days, days.limit(0), "2026-03-01", "2026-03-02"))
    assert sum(">=" in line and "<=" in line for line in partition_filters(p)) == len(windows.WINDOWS)


def test_hot_area_is_several_files(spark, tmpdir_path):
    """A third of all rows in one area and month are dealt to more than one task."""
    one = spark.range(0, 30_000, 1, 12).select(F.lit("A").alias("LA_NAME"), F.lit("2026-01-05").cast("date").alias("QUERY_DATE"))
    out = layout.by_month(one.unionByName(spark.range(0, 60_000, 1, 4).select(F.concat(F.lit("X"), F.col("id") % 50).alias("LA_NAME"), F.date_add(F.lit("2025-06-01").cast("date"), (F.col("id") % 200).cast("int")).alias("QUERY_DATE"))))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per = out.filter("LA_NAME = 'A'").groupBy(F.spark_partition_id()).count().collect()
        out.write.partitionBy(windows.MONTH_COL).parquet(tmpdir_path + "/hot")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(per) > 1
    files = sum(len([f for f in fs if f.endswith(".parquet")]) for _, _, fs in os.walk(tmpdir_path + "/hot"))
    assert files < 40
