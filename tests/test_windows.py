"""W1 (single-pass trailing windows) against the literal five-branch union."""

import datetime as dt
import random

from pyspark.sql import functions as F

from carepulse.operators import marts, windows


def _mentions(spark, n=400, seed=7):
    rnd = random.Random(seed)
    base = dt.date(2025, 1, 1)
    rows = []
    for _ in range(n):
        d = base + dt.timedelta(days=rnd.randint(0, 500))
        rows.append((rnd.choice(["LA1", "LA2"]), d, rnd.choice(["AccessAva", "AdvicePro", "Helplines"]),
                     rnd.randint(1, 9), rnd.choice([None, "Unknown", "18-24"]), rnd.randint(0, 1)))
    return spark.createDataFrame(rows, "LA_NAME string, QUERY_DATE date, SOURCE_SYSTEM string, QUERY_COUNT bigint, "
                                       "AGE_BAND string, HAS_LETTER int")


def test_single_pass_equals_union(spark):
    m = _mentions(spark)
    as_of = "2026-03-31"
    got = windows.query_source(m, as_of)
    parts = []
    for w in windows.WINDOWS:
        parts.append(m.filter(F.col("QUERY_DATE") >= F.add_months(F.lit(as_of).cast("date"), -w))
                     .groupBy("LA_NAME", "SOURCE_SYSTEM").agg(F.sum("QUERY_COUNT").alias("QUERY_COUNT_RAW"))
                     .withColumn("TIME_WINDOW_MONTHS", F.lit(w)))
    ref = parts[0]
    for p in parts[1:]:
        ref = ref.unionByName(p)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.select(*got.columns).collect()))


def test_windows_monotone_and_totals(spark):
    m = _mentions(spark, seed=11)
    act = {(r.LA_NAME, r.TIME_WINDOW_MONTHS): r.QUERY_COUNT_RAW
           for r in windows.activity_summary(m, "2026-03-31").collect()}
    for la in ("LA1", "LA2"):
        vals = [act.get((la, w), 0) for w in windows.WINDOWS]
        assert vals == sorted(vals)
    src = windows.query_source(m, "2026-03-31").groupBy("LA_NAME", "TIME_WINDOW_MONTHS").agg(
        F.sum("QUERY_COUNT_RAW").alias("t")).collect()
    assert {(r.LA_NAME, r.TIME_WINDOW_MONTHS): r.t for r in src} == act


def test_mart_from_intermediate_equals_direct(spark):
    m = _mentions(spark, seed=3)
    inter = windows.family_windows(m, "legal_letters", "2026-03-31")
    for w in windows.WINDOWS:
        a = sorted(map(tuple, marts.mart(None, "legal_letters", w, intermediate=inter).collect()))
        b = sorted(map(tuple, marts.mart(m, "legal_letters", w, "2026-03-31").collect()))
        assert a == b


def test_empty_window_gives_no_row(spark):
    m = _mentions(spark).filter(F.col("QUERY_DATE") < F.lit("2025-06-01").cast("date"))
    assert windows.activity_summary(m, "2026-03-31", (1, 3)).count() == 0


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=15, deadline=None)
@given(st.dates(min_value=dt.date(2024, 1, 1), max_value=dt.date(2026, 12, 31)),
       st.lists(st.tuples(st.integers(0, 900), st.integers(1, 5)), min_size=1, max_size=40))
def test_windows_property(spark, as_of, rows):
    base = dt.date(2023, 6, 1)
    data = [("LA", base + dt.timedelta(days=d), n) for d, n in rows]
    m = spark.createDataFrame(data, "LA_NAME string, QUERY_DATE date, QUERY_COUNT bigint")
    got = {r.TIME_WINDOW_MONTHS: r.QUERY_COUNT_RAW for r in windows.activity_summary(m, as_of.isoformat()).collect()}

    def minus_months(d, k):
        y, mth = divmod(d.year * 12 + d.month - 1 - k, 12)
        mth += 1
        import calendar
        return dt.date(y, mth, min(d.day, calendar.monthrange(y, mth)[1]))
    ref = {}
    for w in windows.WINDOWS:
        s = sum(n for _, d, n in data if d >= minus_months(as_of, w))
        if s:
            ref[w] = s
    assert got == ref


def test_shared_aggregate_equals_per_family(spark):
    m = _mentions(spark, n=600, seed=5)
    m = m.withColumn("SEGMENT", F.element_at(F.array(F.lit("Unmapped"), F.lit("Carers"), F.lit(None).cast("string"),
                                                     F.lit("Charging")), (F.col("QUERY_COUNT") % 4 + 1).cast("int")))
    m = m.withColumn("LOCALITY_NAME", F.when(F.col("QUERY_COUNT") % 3 == 0, F.lit(None).cast("string"))
                     .otherwise(F.lit("North")))
    shared = windows.families_from_aggregate(windows.family_aggregate(m, "2026-03-31"))
    for fam in windows.FAMILIES:
        ref = windows.family_windows(m, fam, "2026-03-31")
        got = shared[fam].select(*ref.columns)
        key = lambda t: tuple(str(x) for x in t)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, ref.collect()), key=key), fam
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in ref.schema], fam
