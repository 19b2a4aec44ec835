"""Data tests, drift monitor and reconciliation.

Each generic test has two forms: ``*_failures`` returns the failing rows
(what a warehouse test query returns; 0 rows = pass) and the summary
functions return one row per declared test with its failure count, so a
whole suite is a handful of scans instead of one scan per test.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from carepulse.operators.staging import UNMAPPED

# --- fixed values ------------------------------------------------------------
UNMAPPED_SHARE_LIMIT = "0.02"   # warn when a source's unmapped share exceeds 2 %
# -----------------------------------------------------------------------------

SUMMARY_COLS = ("MODEL", "TEST_NAME", "COLUMN_NAME", "SEVERITY", "FAILURES")


def summary_columns(model: str, test: str, column: str, severity: str, failures: Column) -> list[Column]:
    return [F.lit(model).alias("MODEL"), F.lit(test).alias("TEST_NAME"), F.lit(column).alias("COLUMN_NAME"),
            F.lit(severity).alias("SEVERITY"), failures.cast("bigint").alias("FAILURES")]


# T1 ---------------------------------------------------------------------------
def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def not_null_summary(df: DataFrame, model: str, columns: Sequence[str], severity: str = "error") -> DataFrame:
    """All not_null tests of one model in a single aggregate, one row each."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_f{i}") for i, c in enumerate(columns)])
    rows = [F.struct(*summary_columns(model, "not_null", c, severity, F.col(f"_f{i}"))) for i, c in enumerate(columns)]
    return agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# T2 ---------------------------------------------------------------------------
def accepted_values_failures(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """One row per value outside the list with its row count; NULL passes."""
    return (df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
            .groupBy(F.col(column).alias("VALUE")).agg(F.count(F.lit(1)).alias("N_RECORDS")))


def accepted_values_summary(df: DataFrame, model: str, column: str, values: Sequence[str],
                            severity: str = "error") -> DataFrame:
    f = accepted_values_failures(df, column, values)
    return f.agg(*summary_columns(model, "accepted_values", column, severity, F.count(F.lit(1))))


# T3 ---------------------------------------------------------------------------
def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values seen more than once, with their counts."""
    return (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("VALUE"))
            .agg(F.count(F.lit(1)).alias("N_RECORDS")).filter(F.col("N_RECORDS") > 1))


def unique_summary(df: DataFrame, model: str, column: str, severity: str = "error") -> DataFrame:
    return unique_failures(df, column).agg(*summary_columns(model, "unique", column, severity, F.count(F.lit(1))))


# T4 ---------------------------------------------------------------------------
def unique_combination_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("N_RECORDS"))
            .filter(F.col("N_RECORDS") > 1))


def unique_combination_summary(df: DataFrame, model: str, columns: Sequence[str],
                               severity: str = "error") -> DataFrame:
    f = unique_combination_failures(df, columns)
    return f.agg(*summary_columns(model, "unique_combination_of_columns", ",".join(columns), severity,
                           F.count(F.lit(1))))


# T5 ---------------------------------------------------------------------------
def relationships_failures(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (anti join on the key)."""
    keys = parent.select(F.col(parent_column).alias("_parent_key")).distinct()
    return (child.filter(F.col(column).isNotNull())
            .join(keys, F.col(column) == F.col("_parent_key"), "left_anti"))


def relationships_summary(child: DataFrame, model: str, column: str, parent: DataFrame, parent_column: str,
                          severity: str = "warn") -> DataFrame:
    """Children are counted by key first, so the join sees each key once and a hot key is one row."""
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    orphans = keys.join(parent.select(F.col(parent_column).alias("_parent_key")), F.col(column) == F.col("_parent_key"), "left_anti")
    return orphans.agg(*summary_columns(model, "relationships", column, severity, F.coalesce(F.sum("_n"), F.lit(0))))


# T1, T2 on the write ------------------------------------------------------------
@dataclass(frozen=True)
class ColumnTest:
    """A declared test that each row passes or fails on its own: ``not_null``, or ``accepted_values`` with its list."""
    model: str
    test: str
    column: str
    values: tuple[str, ...] = ()
    severity: str = "error"

    def failing(self) -> Column:
        c = F.col(self.column)
        return c.isNull() if self.test == "not_null" else c.isNotNull() & ~c.isin(list(self.values))


def not_nulls(model: str, columns: Sequence[str], severity: str = "error") -> list[ColumnTest]:
    return [ColumnTest(model, "not_null", c, (), severity) for c in columns]


def observe_tests(df: DataFrame, tests: Sequence[ColumnTest], rows: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """``df`` counting the tests' failures while it is written, without a scan of its own.

    ``rows`` narrows a model's tests to some rows (parts that are written as one table).  Failures are rows for
    ``not_null`` and distinct values for ``accepted_values`` (estimated: exact while they are few, and 0 only if there is
    none), as in the summaries above.  Put it behind the last exchange: a stage below one can be run again, or first for
    a sample, and its rows would be counted again.
    """
    rows, metrics = rows or {}, []
    for i, t in enumerate(tests):
        bad = t.failing() & rows[t.model] if t.model in rows else t.failing()
        metrics.append((F.count_if(bad) if t.test == "not_null" else F.approx_count_distinct(F.when(bad, F.col(t.column)), 0.01)).alias(f"t{i}"))
    observation = Observation(f"tests_{uuid.uuid4().hex}")
    return df.observe(observation, *metrics), observation


def observed_results(tests: Sequence[ColumnTest], observation: Observation) -> list[tuple]:
    """Summary rows (``SUMMARY_COLS``) of tests whose table has been written; a row per declared test."""
    found = observation.get
    return [(t.model, t.test, t.column, t.severity, int(found[f"t{i}"] or 0)) for i, t in enumerate(tests)]


SUMMARY_SCHEMA = "MODEL string, TEST_NAME string, COLUMN_NAME string, SEVERITY string, FAILURES bigint"


def union_summaries(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass(frozen=True)
class TestResult:
    """Interpretation of a summary row: pass / warn / fail."""
    severity: str
    failures: int

    @property
    def status(self) -> str:
        if self.failures == 0:
            return "pass"
        return "warn" if self.severity == "warn" else "fail"


def with_status(summary: DataFrame) -> DataFrame:
    return summary.withColumn(
        "STATUS", F.when(F.col("FAILURES") == 0, "pass").when(F.col("SEVERITY") == "warn", "warn").otherwise("fail"))


# T6 ---------------------------------------------------------------------------
def unmapped_share(monthly: DataFrame, limit: str = UNMAPPED_SHARE_LIMIT, only_failing: bool = True) -> DataFrame:
    """Per source: unmapped count, total, percentage rounded to 2 places.

    Division is exact decimal (scale 6, half-up) as in the warehouse, so the
    2 % edge is decided the same way; NULLIF guards against zero totals.
    """
    shares = (monthly.groupBy(F.col("SOURCE_SYSTEM"))
              .agg(F.sum(F.when(F.col("UT1") == UNMAPPED, F.col("QUERY_COUNT")).otherwise(0))
                   .cast("bigint").alias("UNMAPPED_COUNT"),
                   F.sum("QUERY_COUNT").cast("bigint").alias("TOTAL_COUNT")))
    share = (F.col("UNMAPPED_COUNT").cast("decimal(38,0)")
             / F.nullif(F.col("TOTAL_COUNT").cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")))
    out = shares.select("SOURCE_SYSTEM", "UNMAPPED_COUNT", "TOTAL_COUNT",
                        F.round(share * 100, 2).cast("decimal(38,2)").alias("UNMAPPED_PCT"),
                        share.alias("_share"))
    if only_failing:
        out = out.filter((F.col("TOTAL_COUNT") > 0) & (F.col("_share") > F.lit(limit).cast("decimal(38,6)")))
    return out.drop("_share")


# T7-T10 -----------------------------------------------------------------------
def recon_model_breakdown(monthly: DataFrame, la: str, month: str, ordered: bool = False) -> DataFrame:
    out = (monthly.filter((F.col("LA_NAME") == la) & (F.col("MONTH_DATE") == F.lit(month).cast("date")))
           .groupBy("SOURCE_SYSTEM", "UT1", "UT2").agg(F.sum("QUERY_COUNT").cast("bigint").alias("N")))
    return out.orderBy(F.col("SOURCE_SYSTEM").asc_nulls_last(), F.col("N").desc_nulls_first()) if ordered else out


def _in_month(column: str, month: str) -> Column:
    """Half-open range on the bare column, which reaches the scan."""
    first = F.lit(month).cast("date")
    return (F.col(column) >= first) & (F.col(column) < F.add_months(first, 1))


def recon_helplines_raw(helplines: DataFrame, la: str, month: str) -> DataFrame:
    return (helplines.filter((F.col("la_name") == la) & _in_month("month_date", month))
            .groupBy(F.col("ut1").alias("UT1")).agg(F.sum("n").cast("bigint").alias("N")))


def recon_accessava_raw(accessava: DataFrame, la: str, month: str) -> DataFrame:
    return (accessava.filter((F.col("la_name") == la) & _in_month("created_at", month))
            .agg(F.count(F.lit(1)).alias("CONVERSATIONS"),
                 F.count("topic_entry_point").alias("WITH_ENTRY_POINT")))


def recon_advicepro_raw(casework: DataFrame, bridge: DataFrame, la: str, month: str) -> DataFrame:
    # the two spellings that parse_open_month reads as this month, so the scan can filter the text
    c = casework.filter((F.col("la_name") == la) & F.col("case_open_month").isin(month[:7].replace("-", "/"), month[:7]))
    x = c.select("case_reference").join(bridge.select("case_reference", "s_c_csi_id"), "case_reference")
    return x.agg(F.count(F.lit(1)).alias("TOPIC_PAIRS"), F.count("s_c_csi_id").alias("RESOLVED_TO_TAXONOMY"))


# T11 --------------------------------------------------------------------------
def fanout_guard(lookup: DataFrame, key_cols: Sequence[str], org: str | None = None) -> DataFrame:
    """Lookup keys that collide after lower/trim (each would multiply rows)."""
    if org is not None:
        lookup = lookup.filter(F.col("org") == org)
    keys = [F.lower(F.trim(F.col(c))).alias(f"K{i + 1}") for i, c in enumerate(key_cols)]
    return (lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("N")).filter(F.col("N") > 1))


def recon_slices(accessava: DataFrame, casework: DataFrame, bridge: DataFrame, helplines: DataFrame, la: str, month: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The rows of one area and month of each source as checkpoints, so that the model and the raw side of a reconciliation
    read each source once between them.  A case's topics are those of the cases that are left."""
    spelled = F.col("case_open_month").isin(month[:7].replace("-", "/"), month[:7])

    def of_cases():
        cases = casework.filter((F.col("la_name") == la) & spelled).checkpoint()
        return cases, bridge.join(cases.select("case_reference").distinct(), "case_reference", "left_semi").checkpoint()

    parts = (lambda: accessava.filter((F.col("la_name") == la) & _in_month("created_at", month)).checkpoint(), of_cases,
             lambda: helplines.filter((F.col("la_name") == la) & _in_month("month_date", month)).checkpoint())
    with ThreadPoolExecutor(len(parts)) as pool:   # the sources have nothing to wait for in each other
        ava, (cases, topics), help_ = pool.map(inheritable_thread_target(accessava.sparkSession)(lambda part: part()), parts)
    return ava, cases, topics, help_


# T12 --------------------------------------------------------------------------
def recon_totals(model_totals: DataFrame, raw_totals: DataFrame) -> DataFrame:
    """Full outer join of per-source totals; DIFF = model - raw."""
    m = model_totals.select("SOURCE_SYSTEM", F.col("TOTAL").alias("MODEL_TOTAL"))
    r = raw_totals.select("SOURCE_SYSTEM", F.col("TOTAL").alias("RAW_TOTAL"))
    j = m.join(r, "SOURCE_SYSTEM", "full_outer")
    return j.withColumn("DIFF", F.coalesce("MODEL_TOTAL", F.lit(0)) - F.coalesce("RAW_TOTAL", F.lit(0)))


# T13 --------------------------------------------------------------------------
def window_row_counts(intermediate: DataFrame) -> DataFrame:
    return intermediate.groupBy("TIME_WINDOW_MONTHS").agg(F.count(F.lit(1)).alias("N_ROWS"))


# T14 --------------------------------------------------------------------------
def source_coverage(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("SOURCE_SYSTEM").agg(F.count(F.lit(1)).alias("N_ROWS"),
                                                 F.max("QUERY_DATE").alias("LATEST_DATE"))
