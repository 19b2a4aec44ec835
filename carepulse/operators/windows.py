"""Trailing-window aggregates.

Each family sums QUERY_COUNT over rows with ``QUERY_DATE >= as_of - w months``
(no upper bound, day precision, month-end clamping as ``add_months``) for
every w in (1, 3, 6, 9, 12), grouped by its dimensions.

Instead of five scans glued with UNION ALL, ``trailing_windows`` makes one
pass: windows nest and SUM is distributive, so each row is labelled with the
smallest window that contains it, summed by (dims, label) with map-side
partial aggregation (a hot LA is pre-aggregated in every task before the
shuffle), and only that small result is expanded to all larger windows and
summed again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepulse.functions.columns import suppress_small
from carepulse.operators.staging import SOURCE_ACCESSAVA, UNMAPPED, UNMATCHED

# --- fixed values ------------------------------------------------------------
WINDOWS = (1, 3, 6, 9, 12)
UNKNOWN_AGE = "Unknown"
UNCATEGORISED = "Uncategorised"
# Segments the query-segments family leaves out (three distinct spellings).
EXCLUDED_SEGMENTS = (UNMATCHED, UNMAPPED, "UNMATCHED", UNCATEGORISED)
# -----------------------------------------------------------------------------

WINDOW_COL = "TIME_WINDOW_MONTHS"
#: First day of a mention's month, where mentions are laid out by month (``sources.layout``).
MONTH_COL = "MENTION_MONTH"


def as_date(as_of: str | dt.date | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)).cast("date")


def window_start(as_of: str | dt.date | Column, months: int) -> Column:
    """First day inside a trailing window: as_of minus ``months`` (clamped)."""
    return F.add_months(as_date(as_of), -months)


def since(df: DataFrame, start: Column, date_col: str = "QUERY_DATE") -> DataFrame:
    """Rows from ``start`` on: the bare date column reaches the scan, and the month, where there is one, prunes folders."""
    out = df.filter(F.col(date_col) >= start)
    return out.filter(F.col(MONTH_COL) >= F.trunc(start, "MM")) if MONTH_COL in df.columns else out


def smallest_window(date_col: Column, as_of, windows: Sequence[int] = WINDOWS) -> Column:
    """Smallest w in ``windows`` whose window contains the date, else NULL."""
    out = None
    for w in sorted(windows):
        cond = date_col >= window_start(as_of, w)
        out = F.when(cond, F.lit(w)) if out is None else out.when(cond, F.lit(w))
    return out


def trailing_windows(df: DataFrame, dims: dict[str, Column], measures: dict[str, Column],
                     as_of, windows: Sequence[int] = WINDOWS, date_col: str = "QUERY_DATE") -> DataFrame:
    """All trailing windows of SUM(measures) grouped by dims, in one pass.

    Output: dims..., measures... (BIGINT), TIME_WINDOW_MONTHS (INT).  An empty
    window yields no row (grouped aggregate semantics).
    """
    windows = tuple(sorted(set(int(w) for w in windows)))
    dim_names = list(dims)
    labelled = (since(df, window_start(as_of, windows[-1]), date_col)
                .select(*[c.alias(n) for n, c in dims.items()],
                          *[c.alias(n) for n, c in measures.items()],
                          smallest_window(F.col(date_col), as_of, windows).alias("_min_w"))
                .filter(F.col("_min_w").isNotNull()))
    partial = labelled.groupBy(*dim_names, "_min_w").agg(*[F.sum(n).alias(n) for n in measures])
    if len(windows) == 1:
        return partial.select(*dim_names, *[F.col(n).cast("bigint").alias(n) for n in measures],
                              F.col("_min_w").cast("int").alias(WINDOW_COL))
    ws = F.array(*[F.lit(w) for w in windows])
    expanded = partial.withColumn(WINDOW_COL, F.explode(F.filter(ws, lambda w: w >= F.col("_min_w"))))
    return (expanded.groupBy(*dim_names, WINDOW_COL)
            .agg(*[F.sum(n).cast("bigint").alias(n) for n in measures])
            .select(*dim_names, *measures, F.col(WINDOW_COL).cast("int").alias(WINDOW_COL)))


@dataclass(frozen=True)
class Family:
    """One windowed breakdown: its dimensions, measures and row filters."""
    name: str
    dims: Callable[[], dict[str, Column]]
    measures: Callable[[], dict[str, Column]] = field(
        default=lambda: {"QUERY_COUNT_RAW": F.col("QUERY_COUNT")})
    row_filter: Callable[[], Column] | None = None
    # display column name for each raw measure in the suppressed marts
    display: tuple[tuple[str, str], ...] = (("QUERY_COUNT_RAW", "QUERY_COUNT_DISPLAY"),)


FAMILIES: dict[str, Family] = {
    # Per LA
    "activity_summary": Family("activity_summary", lambda: {"LA_NAME": F.col("LA_NAME")}),
    # Per LA x age band; grouped on the COALESCE expression, so NULL and a
    # literal 'Unknown' land in one group
    "demographics": Family("demographics", lambda: {
        "LA_NAME": F.col("LA_NAME"),
        "AGE_BAND": F.coalesce(F.col("AGE_BAND"), F.lit(UNKNOWN_AGE))}),
    # Chatbot rows only, queries and letters
    "legal_letters": Family(
        "legal_letters", lambda: {"LA_NAME": F.col("LA_NAME")},
        measures=lambda: {"QUERY_COUNT_RAW": F.col("QUERY_COUNT"),
                          "HAS_LETTER_RAW": F.col("HAS_LETTER").cast("bigint")},
        row_filter=lambda: F.col("SOURCE_SYSTEM") == SOURCE_ACCESSAVA,
        display=(("QUERY_COUNT_RAW", "TOTAL_QUERIES_DISPLAY"), ("HAS_LETTER_RAW", "TOTAL_LETTERS_DISPLAY"))),
    # C4: per LA x locality (NULL locality is its own group)
    "locality_overview": Family("locality_overview", lambda: {
        "LA_NAME": F.col("LA_NAME"), "LOCALITY_NAME": F.col("LOCALITY_NAME")}),
    # Per LA x calendar month
    "queries_over_time": Family("queries_over_time", lambda: {
        "LA_NAME": F.col("LA_NAME"), "QUERY_MONTH": F.trunc(F.col("QUERY_DATE"), "MM")}),
    # Per LA x segment, without the unmatched/unmapped buckets
    "query_segments": Family(
        "query_segments", lambda: {
            "LA_NAME": F.col("LA_NAME"),
            "SEGMENT": F.coalesce(F.col("SEGMENT"), F.lit(UNCATEGORISED))},
        row_filter=lambda: ~F.coalesce(F.col("SEGMENT"), F.lit(UNCATEGORISED)).isin(*EXCLUDED_SEGMENTS)),
    # Per LA x source system
    "query_source": Family("query_source", lambda: {
        "LA_NAME": F.col("LA_NAME"), "SOURCE_SYSTEM": F.col("SOURCE_SYSTEM")}),
}


def family_windows(mentions: DataFrame, family: str, as_of,
                   windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Unsuppressed intermediate of one family (``int_*``): all windows."""
    fam = FAMILIES[family]
    df = mentions if fam.row_filter is None else mentions.filter(fam.row_filter())
    return trailing_windows(df, fam.dims(), fam.measures(), as_of, windows)


def family_window(mentions: DataFrame, family: str, as_of, months_back: int,
                  suppress: bool = False) -> DataFrame:
    """The reference macro: one family, one window, raw or suppressed."""
    raw = family_windows(mentions, family, as_of, (months_back,))
    return display(raw, family) if suppress else raw


def display(intermediate: DataFrame, family: str) -> DataFrame:
    """Suppressed projection: dims, *_DISPLAY, TIME_WINDOW_MONTHS (C8 applied)."""
    fam = FAMILIES[family]
    dims = list(fam.dims())
    return intermediate.select(*dims, *[suppress_small(raw).alias(disp) for raw, disp in fam.display],
                               WINDOW_COL)


# Convenience wrappers named after the reference macros (C1-C7) ------------------
def activity_summary(m, as_of, windows=WINDOWS):
    return family_windows(m, "activity_summary", as_of, windows)


def demographics(m, as_of, windows=WINDOWS):
    return family_windows(m, "demographics", as_of, windows)


def legal_letters(m, as_of, windows=WINDOWS):
    return family_windows(m, "legal_letters", as_of, windows)


def locality_overview(m, as_of, windows=WINDOWS):
    return family_windows(m, "locality_overview", as_of, windows)


def queries_over_time(m, as_of, windows=WINDOWS):
    return family_windows(m, "queries_over_time", as_of, windows)


def query_segments(m, as_of, windows=WINDOWS):
    return family_windows(m, "query_segments", as_of, windows)


def query_source(m, as_of, windows=WINDOWS):
    return family_windows(m, "query_source", as_of, windows)


# ---------------------------------------------------------------------------
# All families from one scan (pipeline form)
# ---------------------------------------------------------------------------
SHARED_DIMS = ("LA_NAME", "AGE_BAND", "LOCALITY_NAME", "QUERY_MONTH", "SEGMENT", "SOURCE_SYSTEM")
FAMILY_SETS = {
    "activity_summary": ("LA_NAME",),
    "legal_letters": ("LA_NAME",),
    "demographics": ("LA_NAME", "AGE_BAND"),
    "locality_overview": ("LA_NAME", "LOCALITY_NAME"),
    "queries_over_time": ("LA_NAME", "QUERY_MONTH"),
    "query_segments": ("LA_NAME", "SEGMENT"),
    "query_source": ("LA_NAME", "SOURCE_SYSTEM"),
}


def family_aggregate(mentions: DataFrame, as_of, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Partial sums of every family in one scan: GROUPING SETS over the six
    dimension sets, each with the row's smallest window.

    One Expand feeds one map-side partial aggregate, so the mentions are read
    and shuffled once instead of once per family; ``grouping`` flags tell a
    NULL locality apart from "not grouped by locality".  Chatbot-only
    measures serve the legal-letters family.
    """
    aa = F.col("SOURCE_SYSTEM") == SOURCE_ACCESSAVA
    base = (since(mentions, window_start(as_of, max(windows))).select(
        F.col("LA_NAME"),
        F.coalesce(F.col("AGE_BAND"), F.lit(UNKNOWN_AGE)).alias("AGE_BAND"),
        F.col("LOCALITY_NAME"),
        F.trunc(F.col("QUERY_DATE"), "MM").alias("QUERY_MONTH"),
        F.coalesce(F.col("SEGMENT"), F.lit(UNCATEGORISED)).alias("SEGMENT"),
        F.col("SOURCE_SYSTEM"),
        F.col("QUERY_COUNT").cast("bigint").alias("_q"),
        F.when(aa, F.col("QUERY_COUNT").cast("bigint")).alias("_aa_q"),
        F.when(aa, F.col("HAS_LETTER").cast("bigint")).alias("_aa_l"),
        F.when(aa, F.lit(1)).alias("_aa_n"),
        smallest_window(F.col("QUERY_DATE"), as_of, windows).alias("_min_w"))
        .filter(F.col("_min_w").isNotNull()))
    sets = [list(s) + ["_min_w"] for s in dict.fromkeys(FAMILY_SETS.values())]
    return (base.groupingSets(sets, *SHARED_DIMS, "_min_w")
            .agg(*[F.grouping(c).alias(f"_g_{c}") for c in SHARED_DIMS],
                 F.sum("_q").alias("_q"), F.sum("_aa_q").alias("_aa_q"), F.sum("_aa_l").alias("_aa_l"),
                 F.count("_aa_n").alias("_aa_n")))


def families_from_aggregate(agg: DataFrame, windows: Sequence[int] = WINDOWS) -> dict[str, DataFrame]:
    """Split the shared partial sums into the seven intermediates (small
    data: one row per group and smallest window)."""
    windows = tuple(sorted(set(int(w) for w in windows)))
    ws = F.array(*[F.lit(w) for w in windows])
    out = {}
    for fam, dims in FAMILY_SETS.items():
        mask = None
        for c in SHARED_DIMS:
            cond = F.col(f"_g_{c}") == (0 if c in dims else 1)
            mask = cond if mask is None else mask & cond
        rows = agg.filter(mask)
        if fam == "query_segments":
            rows = rows.filter(~F.col("SEGMENT").isin(*EXCLUDED_SEGMENTS))
        rows = rows.withColumn(WINDOW_COL, F.explode(F.filter(ws, lambda w: w >= F.col("_min_w"))))
        g = rows.groupBy(*dims, WINDOW_COL)
        if fam == "legal_letters":
            df = (g.agg(F.sum("_aa_q").cast("bigint").alias("QUERY_COUNT_RAW"),
                        F.sum("_aa_l").cast("bigint").alias("HAS_LETTER_RAW"),
                        F.sum("_aa_n").alias("_n"))
                  .filter(F.col("_n") > 0)
                  .select(*dims, "QUERY_COUNT_RAW", "HAS_LETTER_RAW", F.col(WINDOW_COL).cast("int").alias(WINDOW_COL)))
        else:
            df = g.agg(F.sum("_q").cast("bigint").alias("QUERY_COUNT_RAW")).select(
                *dims, "QUERY_COUNT_RAW", F.col(WINDOW_COL).cast("int").alias(WINDOW_COL))
        out[fam] = df
    return out
