"""Trailing windows kept up to date by adding and subtracting days.

A full rebuild reads twelve months of mentions every day.  Here a load adds its mentions' sums by day
(``daily_sums``: one row for each group and day) and the windows' totals move by what enters and what leaves:

    total at the new date = total at the old date + loaded rows inside the new window - days that dropped out of it

A window has no upper end, so only loaded rows enter; what leaves is the few days between its old and its new first day,
read from the stored day sums, whose months prune.  Totals carry the number of mentions, so a group whose last mention
left the window disappears, as in a rebuild.  All sums are of whole numbers: a chain of updates equals a rebuild.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepulse.operators import windows as w
from carepulse.operators.staging import SOURCE_ACCESSAVA

_DIMS = w.SHARED_DIMS
_FLAGS = tuple(f"_g_{c}" for c in _DIMS)
#: Mentions, their counts, and both of the chatbot's mentions with their letters.
_SUMS = ("_n", "_q", "_aa_n", "_aa_q", "_aa_l")
GROUP = (*_FLAGS, *_DIMS)
DAY = "QUERY_DATE"


def daily_sums(mentions: DataFrame) -> DataFrame:
    """Sums of every family's groups by day, from one scan: GROUPING SETS over the dimension sets, each with the day.

    ``MENTION_MONTH`` is kept to lay the table out by month.  Mentions without a date are in no window."""
    ava = F.col("SOURCE_SYSTEM") == SOURCE_ACCESSAVA
    base = mentions.filter(F.col(DAY).isNotNull()).select(
        "LA_NAME", F.coalesce("AGE_BAND", F.lit(w.UNKNOWN_AGE)).alias("AGE_BAND"), "LOCALITY_NAME",
        F.trunc(DAY, "MM").alias("QUERY_MONTH"), F.coalesce("SEGMENT", F.lit(w.UNCATEGORISED)).alias("SEGMENT"), "SOURCE_SYSTEM", F.col(DAY).cast("date").alias(DAY),
        F.lit(1).cast("bigint").alias("_n"), F.coalesce(F.col("QUERY_COUNT").cast("bigint"), F.lit(0)).alias("_q"),
        F.when(ava, 1).otherwise(0).cast("bigint").alias("_aa_n"), F.when(ava, F.coalesce("QUERY_COUNT", F.lit(0))).otherwise(0).cast("bigint").alias("_aa_q"),
        F.when(ava, F.coalesce("HAS_LETTER", F.lit(0))).otherwise(0).cast("bigint").alias("_aa_l"))
    sets = [[*s, DAY] for s in dict.fromkeys(w.FAMILY_SETS.values())]
    out = base.groupingSets(sets, *_DIMS, DAY).agg(*[F.grouping(c).alias(f) for c, f in zip(_DIMS, _FLAGS, strict=True)], *[F.sum(s).alias(s) for s in _SUMS])
    return out.select(*GROUP, DAY, *_SUMS, F.trunc(DAY, "MM").alias(w.MONTH_COL))


def add_days(stored: DataFrame, loaded: DataFrame) -> DataFrame:
    """Day sums of both; a day that both have is one row."""
    return _sum(stored.unionByName(loaded), [*GROUP, DAY, w.MONTH_COL])


def recent(days: DataFrame, as_of: str | dt.date, months: Sequence[int] = w.WINDOWS) -> DataFrame:
    """Days that a window at ``as_of`` or later can still lose."""
    return w.since(days, w.window_start(as_of, max(months)), DAY)


def _sum(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in _SUMS]).filter(F.col("_n") != 0)


def _between(days: DataFrame, start: Column, end: Column | None) -> DataFrame:
    out = w.since(days, start, DAY)
    if end is None:
        return out
    out = out.filter(F.col(DAY) < end)
    return out.filter(F.col(w.MONTH_COL) <= F.trunc(end, "MM")) if w.MONTH_COL in days.columns else out


def _signed(days: DataFrame, months: int, sign: int) -> DataFrame:
    return days.select(*GROUP, F.lit(months).cast("int").alias(w.WINDOW_COL), *[(F.col(s) * sign).alias(s) for s in _SUMS])


def window_totals(days: DataFrame, as_of: str | dt.date, months: Sequence[int] = w.WINDOWS) -> DataFrame:
    """Totals of every window from the day sums: the state that ``advance`` moves on."""
    parts = w.since(days, w.window_start(as_of, max(months)), DAY).withColumn("_min", w.smallest_window(F.col(DAY), as_of, months))
    inside = F.explode(F.filter(F.array(*[F.lit(m) for m in sorted(months)]), lambda m: m >= F.col("_min")))
    return _sum(_sum(parts, [*GROUP, "_min"]).withColumn(w.WINDOW_COL, inside), [*GROUP, w.WINDOW_COL])


def advance(totals: DataFrame, stored: DataFrame, loaded: DataFrame, old_as_of: str | dt.date, new_as_of: str | dt.date,
            months: Sequence[int] = w.WINDOWS) -> DataFrame:
    """Totals at ``new_as_of`` from those at ``old_as_of``, the day sums they were made of and those of a load since.

    A load may hold any days, long past ones too; sums with negative counts take mentions back.  Time only moves on."""
    if dt.date.fromisoformat(str(new_as_of)) < dt.date.fromisoformat(str(old_as_of)):
        raise ValueError(f"windows at {old_as_of} can't be moved back to {new_as_of}")
    moves = [totals.select(*GROUP, w.WINDOW_COL, *_SUMS)]
    for m in months:
        old, new = w.window_start(old_as_of, m), w.window_start(new_as_of, m)
        moves.append(_signed(_between(loaded, new, None), m, 1))
        if str(old_as_of) != str(new_as_of):
            moves.append(_signed(_between(stored, old, new), m, -1))
    return _sum(functools.reduce(DataFrame.unionByName, moves), [*GROUP, w.WINDOW_COL])


def families(totals: DataFrame) -> dict[str, DataFrame]:
    """The seven intermediates (``int_*``) from the totals."""
    out = {}
    for family, dims in w.FAMILY_SETS.items():
        rows = totals.filter(functools.reduce(Column.__and__, [F.col(f) == (0 if c in dims else 1) for c, f in zip(_DIMS, _FLAGS, strict=True)]))
        count, letters = F.col("_q").alias("QUERY_COUNT_RAW"), []
        if family == "query_segments":
            rows = rows.filter(~F.col("SEGMENT").isin(*w.EXCLUDED_SEGMENTS))
        if family == "legal_letters":
            rows = rows.filter(F.col("_aa_n") > 0)
            count, letters = F.col("_aa_q").alias("QUERY_COUNT_RAW"), [F.col("_aa_l").alias("HAS_LETTER_RAW")]
        out[family] = rows.select(*dims, count, *letters, w.WINDOW_COL)
    return out
