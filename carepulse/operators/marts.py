"""Marts (C9-C16): one suppressed slice per family and window, plus the
all-LA, all-time summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.operators.windows import FAMILIES, WINDOW_COL, WINDOWS, display, family_windows

MART_FAMILIES = tuple(FAMILIES)


def mart(mentions: DataFrame | None, family: str, months_back: int, as_of=None,
         intermediate: DataFrame | None = None) -> DataFrame:
    """``mart_<family>_<w>m``: dims, suppressed counts, TIME_WINDOW_MONTHS = w.

    With a precomputed intermediate (the pipeline writes all windows once)
    this is a partition-prunable filter; without one only window ``w`` is
    computed, which is a single filtered aggregate.
    """
    if months_back not in WINDOWS:
        raise ValueError(f"window must be one of {WINDOWS}")
    if intermediate is None:
        intermediate = family_windows(mentions, family, as_of, (months_back,))
    sliced = intermediate.filter(F.col(WINDOW_COL) == months_back)
    return display(sliced, family)


def la_query_summary(mentions: DataFrame) -> DataFrame:
    """LA x source x segment, all LAs, all time, unsuppressed."""
    return (mentions.groupBy("LA_NAME", "SOURCE_SYSTEM", "SEGMENT")
            .agg(F.sum("QUERY_COUNT").cast("bigint").alias("QUERY_COUNT")))
