"""Lookup joins.

Lookup tables (taxonomy maps, postcode directories, value maps) are small in
practice but nothing guarantees it, so a lookup is joined like any other
table: Spark broadcasts it when its size in bytes is below the session's
``autoBroadcastJoinThreshold``, from statistics or, with adaptive execution,
from the bytes its shuffle wrote.  Beyond that it stays a shuffle join whose
hot keys (an unmatched NULL key among them) adaptive execution splits.  No
job runs while a plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def literal_lookup(df: DataFrame) -> DataFrame:
    """A frame whose rows are written in the source, and so bounded: always broadcast."""
    return F.broadcast(df)


def lookup_join(fact: DataFrame, lookup: DataFrame, on: str | Sequence[str] | Column, how: str = "left") -> DataFrame:
    """Join a lookup on to a fact table; for a left join the lookup is the side Spark can broadcast."""
    return fact.join(lookup, on, how)
