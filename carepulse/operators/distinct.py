"""Exact distinct counts that can be merged.

``COUNT(DISTINCT transcript_id)`` of a month says nothing about the year's.  A bitmap over dense keys does: the bits of
32,768 keys are a row for each tenant and month that has one of them, the OR of such rows is the bitmap of several months,
of several loads or of a tenant's whole time, and the sum of set bits is the exact distinct count.  The monthly table is
built once, loads are merged into it, and the totals come from it without another look at the conversations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "CONVERSATION_KEY"
_MONTHLY = ("TENANT_NAME", "CONVERSATION_MONTH", "BUCKET")
#: Rows without an id are counted, but no conversation; they are dealt to so many buckets of their own.
_NO_ID = 1024


def conversation_bitmaps(accessava: DataFrame, keys: DataFrame, id_col: str = "transcript_id") -> DataFrame:
    """Per tenant, month and bucket of keys: the bitmap of its conversations, their rows, first and last date.

    ``keys`` (``CONVERSATION_KEY``, id) are dense (``chatbot.dense_keys``).  Rows are dealt by bucket, all of the same
    size whatever the tenant, and aggregated there: no task holds bitmaps of buckets that are not its own."""
    x = (accessava.filter(F.col("tenant_name").isNotNull()).select(F.col("tenant_name").alias("TENANT_NAME"), "created_at", id_col)
         .join(keys, id_col, "left"))
    none = -1 - F.pmod(F.xxhash64("TENANT_NAME", "created_at"), F.lit(_NO_ID))
    x = x.select("TENANT_NAME", F.trunc("created_at", "MM").alias("CONVERSATION_MONTH"), "created_at", F.coalesce(F.bitmap_bucket_number(KEY), none).alias("BUCKET"), F.bitmap_bit_position(KEY).alias("_bit"))
    return x.repartition("BUCKET").groupBy(*_MONTHLY).agg(
        F.bitmap_construct_agg("_bit").alias("BITMAP"), F.count(F.lit(1)).alias("CONVERSATION_COUNT"),
        F.min("created_at").alias("FIRST_CONVERSATION_DATE"), F.max("created_at").alias("LAST_CONVERSATION_DATE"))


def _merged(bitmaps: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return bitmaps.repartition("BUCKET").groupBy(*keys).agg(
        F.bitmap_or_agg("BITMAP").alias("BITMAP"), F.sum("CONVERSATION_COUNT").alias("CONVERSATION_COUNT"),
        F.min("FIRST_CONVERSATION_DATE").alias("FIRST_CONVERSATION_DATE"), F.max("LAST_CONVERSATION_DATE").alias("LAST_CONVERSATION_DATE"))


def merge_bitmaps(stored: DataFrame, loaded: DataFrame) -> DataFrame:
    """The monthly bitmaps of both; a conversation that both have is one."""
    return _merged(stored.unionByName(loaded), _MONTHLY)


def _counted(bitmaps: DataFrame, keys: tuple[str, ...], count: str) -> DataFrame:
    return bitmaps.groupBy(*keys).agg(
        F.sum("CONVERSATION_COUNT").alias(count), F.sum(F.bitmap_count("BITMAP")).alias("UNIQUE_CONVERSATIONS"),
        F.min("FIRST_CONVERSATION_DATE").alias("FIRST_CONVERSATION_DATE"), F.max("LAST_CONVERSATION_DATE").alias("LAST_CONVERSATION_DATE"))


def monthly_from_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """As ``chatbot.conversations_monthly``."""
    return _counted(bitmaps, ("TENANT_NAME", "CONVERSATION_MONTH"), "CONVERSATION_COUNT")


def total_from_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """As ``chatbot.conversations_total``: the months' bitmaps of a bucket are merged before they are counted."""
    out = _counted(_merged(bitmaps, ("TENANT_NAME", "BUCKET")), ("TENANT_NAME",), "TOTAL_CONVERSATIONS")
    return out.withColumn("DAYS_ACTIVE", F.datediff("LAST_CONVERSATION_DATE", "FIRST_CONVERSATION_DATE"))
