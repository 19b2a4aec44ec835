"""Append-only targets that know their keys (A6, A8): a key filter beside the target, caught up file by file.

``<target>_keys`` is a table that is replaced whole: the blocks of a Bloom filter (``operators.membership``) and the files
whose keys are in it.  A load lists the target, reads the keys of the files that the filter does not have yet (those of the
load before, or of any other writer) and merges them; it then tells new keys from known ones by the filter and reads the
target only where a key may be known.  So the work of a load grows with the load, not with the target.

The filter holds every key of the files it names, whatever died when: rows that were appended without it are in files
that it does not name, and bits of rows that never arrived, or were deleted, only cost a look at the target.  A file is
named by path, length and time of change.  One writer per target at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carepulse.operators import membership
from carepulse.session import ensure_checkpoint_dir
from carepulse.sources import versioned
from carepulse.sources.files import list_files, path_exists

KEYS = "_keys"
SCHEMA = "BLOCKS int, BLOCK bigint, BITS binary, FILE string"
#: Keys that a new filter has room for at least.
ROOM = 1_000_000
#: Share of set bits beyond which the filter lets too many new keys through and is built anew, four times as large.
FULL = 0.5


def _named() -> Column:
    return F.concat_ws("|", "path", "length", F.unix_micros(F.col("modification_time")))


def key_filter_of(spark: SparkSession, target: str, key: str, fmt: str = "parquet", room: int = ROOM) -> tuple[DataFrame, int]:
    """The filter (BLOCK, BITS) of all keys in ``target`` and its number of blocks, after it has caught up."""
    beside = f"{target.rstrip('/')}{KEYS}"
    now = list_files(spark, target, "*").select("path", _named().alias("FILE"))
    if versioned.current_version(spark, beside) is None:
        rows = spark.read.format(fmt).load(target).select(key)
        return _publish(_built(rows, key, membership.blocks_for(max(room, 2 * rows.count()))), now, beside)
    stored = versioned.read_table(spark, beside, SCHEMA)
    bits, blocks = stored.filter("FILE IS NULL").select("BLOCK", "BITS"), stored.head()["BLOCKS"]
    # file names only, of the loads since the last one
    added = [r["path"] for r in now.join(stored.select("FILE"), "FILE", "left_anti").select("path").collect()]
    if not added:
        return bits, blocks
    merged = membership.merge_filters(bits, membership.key_filter(spark.read.format(fmt).load(added).select(key), key, blocks))
    bits, blocks = _publish((merged, blocks), now, beside)
    if (bits.agg(F.sum(F.bitmap_count("BITS"))).head()[0] or 0) <= FULL * blocks * membership.BITS:
        return bits, blocks
    return _publish(_built(spark.read.format(fmt).load(target).select(key), key, 4 * blocks), now, beside)


def _built(rows: DataFrame, key: str, blocks: int) -> tuple[DataFrame, int]:
    return membership.key_filter(rows, key, blocks), blocks


def _publish(made: tuple[DataFrame, int], listed: DataFrame, beside: str) -> tuple[DataFrame, int]:
    bits, blocks = made
    none = F.lit(None)
    rows = bits.select(F.lit(blocks).alias("BLOCKS"), "BLOCK", "BITS", none.cast("string").alias("FILE"))
    rows = rows.unionByName(listed.select(F.lit(blocks).alias("BLOCKS"), none.cast("bigint").alias("BLOCK"), none.cast("binary").alias("BITS"), "FILE"))
    return versioned.publish(rows, beside).filter("FILE IS NULL").select("BLOCK", "BITS"), blocks


def unseen(rows: DataFrame, key: str, target: str, target_key: str | None = None, fmt: str = "parquet", room: int = ROOM) -> DataFrame:
    """Rows whose ``key`` is not in the column ``target_key`` (the same name, if not given) of the target; NULL keys are
    never known.  A target that is not there yet knows none; one that can't be read fails the call."""
    spark, target_key = rows.sparkSession, target_key or key
    if not path_exists(spark, target):
        return rows
    ensure_checkpoint_dir(spark)
    stored, blocks = key_filter_of(spark, target, target_key, fmt, room)
    return membership.new_rows(rows, key, stored, blocks, lambda: spark.read.format(fmt).load(target).select(F.col(target_key).alias(key)))
