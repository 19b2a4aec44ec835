"""Which keys of a load a target has already (A6): a stored Bloom filter, then an exact join on what it lets through.

The filter is a table of blocks of 32,768 bits.  A key belongs to one block and sets ``HASHES`` bits there, so a look-up is
one equi-join on the block, and filters of the same number of blocks merge by OR: an append adds its keys' bits without a
look at the target.  A key whose bits are not all set is new for certain.  The others, known keys and a few in a thousand
new ones, are joined with the target's keys; when there are none the target is not read at all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 32_768
HASHES = 7
BITS_PER_KEY = 16


def blocks_for(n_keys: int) -> int:
    """Blocks of a filter that is to hold ``n_keys``."""
    return max(1, -(-n_keys * BITS_PER_KEY // BITS))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("bigint")


def _places(key: Column) -> list[Column]:
    """The key's bits in its block: an arithmetic sequence with an odd step."""
    first, step = F.pmod(F.xxhash64(key, F.lit(1)), F.lit(BITS)), F.pmod(F.xxhash64(key, F.lit(2)), F.lit(BITS // 2)) * 2 + 1
    return [F.pmod(first + step * i, F.lit(BITS)) for i in range(HASHES)]


def key_filter(rows: DataFrame, key: str, blocks: int) -> DataFrame:
    """(BLOCK, BITS) of the keys of ``rows``; NULL keys are in no filter.  Rows are dealt by block, which a hot key can't
    outgrow, since repeated keys are dropped first."""
    keys = rows.select(F.col(key).cast("string").alias("_k")).filter(F.col("_k").isNotNull()).distinct()
    bits = keys.select(_block(F.col("_k"), blocks).alias("BLOCK"), F.explode(F.array(*_places(F.col("_k")))).alias("_bit"))
    return bits.repartition("BLOCK").groupBy("BLOCK").agg(F.bitmap_construct_agg("_bit").alias("BITS"))


def merge_filters(stored: DataFrame, added: DataFrame) -> DataFrame:
    return stored.unionByName(added).groupBy("BLOCK").agg(F.bitmap_or_agg("BITS").alias("BITS"))


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def with_maybe_known(rows: DataFrame, key: str, stored: DataFrame, blocks: int, name: str = "_MAYBE") -> DataFrame:
    """``rows`` with a flag: false for keys that are in none of the filter's rows for certain (NULL keys too)."""
    k = F.col(key).cast("string")
    found = rows.withColumn("_block", _block(k, blocks)).join(stored.select(F.col("BLOCK").alias("_block"), F.col("BITS").alias("_bits")), "_block", "left")
    every = F.col("_bits").isNotNull()
    for place in _places(k):
        every = every & _is_set(F.col("_bits"), place)
    return found.withColumn(name, F.coalesce(every & k.isNotNull(), F.lit(False))).select(*[rows[c] for c in rows.columns], name)


def new_rows(rows: DataFrame, key: str, stored: DataFrame, blocks: int, target: DataFrame | Callable[[], DataFrame]) -> DataFrame:
    """Rows whose key ``target`` does not have; NULL keys are never known.  A callable target is opened only if it is read.

    The flagged rows are a checkpoint, so the rows are worked out once, and whether any may be known is known before the
    target is scanned."""
    flagged = with_maybe_known(rows, key, stored, blocks).checkpoint()
    sure = flagged.filter(~F.col("_MAYBE")).drop("_MAYBE")
    maybe = flagged.filter("_MAYBE").drop("_MAYBE")
    if maybe.isEmpty():
        return sure
    target = target() if callable(target) else target
    return sure.unionByName(maybe.join(target.select(F.col(key)), key, "left_anti").select(*rows.columns))
