"""SimHash near-dedup: segment-popcount embedding, grid range-join, exact check.

A fingerprint's embedding is the vector of bit counts of its 32 two-bit segments.  Manhattan distance between
embeddings is a lower bound of the bit distance, so fingerprints within ``BITS`` bits are within BITS there.  The segments
form ``GROUPS`` groups; two vectors that near agree wholly in at least GROUPS - BITS of them.  Each choice of
that many groups is a grid: its exact counts and the range cells of the other segments' total (width BITS + 1) make the
cell, and pairs in range share one.  Fingerprints alone in all their cells are done.

The exact check emits no pairs.  Two fingerprints differ in at most two bits when some value is within one bit of
both, so each candidate is sent to itself and its 64 one-bit neighbours; those who meet at a value are linked to the smallest
there.  At most 65 distinct fingerprints can meet at a value, so no group is large, whatever the copies.  All links
between different texts are kept as paths, and components are exact.

Work is on distinct fingerprints: copies add one row each in the first and in the last step.

Null or wordless text: fingerprint zero, linked like any other.  A component_id is the smallest doc_id in it (null ids count last).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepulse.llm import common as C
from carepulse.llm.components import connected_components

#: Fixed by the contract: shingle length in words, largest bit distance, seed.
SHINGLE, BITS, SEED = 3, 2, 42
GROUPS = 5


def fingerprints(data: np.ndarray, off: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """Unsigned 64-bit fingerprint of each text."""
    data = C.LOWER[data]
    starts, ends, first = C.words(data, off, C.WORD)
    out = np.zeros(len(off) - 1, np.uint64)
    if not len(starts):
        return out
    # words joined by one space, one text after another
    length = ends - starts
    at = np.cumsum(length + 1) - length - 1
    joined = np.full(int(length.sum()) + len(length), 32, np.uint8)
    inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    joined[np.repeat(at, length) + inside] = data[np.repeat(starts, length) + inside]
    raw = joined.tobytes()
    n_words = np.diff(first)
    n = np.where(n_words > 0, np.maximum(n_words - shingle + 1, 1), 0)
    have = np.flatnonzero(n)
    begin = np.cumsum(n) - n
    word = np.repeat(first[:-1] - begin, n) + np.arange(int(n.sum()))
    last = np.minimum(word + shingle, np.repeat(first[1:], n)) - 1
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(raw[a:b], SEED) for a, b in zip(at[word].tolist(), (at[last] + length[last]).tolist(), strict=True)], np.uint64)
    ones = np.zeros((len(have), 64), np.int64)
    for a in range(0, len(h), 1 << 14):  # in steps: 64 counters a shingle
        part = np.unpackbits(h[a:a + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        lo = int(np.searchsorted(begin[have], a, "right")) - 1
        hi = int(np.searchsorted(begin[have], a + len(part)))
        ones[lo:hi] += np.add.reduceat(part, np.maximum(begin[have][lo:hi] - a, 0), axis=0, dtype=np.int64)
    bits = (2 * ones > n[have][:, None]).astype(np.uint8)
    out[have] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def embed(fp: Column) -> Column:
    """Counts of the 32 two-bit segments, in two bits each."""
    low = fp.bitwiseAND(F.lit(0x5555555555555555))
    high = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(0x5555555555555555))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def total(counts: Column) -> Column:
    """Sum of packed two-bit counts: the high bits count twice."""
    return F.bit_count(counts) + F.bit_count(counts.bitwiseAND(F.lit(-0x5555555555555556)))


def group_masks(groups: int) -> list[int]:
    """Bits of each group of segments."""
    out = [0] * groups
    for s in range(32):
        out[s * groups // 32] |= 3 << (2 * s)
    return out


def _long(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >= 1 << 63 else x)


def cells(fps: DataFrame, bits: int, groups: int) -> DataFrame:
    """(fp, grid, cell, place): pairs within Manhattan distance ``bits`` share a row's last three values at least once."""
    masks, e = group_masks(groups), embed(F.col("fp"))
    rows = []
    for k, chosen in enumerate(combinations(masks, groups - bits)):
        mask = sum(chosen)
        rest = total(e.bitwiseAND(_long(~mask & (1 << 64) - 1)))
        places = F.array_distinct(F.array(F.floor(rest / (bits + 1)), F.floor((rest + bits) / (bits + 1))))
        rows.append(F.struct(F.lit(k).alias("grid"), e.bitwiseAND(_long(mask)).alias("cell"), places.alias("places")))
    out = fps.select("fp", F.explode(F.array(*rows)).alias("x"))
    return out.select("fp", "x.grid", "x.cell", F.explode("x.places").alias("place"))


def links(fps: DataFrame, bits: int = BITS, groups: int = GROUPS) -> DataFrame:
    """(a, b): pairs of distinct fingerprints within ``bits`` bits or linked over others that are; components are exact."""
    if not 0 < bits <= 2:
        raise ValueError("the exact check is for distances of 1 or 2 bits")
    every = cells(fps, bits, groups)
    shared = every.groupBy("grid", "cell", "place").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo != hi").drop("lo", "hi")
    shared = C.checkpoint_table(shared, "cells")  # so that the join is of two shuffles and a hot cell can be split
    some = every.join(shared, ["grid", "cell", "place"], "left_semi").select("fp").distinct()
    # within 2 bits: a common value within 1 bit; within 1: each other's value with one fixed bit position cleared
    flips = [_long(1 << k) for k in range(64)]
    meet = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(f) for f in flips]) if bits == 2 else F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(_long(~(1 << k) & (1 << 64) - 1)).alias("v")) for k in range(64)])
    met = some.select("fp", F.explode(meet).alias("at")).groupBy("at").agg(F.collect_list("fp").alias("met")).where(F.size("met") > 1)
    return met.select(F.explode("met").alias("a"), F.array_min("met").alias("b")).where("a != b").distinct()


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, carry: list[str] | None = None, root: bool = False) -> DataFrame:
    """Every document with ``fingerprint`` (16 hex digits) and ``component_id``, after the columns in ``carry``
    (doc_id; columns other than text, which is not kept).  With ``root`` also the group's own name, a fingerprint of it:
    different groups have one component_id where rows repeat a doc_id or have none."""

    def work():
        def f(texts):
            off, data = C.utf8(texts)
            return [C.signed(fingerprints(data, off, shingle))]
        return f

    carry = ["doc_id"] if carry is None else carry
    keyed = docs.withColumn("__id", F.col("doc_id"))
    made = C.checkpoint_table(C.map_texts(keyed, "fp long", work, [*[c for c in carry if c not in ("fp", "__id", "component_id", "fingerprint", *["root"] * root)], "__id"]), "fingerprints")
    classes = made.groupBy("fp").agg(F.min("__id").alias("least"))
    groups = connected_components(links(made.select("fp").distinct(), bits)).withColumnRenamed("node", "fp")
    rooted = classes.join(groups, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    # a table of its own: the join is of two shuffles and a giant component can be split, which it can't be on the aggregate's own shuffle
    least = C.checkpoint_table(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    by_fp = rooted.join(least, "root").select("fp", "component_id", *["root"] * root)
    return made.join(by_fp, "fp").drop("__id").withColumn("fingerprint", F.lpad(F.lower(F.hex("fp")), 16, "0")).drop("fp")
