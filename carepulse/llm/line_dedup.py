"""Line dedup: lines that stand on many sites are removed but for their first place.

Lines that occur fewer times than ``min_sites`` can't be on so many sites, so a plain count drops them first.
For the rest, a HyperLogLog sketch of the sites is built per line hash and merged by aggregation; lines whose estimate
is near the threshold get an exact distinct count.  A line found on ``min_sites`` sites or more
is boilerplate: it stays where it stands first (smallest doc_id, then line number) and goes everywhere else.

A line is what stands between newlines, without white space at its ends; blank lines stay and count as nothing.
Every aggregate combines in the map tasks, so a line that a third of all documents has costs a row per
task.  Joins on the line hash have one row per hash on one side; Spark splits a hot hash on the other.

Null text: no line, kept as null.  Null source: a site of its own.  Rows that repeat doc_id and text keep the same lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.llm import common as C

MIN_SITES, LG_K = 5, 12
#: Three standard errors of a sketch of 2**LG_K registers, and one site at least.
NEAR = 3 * 1.04 / 2 ** (LG_K / 2)
BLANKS = " \t\r\x0b\x0c"


def lines(docs: DataFrame, site: str) -> DataFrame:
    """A row for each line that isn't blank: its row, site, number and hash."""
    keyed = C.row_key(docs)
    out = keyed.select("__id", "__sum", F.coalesce(F.col(site).cast("string"), F.lit("\0")).alias("site"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return out.withColumn("line", F.btrim("line", F.lit(BLANKS))).where("line != ''").withColumn("h", F.unhex(F.md5("line"))).drop("line")


def boilerplate(repeated: DataFrame, min_sites: int) -> DataFrame:
    """Hashes of lines on ``min_sites`` sites or more."""
    sketched = repeated.groupBy("h").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("about"))
    near = F.abs(F.col("about") - min_sites) <= max(1.0, NEAR * min_sites)
    sketched = C.checkpoint_table(sketched.where((F.col("about") >= min_sites) | near), "spread")
    exact = repeated.join(sketched.where(near).select("h"), "h", "left_semi").groupBy("h").agg(F.countDistinct("site").alias("n")).where(F.col("n") >= min_sites)
    return sketched.where(~near).select("h").union(exact.select("h"))


def line_dedup(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, carry: list[str] | None = None) -> DataFrame:
    """Every document with ``text`` as kept, n_lines and n_removed, after the columns in ``carry`` (doc_id)."""
    carry = ["doc_id"] if carry is None else carry
    every = lines(docs, site)
    # tables of their own: a join of two shuffles can be split where a hash is hot, a join on an aggregate's own shuffle can't
    often = C.checkpoint_table(every.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites).select("h"), "often")
    repeated = C.checkpoint_table(every.join(often, "h"), "repeated")
    bad = C.checkpoint_table(boilerplate(repeated, min_sites), "boilerplate")
    found = repeated.join(bad, "h")
    first = C.checkpoint_table(found.groupBy("h").agg(F.min(F.struct("__id", "__sum", "pos")).alias("first")), "first")
    gone = found.join(first, "h").where(~F.struct("__id", "__sum", "pos").eqNullSafe(F.col("first")))
    cut = gone.groupBy("__id", "__sum").agg(F.collect_set("pos").alias("gone"))
    keyed = C.row_key(docs)
    kept_cols = [c for c in carry if c not in ("text", "n_lines", "n_removed")]
    all_lines = F.split(keyed["text"], "\n")
    kept = F.when(cut["gone"].isNull(), keyed["text"]).otherwise(F.array_join(F.filter(all_lines, lambda _, i: ~F.array_contains(cut["gone"], i)), "\n"))
    return keyed.join(cut, C.same_row(keyed, cut), "left").select(
        *[keyed[c] for c in kept_cols], kept.alias("text"), F.coalesce(F.size(all_lines), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size(cut["gone"]), F.lit(0)).cast("long").alias("n_removed"))
