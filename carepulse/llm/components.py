"""Connected components of a graph of pairs, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.llm import common as C


def connected_components(edges: DataFrame, name: str = "stars") -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b); root is the component's smallest node.

    Each round hangs nodes on the smallest neighbour; rounds grow with the logarithm of the longest path.  Minima combine
    in the map tasks; they are tables of their own, so that a hot node's join is of two shuffles and can be split: no task gathers a component.  Each round is a table in
    the checkpoint folder.  Null nodes and loops are ignored.  Only three numbers a round reach the driver.
    """
    now = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = C.checkpoint_table(now, name)
    mark = _mark(now)
    while mark[0]:
        step = C.checkpoint_table(_small(_large(now)), name)
        after = _mark(step)
        C.drop_table(now)
        now = step
        if after == mark:
            break
        mark = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b")).distinct()


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a", F.lit(1)).cast("decimal(38,0)"))).head())


def _large(e: DataFrame) -> DataFrame:
    """Larger neighbours of each node hang on the smallest one around it."""
    both = e.union(e.select("b", "a"))
    least = C.checkpoint_table(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(e: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and itself, hang on the smallest; edges run from the larger to the smaller node."""
    least = C.checkpoint_table(e.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = e.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", "m")).distinct()
