"""Layout of the staged mentions: a folder for each month, clustered by area inside."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.operators.windows import MONTH_COL
from carepulse.session import ensure_checkpoint_dir


def made_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the checkpoint folder: ranges are found by a pass over all rows before they are dealt out, and each
    of the two passes would run what ``df`` is made of, its joins included."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_month(mentions: DataFrame, area: str = "LA_NAME", date_col: str = "QUERY_DATE") -> DataFrame:
    """Mentions with ``MENTION_MONTH``, range-partitioned and sorted by month, area and date.

    Written with ``partitionBy(MONTH_COL)`` a trailing window reads the folders of its months only, and one area's rows
    stand in few files and row groups of each.  The number of the task that a row comes from is the last range key, so an
    area with a third of a month's rows is several tasks' work and every task still opens few files.
    """
    placed = mentions.withColumn(MONTH_COL, F.trunc(date_col, "MM")).withColumn("_from", F.spark_partition_id())
    keys = [MONTH_COL, area, date_col]
    return placed.repartitionByRange(*keys, "_from").sortWithinPartitions(*keys).drop("_from")
