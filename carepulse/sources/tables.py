"""Named table scans with declared schemas (source registry)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Tables the test driver lands as parquet, one file per table.
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


# Parquet schemas already inferred in this process, by path.  Inference reads
# file footers on the driver; a plan that scans the same table many times
# (the adapter views do) pays it once.
_SCHEMAS: dict[str, StructType] = {}


def forget_schemas() -> None:
    """Drop cached schemas (after a table was rewritten with new columns)."""
    _SCHEMAS.clear()


class TableSet:
    """Lazy access to the parquet tables of one data folder.

    Reading is lazy; Catalyst prunes columns and pushes filters into each scan
    (see ``ReadSchema`` / ``PushedFilters`` in ``explain``).
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __call__(self, name: str, schema: StructType | None = None) -> DataFrame:
        path = self.path(name)
        if schema is not None:
            return scan_source(self.spark, path, schema)
        known = _SCHEMAS.get(path)
        if known is None:
            df = scan_source(self.spark, path)
            _SCHEMAS[path] = df.schema
            return df
        return scan_source(self.spark, path, known)

    def exists(self, name: str) -> bool:
        return os.path.exists(self.path(name))


def scan_source(spark: SparkSession, path: str, schema: StructType | None = None,
                fmt: str = "parquet") -> DataFrame:
    """Scan a named source.  With a declared schema only those columns are read
    (parquet matches columns by name), so the schema doubles as a projection."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def scan_declared(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Every declared column of the landed source ``<root>/<name>``; one declared by name only has its files' columns."""
    from carepulse.sources.schemas import full_schema
    return scan_source(spark, f"{root.rstrip('/')}/{name}", full_schema(name), fmt)
