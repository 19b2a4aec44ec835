"""Tables that are replaced whole or not at all.

A table is a folder.  Each write is a folder of its own under ``versions/`` and becomes the table when the file
``current``, which names it, is replaced in one rename.  A write that dies, in a task or on the driver, leaves the name and
the rows it points to as they were; a reader that has planned its scan keeps reading the version it started with, since
the version before the current one stays until the next write.  One writer per table at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

POINTER, VERSIONS = "current", "versions"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def current_version(spark: SparkSession, table: str) -> str | None:
    """Name of the version that readers get, None if nothing was ever published."""
    fs, pointer = _fs(spark, f"{table.rstrip('/')}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def current_path(spark: SparkSession, table: str) -> str:
    version = current_version(spark, table)
    if version is None:
        raise FileNotFoundError(f"no table was published at {table}")
    return f"{table.rstrip('/')}/{VERSIONS}/{version}"


def read_table(spark: SparkSession, table: str, schema: StructType | str | None = None) -> DataFrame:
    """The published rows; ``schema`` declares types and saves a look at a file's footer."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(current_path(spark, table))


def _switch(spark: SparkSession, table: str, version: str) -> None:
    """Name ``version`` the current one: a new pointer file beside the old one, renamed over it."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, new = _fs(spark, f"{table}/{POINTER}-{version}")
    out = fs.create(new, True)
    try:
        out.write(version.encode())
    finally:
        out.close()
    options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(new, jvm.org.apache.hadoop.fs.Path(f"{table}/{POINTER}"), options)


def publish(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as the table's new version, switch to it and return the published rows.

    The schema of ``df`` is the table's, also when there is no row.  ``df`` may read the table it replaces."""
    spark, table = df.sparkSession, table.rstrip("/")
    before = current_version(spark, table)
    version = uuid.uuid4().hex
    df.write.partitionBy(*partition_by).parquet(f"{table}/{VERSIONS}/{version}")
    _switch(spark, table, version)
    _drop_all_but(spark, table, {before, version})
    schema = StructType([f for f in df.schema if f.name not in partition_by] + [df.schema[c] for c in partition_by])
    return spark.read.schema(schema).parquet(f"{table}/{VERSIONS}/{version}")


def _drop_all_but(spark: SparkSession, table: str, keep: set[str | None]) -> None:
    """Delete versions that are neither current nor the one before, those of dead writes among them."""
    fs, folder = _fs(spark, f"{table}/{VERSIONS}")
    for status in fs.listStatus(folder):
        if status.getPath().getName() not in keep:
            fs.delete(status.getPath(), True)


def list_tables(spark: SparkSession, root: str) -> list[str]:
    """Names of the published tables under ``root``; a folder without a pointer is none."""
    fs, folder = _fs(spark, root)
    if not fs.exists(folder):
        return []
    jvm = spark.sparkContext._jvm
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory() and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), POINTER)))
