"""File datasets and sinks: CSV datasets, dated snapshots, JSON export and
append-only targets (A2, A8, A16, A20)."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# A2 ---------------------------------------------------------------------------
def scan_csv_dataset(spark: SparkSession, folder: str, dataset_id: str,
                     schema: StructType | str | None = None, fail_fast: bool = False) -> DataFrame:
    """Read ``<folder>/<dataset_id>.csv`` with a header.  Pass a schema in
    production; without one the types are inferred (an extra pass).
    ``fail_fast``: a value that doesn't fit its column fails the scan instead of becoming NULL."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST" if fail_fast else "PERMISSIVE")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(f"{folder.rstrip('/')}/{dataset_id}.csv")


def list_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """File listing as a DataFrame (path, name, modification time, length).
    ``binaryFile`` only reads file contents when that column is selected."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"),
                     F.col("modificationTime").alias("modification_time"), "length")


def list_names(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Names (file_name) of what stands in ``folder`` and matches, a file or a folder of part files."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{glob}")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return spark.createDataFrame([(s.getPath().getName(),) for s in found or []], "file_name string")


# A16 --------------------------------------------------------------------------
def latest_file(spark: SparkSession, folder: str, glob: str) -> str | None:
    """Path of the lexicographically last file matching ``glob`` (dated
    names sort by date).  Only the single winning path reaches the driver,
    so the caller scans exactly one file."""
    row = list_files(spark, folder, glob).agg(F.max_by("path", "file_name").alias("p")).first()
    return None if row is None else row["p"]


def read_latest_csv(spark: SparkSession, folder: str, glob: str, schema: StructType | None = None) -> DataFrame:
    path = latest_file(spark, folder, glob)
    if path is None:
        raise FileNotFoundError(f"no file matching {glob} in {folder}")
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def latest_partition(spark: SparkSession, table: str, column: str, schema: StructType | str, fmt: str = "parquet") -> DataFrame:
    """Rows of the last value of a table's partition column, as ``ingest.latest_snapshot`` of the whole.

    The value is the greatest of the folders' names, so no data is read to find it, and the scan opens its folder only.
    ``schema`` has the column; an empty table gives no rows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    listed = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    values = [unescape(n.removeprefix(f"{column}=")) for n in (s.getPath().getName() for s in listed) if n.startswith(f"{column}=") and not n.endswith("__HIVE_DEFAULT_PARTITION__")]
    rows = spark.read.format(fmt).schema(schema).load(table)
    return rows.filter(F.col(column) == max(values)) if values else rows.limit(0)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored at ``path``; any other trouble with the store is raised, not taken for absence."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


# A8 ---------------------------------------------------------------------------
def append_new_rows(new_rows: DataFrame, target_path: str, key: str, fmt: str = "parquet",
                    check_unique: bool = False) -> int:
    """Create the target if absent, else append only rows whose key is new.

    Keys are told new by the target's key filter (``sources.keyed``) as it is
    at the write, so a rerun after a partial failure does not duplicate keys,
    and the target is read only where a key may be known.  Single writer
    per target.  Returns the number of rows written (from an observed
    metric, not a second pass).  ``check_unique`` first tests the rows that
    would be written (a report may repeat a key) and raises before anything
    is written; only one duplicated key is fetched for the message.  A target
    that is there but can't be read fails the load and stays as it is.
    """
    spark = new_rows.sparkSession
    exists = path_exists(spark, target_path)
    from carepulse.sources.keyed import unseen
    rows = unseen(new_rows, key, target_path, fmt=fmt)
    if check_unique:
        from carepulse.operators.checks import unique_failures
        dup = unique_failures(rows, key).limit(1).collect()
        if dup:
            raise ValueError(f"duplicate {key} for {target_path}: {dup[0]['VALUE']!r}; nothing was written")
    from pyspark.sql import Observation
    obs = Observation("appended")
    rows = rows.observe(obs, F.count(F.lit(1)).alias("n"))
    rows.write.mode("append" if exists else "errorifexists").format(fmt).save(target_path)
    return int(obs.get["n"])


# A11 --------------------------------------------------------------------------
def replace_datasets(rows: DataFrame, path: str, key: str = "dataset_id") -> None:
    """Replace the datasets that ``rows`` holds, each in a partition folder of its own; all others stay.

    A dataset without a row (skipped, failed or empty) keeps what was loaded before.  Rows are dealt by dataset and the
    parts levelled by their bytes at run time: a big dataset is many tasks' work, small ones share a task.  Files are staged
    by the writer and moved at the end, so a failing task leaves every dataset as it was.
    """
    (rows.hint("rebalance", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path))


# A20 --------------------------------------------------------------------------
def _replace_folder(spark: SparkSession, written: str, to: str | None) -> None:
    """Make ``written`` the folder ``to``, or drop it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    source = hadoop.Path(written)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if to is None:
        fs.delete(source, True)
        return
    fs.delete(hadoop.Path(to), True)
    if not fs.rename(source, hadoop.Path(to)):
        raise OSError(f"{written} could not be renamed to {to}")


#: Marts with raw counts: an export refuses them unless told otherwise.
UNSUPPRESSED = ("mart_la_query_summary",)


def export_json(tables: Iterable[tuple[str, DataFrame]], folder: str,
                refuse_unsuppressed: Sequence[str] = UNSUPPRESSED) -> dict[str, str]:
    """Write each table as JSON Lines keeping NULL keys; skip empty tables
    (what they exported before stays); collect failures and raise at the end.
    Each table is worked out once: its rows are counted while they are written
    beside the export, which they replace when the write is done, so a write
    that fails leaves the export before.  Tables are processed in name
    order; names in ``refuse_unsuppressed`` are refused and reported
    (small-number suppression must not be bypassed by an export)."""
    from pyspark.sql import Observation
    results: dict[str, str] = {}
    failures: list[str] = []
    for name, df in sorted(tables, key=lambda t: t[0]):
        if name in refuse_unsuppressed:
            results[name] = "refused"
            continue
        to, beside = f"{folder.rstrip('/')}/{name}", f"{folder.rstrip('/')}/_writing-{name}-{uuid.uuid4().hex}"
        try:
            obs = Observation(f"exported {name}")
            df.observe(obs, F.count(F.lit(1)).alias("n")).write.option("ignoreNullFields", "false").json(beside)
            results[name] = "ok" if obs.get["n"] else "empty"
            _replace_folder(df.sparkSession, beside, to if obs.get["n"] else None)
        except Exception as e:  # noqa: BLE001
            results[name] = f"failed: {e}"
            failures.append(name)
    if failures:
        raise RuntimeError(f"export failures: {', '.join(failures)}")
    return results
