"""External dataset load, from a manifest and a folder of CSV files to one table per dataset.

``manifest.json`` names the run and lists its datasets with a status and
provenance; ``<dataset_id>.csv`` holds a dataset's rows under columns of its
own.  The manifest, the files and the tables already there are read as
DataFrames and become a load plan (one row per dataset).  Each planned dataset
is then read, tagged and written as its own table, so a dataset that is skipped,
failed or not in the manifest keeps the table it had.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from carepulse.operators import ingest
from carepulse.sources import files, versioned

log = logging.getLogger(__name__)

MANIFEST_SCHEMA = ("run_id string, run_at string, datasets array<struct<dataset_id: string, status: string, message: string, "
                   "provenance: struct<warnings: array<struct<code: string, message: string, details: string>>>>>")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per dataset of a manifest document: run_id, run_at and the dataset's fields."""
    doc = spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(MANIFEST_SCHEMA).json(path)
    return doc.select("run_id", "run_at", F.explode("datasets").alias("d")).select("run_id", "run_at", "d.*")


def list_tables(spark: SparkSession, root: str) -> DataFrame:
    """Names of the tables published under ``root``, none if it isn't there."""
    return spark.createDataFrame([(n,) for n in versioned.list_tables(spark, root)], "table_name string")


def _rows(spark: SparkSession, folder: str, name: str, target: str, schema: StructType | str | None) -> DataFrame:
    """A dataset's rows with its declared types; else, under the header it had, with those of the table it replaces, so
    that types don't drift from load to load (a value that no longer fits fails the dataset); else with inferred types."""
    if schema is None and versioned.current_version(spark, f"{target}/{name}") is not None:
        before = versioned.read_table(spark, f"{target}/{name}").drop(*ingest.PROVENANCE_COLUMNS)
        header = spark.read.option("header", True).csv(f"{folder}/{name}.csv").columns
        schema = before.schema if header == before.columns else None
    return files.scan_csv_dataset(spark, folder, name, schema, fail_fast=schema is not None)


def load_external_sources(spark: SparkSession, folder: str, target: str,
                          schemas: dict[str, StructType | str] | None = None, workers: int = 4) -> DataFrame:
    """Load what the manifest in ``folder`` asks for into ``<target>/<dataset_id>``; returns the load plan.

    Every dataset is tried, up to ``workers`` at a time; a broken one is logged, counted and leaves its table alone,
    whenever it breaks: a table is published as a new version at the end of its write (``versioned``).  The load raises
    at the end if any failed.  The driver holds the manifest's rows, one per dataset, never data.
    """
    folder, target = folder.rstrip("/"), target.rstrip("/")
    manifest = read_manifest(spark, f"{folder}/manifest.json")
    plan = ingest.manifest_load_plan(manifest, list_tables(spark, target), files.list_names(spark, folder, "*.csv"))
    flags = ingest.with_drift_flag(manifest).select(F.col("dataset_id").alias("DATASET_ID"), "run_id", "run_at", "DRIFT_FLAG")
    steps = plan.join(flags, "DATASET_ID", "left").orderBy("DATASET_ID").collect()
    failed = [s["DATASET_ID"] for s in steps if s["ACTION"] == ingest.FAILED]

    def load(s) -> str | None:
        name = s["DATASET_ID"]
        try:
            rows = _rows(spark, folder, name, target, (schemas or {}).get(name))
            versioned.publish(ingest.tag_provenance(rows, s["run_id"], s["run_at"], s["DRIFT_FLAG"]), f"{target}/{name}")
        except Exception as e:  # noqa: BLE001 - counted, raised together below
            log.error("%s: not loaded: %s", name, e)
            return name

    todo = [s for s in steps if s["ACTION"] in (ingest.LOAD, ingest.FIRST_TIME_LOAD)]
    for s in steps:
        if s not in todo:
            log.info("%s: %s, %s", s["DATASET_ID"], s["STATUS"], s["ACTION"])
    with ThreadPoolExecutor(workers) as pool:
        failed += [name for name in pool.map(inheritable_thread_target(spark)(load), todo) if name]
    if failed:
        raise RuntimeError(f"{len(failed)} dataset(s) failed to load: {', '.join(sorted(failed))}")
    return spark.createDataFrame([tuple(s[c] for c in plan.columns) for s in steps], plan.schema)
