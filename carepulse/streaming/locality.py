"""Incremental locality enrichment as a Structured Streaming job.

The batch loader (A6-A8) pulls a report, drops cases already in the target,
looks up postcodes and appends.  As a stream, each landed report file is a
micro-batch: ``foreachBatch`` runs the same enrichment against the current
target and appends only new case references, one row each.

* In a batch, a case that is reported more than once is the row with the smallest postcode, whatever the order of rows.
* Across batches, the target's key filter and an exact join on what it lets through drop what was appended before; the
  target is not read for cases that are new.
* The checkpoint (in the shared ``spark.checkpoint.dir``) records which files were processed.  A batch that is appended
  leaves a marker with its query's id and number beside the target; replayed after that, it does nothing.  A batch that died
  while it was appended has no marker and is run again: rows that had already arrived are dropped as known, the
  rest follow, and since a case's row is the same each time the outcome is that of one run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from carepulse.functions.columns import trim_ws
from carepulse.operators.ingest import enrich_postcode, normalise_columns
from carepulse.session import ensure_checkpoint_dir
from carepulse.sources.files import path_exists
from carepulse.sources.keyed import unseen

REPORT_SCHEMA = StructType([StructField("Case Reference", StringType()), StructField("Postcode", StringType())])


#: Beside the target: an empty file for each batch that was appended.
MARKERS = "_batches"


def once_per_case(report: DataFrame, key: str = "Case Reference", postcode: str = "Postcode") -> DataFrame:
    """One row for each case that has a postcode: the smallest one."""
    given = report.filter(F.col(postcode).isNotNull() & (trim_ws(F.col(postcode)) != ""))
    return given.groupBy(key).agg(F.min(postcode).alias(postcode))


def mark(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True).close()


def start_locality_stream(spark: SparkSession, landing: str, target: str, directory: DataFrame,
                          checkpoint: str | None = None, fmt: str = "parquet",
                          once: bool = True) -> StreamingQuery:
    """Start the stream; with ``once`` it processes what has landed and stops."""
    base = ensure_checkpoint_dir(spark)
    checkpoint = checkpoint or f"{base.rstrip('/')}/locality-stream"
    markers = f"{target.rstrip('/')}{MARKERS}"
    reports = spark.readStream.schema(REPORT_SCHEMA).option("header", True).csv(landing)

    def process(batch: DataFrame, epoch: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        marker = f"{markers}/{query}-{epoch}"
        if path_exists(spark, marker):
            return
        # only a missing target is a first batch; one that can't be read fails the batch, and nothing is ever overwritten
        report = unseen(normalise_columns(once_per_case(batch)), "case_reference", target, "CASE_REFERENCE", fmt)
        enrich_postcode(report, None, directory).write.mode("append").format(fmt).save(target)
        mark(spark, marker)

    writer = reports.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()
