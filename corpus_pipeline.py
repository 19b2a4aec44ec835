"""Corpus pipeline: documents through quality rules, line dedup, near-dedup, decontamination and encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read back as the next one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carepulse.llm import bpe, decontaminate, line_dedup, quality_rules, simhash
from carepulse.llm.common import checkpoint_table, documents, row_key, same_row, table
from carepulse.llm.queries import BPE_FILE

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.quality_rules(docs, table(spark, sf_dir, "labels"), carry=COLUMNS).where("kept").select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines; n_chars follows the text."""
    out = line_dedup.line_dedup(docs, carry=COLUMNS)
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest doc_id (ties: the smallest checksum)."""
    keyed = row_key(docs)
    groups = simhash.simhash_groups(keyed.select("doc_id", "text", "__sum"), carry=["doc_id", "__sum"], root=True)
    # by the group's root: groups of rows that repeat an id, or have none, share their smallest id and each keeps a row of its own
    stay = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("component_id").alias("__id"), F.min("__sum").alias("__sum"))
    # rows that repeat an id and a text are one document; which one stays is settled by their other columns
    one = keyed.join(stay, same_row(keyed, stay), "left_semi").groupBy("__id", "__sum").agg(F.min(F.struct("lang", "source", "n_chars", "text")).alias("r"))
    return one.select(F.col("__id").alias("doc_id"), "r.text", "r.lang", "r.source", "r.n_chars")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), carry=COLUMNS).where("not contaminated").select(COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and the digests of the round trip."""
    out = bpe.bpe_round_trip(docs, BPE_FILE, carry=["doc_id", "lang", "source"])
    return out.select("doc_id", "lang", "source", "n_tokens", F.transform(F.filter(F.split("ids", " "), lambda x: x != ""), lambda x: x.cast("int")).alias("ids"), "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("BPE encoding and decoding", encoded),
]

#: The fitted quality score, fingerprints and token ids are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's result is a table in the checkpoint folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = checkpoint_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
