"""Chatbot marts, bridge and dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carepulse.functions.columns import regex_literal
from carepulse.session import ensure_checkpoint_dir

PERSONA_SEPARATOR = ";"


def _tenant_rows(accessava: DataFrame) -> DataFrame:
    return accessava.filter(F.col("tenant_name").isNotNull())


# P1 ---------------------------------------------------------------------------
def conversations_monthly(accessava: DataFrame, ordered: bool = False) -> DataFrame:
    """Tenant x month: rows, distinct conversations, first and last date.

    COUNT(DISTINCT) is planned as a two-level aggregate keyed by
    (tenant, month, transcript_id) first, so a dominant tenant is spread over
    many reducers before the final per-tenant count.
    """
    out = (_tenant_rows(accessava)
           .groupBy(F.col("tenant_name").alias("TENANT_NAME"),
                    F.trunc(F.col("created_at"), "MM").alias("CONVERSATION_MONTH"))
           .agg(F.count(F.lit(1)).alias("CONVERSATION_COUNT"),
                F.countDistinct("transcript_id").alias("UNIQUE_CONVERSATIONS"),
                F.min("created_at").alias("FIRST_CONVERSATION_DATE"),
                F.max("created_at").alias("LAST_CONVERSATION_DATE")))
    if ordered:
        out = out.orderBy(F.col("CONVERSATION_MONTH").desc_nulls_first(), F.col("TENANT_NAME").asc_nulls_last())
    return out


# P2 ---------------------------------------------------------------------------
def conversations_total(accessava: DataFrame, ordered: bool = False) -> DataFrame:
    """Per tenant, all time, with DAYS_ACTIVE = days between first and last."""
    out = (_tenant_rows(accessava)
           .groupBy(F.col("tenant_name").alias("TENANT_NAME"))
           .agg(F.count(F.lit(1)).alias("TOTAL_CONVERSATIONS"),
                F.countDistinct("transcript_id").alias("UNIQUE_CONVERSATIONS"),
                F.min("created_at").alias("FIRST_CONVERSATION_DATE"),
                F.max("created_at").alias("LAST_CONVERSATION_DATE"))
           .withColumn("DAYS_ACTIVE", F.datediff("LAST_CONVERSATION_DATE", "FIRST_CONVERSATION_DATE")))
    if ordered:
        # warehouse DESC puts NULLs first
        out = out.orderBy(F.col("TOTAL_CONVERSATIONS").desc_nulls_first())
    return out


# P3 ---------------------------------------------------------------------------
def top_tenants(totals: DataFrame, k: int = 5) -> DataFrame:
    """Top-k tenants by total conversations (tenant name breaks ties).

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own top k and only k rows per task reach the final merge.
    """
    return (totals.select("TENANT_NAME", "TOTAL_CONVERSATIONS")
            .orderBy(F.col("TOTAL_CONVERSATIONS").desc_nulls_first(), F.col("TENANT_NAME").asc_nulls_last())
            .limit(k))


# P4 ---------------------------------------------------------------------------
def persona_bridge(accessava: DataFrame, sep: str = PERSONA_SEPARATOR) -> DataFrame:
    """Conversation x persona value: split, trim, drop blanks (inner explode,
    duplicates kept)."""
    x = (accessava.filter(F.col("persona").isNotNull())
         .select(F.col("transcript_id").alias("TRANSCRIPT_ID"),
                 F.explode(F.split(F.col("persona"), regex_literal(sep))).alias("_v")))
    return (x.select("TRANSCRIPT_ID", F.trim(F.col("_v")).alias("PERSONA"))
            .filter(F.col("PERSONA") != ""))


# P5 ---------------------------------------------------------------------------
#: Distinct values that one range partition numbers.
KEYS_PER_PARTITION = 1_000_000


def dense_keys(values: DataFrame, value_col: str, key_col: str, num_partitions: int | None = None, after: int = 0) -> DataFrame:
    """Surrogate key = rank of each distinct value in ascending order, from ``after`` + 1.

    A global ``row_number() OVER (ORDER BY v)`` runs in one task.  Instead:
    range-partition the distinct values (sampled boundaries; as many
    partitions as their number asks for), checkpoint so the partitioning is
    fixed (sampling is not repeatable, and the lineage is cut so a lost
    executor does not re-sample), count rows per partition, turn the counts
    into offsets (one row per partition, a proven bound, so broadcast is
    safe) and add a row number within each partition.
    """
    spark = values.sparkSession
    ensure_checkpoint_dir(spark)
    distinct = values.select(F.col(value_col)).filter(F.col(value_col).isNotNull()).distinct().checkpoint(eager=True)
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = num_partitions or max(1, min(most, -(-distinct.count() // KEYS_PER_PARTITION)))
    ranged = distinct.repartitionByRange(n, F.col(value_col).asc()).checkpoint(eager=True)
    ranged = ranged.withColumn("_pid", F.spark_partition_id())
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_offset"))
    offsets = offsets.fillna(0, subset=["_offset"])
    local = F.row_number().over(Window.partitionBy("_pid").orderBy(F.col(value_col).asc()))
    keyed = ranged.withColumn("_local", local).join(F.broadcast(offsets), "_pid")
    return keyed.select((F.col("_offset") + F.col("_local") + after).cast("bigint").alias(key_col), F.col(value_col))


def extend_keys(known: DataFrame, values: DataFrame, value_col: str, key_col: str) -> DataFrame:
    """Keys of the values that ``known`` (key, value) has none for yet, numbered on from its last: keys stay dense, and what
    was built on the old ones stays right."""
    last = known.agg(F.max(key_col)).head()[0] or 0
    new = values.select(value_col).distinct().join(known.select(value_col), value_col, "left_anti")
    return dense_keys(new, value_col, key_col, after=last)


def persona_dim(bridge: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Distinct persona values with PERSONA_ID = alphabetical rank from 1."""
    return dense_keys(bridge, "PERSONA", "PERSONA_ID", num_partitions)


# P6 ---------------------------------------------------------------------------
def bridge_diff(rebuilt: DataFrame, existing: DataFrame) -> DataFrame:
    """Row-level multiset difference both ways, tagged with DIFF_SIDE (one
    unmatched copy per extra row): every distinct row's copies are counted
    with opposite signs in one aggregate."""
    cols = rebuilt.columns
    both = rebuilt.withColumn("_d", F.lit(1)).unionByName(existing.select(*cols).withColumn("_d", F.lit(-1)))
    extra = both.groupBy(*cols).agg(F.sum("_d").alias("_d")).filter(F.col("_d") != 0)
    side = F.when(F.col("_d") > 0, F.lit("only_rebuilt")).otherwise(F.lit("only_existing"))
    return extra.select(*cols, side.alias("DIFF_SIDE"), F.explode(F.sequence(F.lit(1), F.abs("_d"))).alias("_i")).drop("_i")


def legacy_persona_bridge(accessava: DataFrame) -> DataFrame:
    """Existing-table stand-in used for P6: split on '; ' without dropping
    blanks (what an older splitter produced)."""
    x = (accessava.filter(F.col("persona").isNotNull())
         .select(F.col("transcript_id").alias("TRANSCRIPT_ID"),
                 F.explode(F.split(F.col("persona"), regex_literal("; "))).alias("PERSONA")))
    return x
