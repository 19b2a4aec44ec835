"""Ingest operators (A3-A22): report cleaning, incremental enrichment,
manifest-driven loading with provenance, member board, signals, staleness
and freshness.  Network pulls of the reference are re-aimed at landed data:
each operator starts from a DataFrame of what the pull returned."""

from __future__ import annotations

import functools
import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, MapType, StringType, StructField, StructType

from carepulse.functions.columns import (NULL_PLACEHOLDERS, drift_flag, normalise_name, null_placeholders,
                                         standardise_service_type, trim_ws)
from carepulse.operators.lookup import lookup_join

log = logging.getLogger(__name__)

# --- fixed values ------------------------------------------------------------
REPORT_PAGE_LIMIT = 1000          # casework report API returns at most this many rows
STALE_DAYS = 30
LOAD, FIRST_TIME_LOAD, SKIP, FAILED = "load", "first_time_load", "skip", "failed"
# -----------------------------------------------------------------------------


# A3 ---------------------------------------------------------------------------
def normalise_columns(df: DataFrame) -> DataFrame:
    """Header normalisation: spaces to '_', lower-case (a rename, no job)."""
    return df.toDF(*[normalise_name(c) for c in df.columns])


# A4 ---------------------------------------------------------------------------
def clean_placeholders(df: DataFrame, placeholders: Sequence[str] = NULL_PLACEHOLDERS) -> DataFrame:
    return null_placeholders(df, placeholders)


# A5 ---------------------------------------------------------------------------
def clean_demographics(raw: DataFrame, key: str = "case_reference", order_col: str = "ingest_seq") -> DataFrame:
    """Normalise headers and placeholders, normalise the key (upper, trim of
    space/tab/CR/LF) and keep the first row per key by ingest order.

    Rows that tie on the ingest order are ordered by their values (NULL
    first), so the choice is deterministic.
    Keep-first is an aggregate of ``min(struct(order, row...))``: it is
    pre-aggregated in every task before the shuffle, so a key that holds a
    large share of the rows never lands whole in one task.
    """
    df = clean_placeholders(normalise_columns(raw))
    if key not in df.columns:
        raise ValueError(f"expected column {key!r} after normalisation; got {df.columns}")
    if order_col not in df.columns:
        raise ValueError(f"keep-first needs an ingest order column {order_col!r}")
    df = df.withColumn(key, F.upper(trim_ws(F.col(key))))
    rest = [c for c in df.columns if c not in (key, order_col)]
    first = df.groupBy(key).agg(F.min(F.struct(order_col, *rest)).alias("_first"))
    return first.select(key, *[F.col(f"_first.{c}").alias(c) for c in rest], F.col(f"_first.{order_col}").alias(order_col))


def demographics_load_report(raw: DataFrame, cleaned: DataFrame,
                             page_limit: int = REPORT_PAGE_LIMIT) -> DataFrame:
    """Rows in, rows kept, duplicates dropped and the page-limit warning."""
    tagged = raw.select(F.lit(1).alias("_t")).unionByName(cleaned.select(F.lit(2).alias("_t")))
    return (tagged.agg(F.count_if(F.col("_t") == 1).alias("N_IN"), F.count_if(F.col("_t") == 2).alias("N_OUT"))
            .withColumn("N_DROPPED", F.col("N_IN") - F.col("N_OUT"))
            .withColumn("AT_PAGE_LIMIT", F.col("N_IN") >= page_limit))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Stop on empty input (bounded probe: reads at most one row)."""
    if df.isEmpty():
        raise ValueError(f"{what}: no rows")
    return df


# A6 ---------------------------------------------------------------------------
def incremental_new_keys(incoming: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not yet in the target (left anti join on the key)."""
    return incoming.join(existing.select(F.col(key)), key, "left_anti")


# A7 ---------------------------------------------------------------------------
def enrich_postcode(report: DataFrame, existing: DataFrame | None, directory: DataFrame,
                    key: str = "case_reference", postcode: str = "postcode") -> DataFrame:
    """New cases with a postcode, joined to the postcode directory.

    Blank/NULL postcodes are dropped; cases already in the target are
    skipped (none are known where ``existing`` is None); an unresolved postcode keeps the case with NULL geography; the
    postcode itself is not stored; output columns are upper-case.  One join
    replaces one lookup call per distinct postcode.
    """
    r = normalise_columns(report).select(key, postcode)
    r = r.filter(F.col(postcode).isNotNull() & (trim_ws(F.col(postcode)) != ""))
    if existing is not None:
        r = incremental_new_keys(r, existing, key)
    # one row per postcode: a directory that repeats one must not repeat cases
    rest = [c for c in directory.columns if c != postcode]
    once = directory.groupBy(postcode).agg(F.min(F.struct(*rest)).alias("_d")).select(postcode, *[F.col(f"_d.{c}").alias(c) for c in rest])
    out = lookup_join(r, once, postcode, "left").drop(postcode)
    return out.toDF(*[c.upper() for c in out.columns])


# A9 ---------------------------------------------------------------------------
def with_drift_flag(datasets: DataFrame, warnings_col: str = "provenance.warnings") -> DataFrame:
    return datasets.withColumn("DRIFT_FLAG", drift_flag(F.col(warnings_col)))


# A10 --------------------------------------------------------------------------
def manifest_load_plan(datasets: DataFrame, tables: DataFrame, files: DataFrame,
                       table_col: str = "table_name", file_col: str = "file_name",
                       file_suffix: str = ".csv") -> DataFrame:
    """One action per manifest dataset, decided in the loader's order."""
    t = tables.select(F.col(table_col).alias("dataset_id")).distinct().withColumn("TABLE_EXISTS", F.lit(True))
    f = (files.select(F.regexp_replace(F.col(file_col), f"\\Q{file_suffix}\\E$", "").alias("dataset_id"))
         .distinct().withColumn("FILE_EXISTS", F.lit(True)))
    x = (datasets.select("dataset_id", "status")
         .join(t, "dataset_id", "left").join(f, "dataset_id", "left")
         .fillna(False, subset=["TABLE_EXISTS", "FILE_EXISTS"]))
    s = F.col("status")
    wants = (F.when(s == "LIMITATION", F.lit(SKIP))
             .when(s.startswith("FAILED_"), F.lit(FAILED))
             .when((s == "NO_UPDATE") & F.col("TABLE_EXISTS"), F.lit(SKIP))
             .when(s == "NO_UPDATE", F.lit(FIRST_TIME_LOAD))
             .when(s == "SUCCESS", F.lit(LOAD))
             .otherwise(F.lit(SKIP)))
    action = F.when(wants.isin(LOAD, FIRST_TIME_LOAD) & ~F.col("FILE_EXISTS"), F.lit(FAILED)).otherwise(wants)
    return x.select(F.col("dataset_id").alias("DATASET_ID"), F.col("status").alias("STATUS"),
                    "TABLE_EXISTS", "FILE_EXISTS", action.alias("ACTION"))


# A11 --------------------------------------------------------------------------
PROVENANCE_COLUMNS = ("_RUN_ID", "_RUN_AT", "_DRIFT_FLAG")


def tag_provenance(rows: DataFrame, run_id: str, run_at: str, drift: Column | str | None) -> DataFrame:
    """Add run id, run time and drift flag to every row.  Column names are
    compared case-insensitively first: the warehouse upper-cases them."""
    existing = {c.upper() for c in rows.columns}
    clash = [c for c in PROVENANCE_COLUMNS if c.upper() in existing]
    if clash:
        raise ValueError(f"provenance columns already present: {clash}")
    d = drift if isinstance(drift, Column) else F.lit(drift).cast("string")
    return rows.withColumns({"_RUN_ID": F.lit(run_id), "_RUN_AT": F.lit(run_at), "_DRIFT_FLAG": d})


def tag_loaded_rows(rows: DataFrame, plan: DataFrame, flags: DataFrame, run_id: str, run_at: str) -> DataFrame:
    """Rows of every dataset the plan loads, tagged in one job (a join on
    dataset id instead of one write per dataset)."""
    loading = (plan.filter(F.col("ACTION").isin(LOAD, FIRST_TIME_LOAD))
               .select(F.col("DATASET_ID").alias("dataset_id"))
               .join(flags.select("dataset_id", "DRIFT_FLAG"), "dataset_id", "left"))
    # one row per dataset on the right: a dataset holding most of the rows is
    # a skewed partition of the streamed side, which AQE splits
    x = rows.join(loading, "dataset_id").withColumnRenamed("DRIFT_FLAG", "_flag")
    return tag_provenance(x, run_id, run_at, F.col("_flag")).drop("_flag")


# A12 --------------------------------------------------------------------------
def load_summary(plan: DataFrame) -> DataFrame:
    """Loaded / skipped / failed counts and the overall outcome."""
    a = F.col("ACTION")
    return (plan.agg(F.count_if(a.isin(LOAD, FIRST_TIME_LOAD)).alias("N_LOADED"),
                     F.count_if(a == SKIP).alias("N_SKIPPED"),
                     F.count_if(a == FAILED).alias("N_FAILED"))
            .withColumn("OUTCOME", F.when(F.col("N_FAILED") > 0, F.lit("failed")).otherwise(F.lit("ok"))))


def raise_on_failures(summary_row) -> None:
    """Driver-side stop after a load (the only decision taken on the driver)."""
    if summary_row["N_FAILED"] > 0:
        raise RuntimeError(f"{summary_row['N_FAILED']} dataset(s) failed to load")


# A13 / A14 --------------------------------------------------------------------
def member_orgs(board: DataFrame, group: str, check_nonempty: bool = False) -> DataFrame:
    """Board items of one group, renamed and with standardised service type."""
    x = board.filter(F.col("group_title") == group).select(
        F.col("item_name").alias("monday_name"),
        standardise_service_type(F.col("Service")).alias("service_type"),
        F.col("group_title").alias("contract_group"))
    return require_rows(x, f"group {group!r}") if check_nonempty else x


# A15 --------------------------------------------------------------------------
def service_type_counts(orgs: DataFrame, ordered: bool = False) -> DataFrame:
    """Organisations per service type (most frequent first when ordered)."""
    out = orgs.groupBy(F.col("service_type").alias("SERVICE_TYPE")).agg(F.count(F.lit(1)).alias("N"))
    return out.orderBy(F.col("N").desc(), F.col("SERVICE_TYPE").asc_nulls_last()) if ordered else out


def member_orgs_summary(board: DataFrame, group: str) -> DataFrame:
    g = F.col("group_title") == group
    return board.agg(F.count_if(g).alias("N_LOADED"), F.count_if(~g | g.isNull()).alias("N_EXCLUDED"))


# A16 --------------------------------------------------------------------------
def latest_snapshot(df: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Rows of the lexicographically last snapshot (a one-row max, broadcast)."""
    last = df.agg(F.max(name_col).alias("_last"))
    return df.join(F.broadcast(last), F.col(name_col) == F.col("_last"), "left_semi")


# A17 --------------------------------------------------------------------------
def filter_unit(signals: DataFrame, unit: str, unit_col: str = "unit", warn_if_empty: bool = False) -> DataFrame:
    """Signal rows of one LA; optionally log a warning when there are none
    (a bounded probe that reads at most one row)."""
    out = signals.filter(F.col(unit_col) == unit)
    if warn_if_empty and out.isEmpty():
        log.warning("no signals for %s", unit)
    return out


# A18 --------------------------------------------------------------------------
LA_NARRATIVE = StructType([StructField("total_signals", IntegerType()), StructField("top_signal", StringType())])
NARRATIVE_SCHEMA = StructType([StructField("run_date", StringType()),
                               StructField("las", MapType(StringType(), LA_NARRATIVE))])


def narrative_documents(signals: DataFrame) -> DataFrame:
    """Build the narrative JSON (one document per snapshot): for every LA the
    number of signals and its most frequent signal type.  A document holds
    one entry per LA, a bounded set."""
    per = signals.groupBy("file_name", "unit", "signal").agg(F.count(F.lit(1)).alias("n"))
    per_la = per.groupBy("file_name", "unit").agg(
        F.sum("n").cast("int").alias("total_signals"),
        F.max_by("signal", F.struct(F.col("n"), F.col("signal"))).alias("top_signal"),
        F.array_sort(F.collect_list(F.struct("signal", "n"))).alias("topics"))   # one entry per signal type
    docs = per_la.groupBy("file_name").agg(
        F.map_from_entries(F.collect_list(F.struct("unit", F.struct("total_signals", "top_signal", "topics")))).alias("las"))
    run_date = F.regexp_extract("file_name", r"(\d{8})", 1)
    return docs.select("file_name", F.to_json(F.struct(run_date.alias("run_date"), "las")).alias("json"))


def narrative_for_la(documents: DataFrame, la: str, json_col: str = "json", prose: str | None = None) -> DataFrame:
    """Pick one LA out of each narrative document: {run_date, la, prose, data};
    a missing LA gives empty data and total_signals 0."""
    doc = F.from_json(F.col(json_col), NARRATIVE_SCHEMA)
    x = documents.select(doc.alias("d"))
    entry = F.element_at(F.col("d.las"), F.lit(la))
    return x.select(F.col("d.run_date").alias("RUN_DATE"), F.lit(la).alias("LA"),
                    F.lit(prose).cast("string").alias("PROSE"),
                    F.coalesce(entry["total_signals"], F.lit(0)).alias("TOTAL_SIGNALS"),
                    entry["top_signal"].alias("TOP_SIGNAL"))


def narrative_data(documents: DataFrame, la: str, json_col: str = "json", prose: str | None = None) -> DataFrame:
    """The LA's whole object of each narrative document, whatever fields it has, as JSON text in DATA
    (``{}`` for a missing LA), with RUN_DATE, LA and PROSE."""
    doc = F.from_json(F.col(json_col), "run_date string, las map<string, string>")
    x = documents.select(doc.alias("d"))
    return x.select(F.col("d.run_date").alias("RUN_DATE"), F.lit(la).alias("LA"), F.lit(prose).cast("string").alias("PROSE"),
                    F.coalesce(F.element_at("d.las", F.lit(la)), F.lit("{}")).alias("DATA"))


def narrative_json(data: DataFrame) -> DataFrame:
    """Rows of ``narrative_data`` as JSON text, one object {run_date, la, prose, data} each, with the LA's object nested."""
    head = F.to_json(F.struct(F.col("RUN_DATE").alias("run_date"), F.col("LA").alias("la"), F.col("PROSE").alias("prose")), {"ignoreNullFields": "false"})
    return data.select(F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"data":'), F.col("DATA"), F.lit("}")).alias("value"))


# A19 --------------------------------------------------------------------------
def findings_envelope(board: DataFrame, group: str, source: str, board_id: str, pulled_at: str) -> DataFrame:
    """Findings of one group, each row carrying the envelope fields.

    Instead of nesting every finding into one array (a single record that
    grows without bound), the envelope is repeated per finding; a JSON Lines
    sink writes it.  The finding count is one scalar job, which also gives
    the reference's stop when the group is empty.
    """
    f = board.filter(F.col("group_title") == group)
    n = f.count()
    if n == 0:
        raise ValueError(f"no items in group {group!r}")
    return f.select(F.lit(source).alias("SOURCE"), F.lit(board_id).alias("BOARD_ID"),
                    F.lit(group).alias("GROUP_NAME"), F.lit(pulled_at).alias("PULLED_AT"),
                    F.lit(n).cast("bigint").alias("N_FINDINGS"), *[F.col(c) for c in f.columns])


# A21 --------------------------------------------------------------------------
def table_metadata(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Row count and last change (newest file) of tables read from files, by (database, table name).

    One aggregate per table that combines map-side and reads no data column; a table without files has 0 rows and
    no change time.
    """
    parts = [df.agg(F.lit(database).alias("database"), F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                    F.max("_metadata.file_modification_time").cast("timestamp_ntz").alias("last_altered"))
             for (database, name), df in tables.items()]
    return functools.reduce(DataFrame.unionByName, parts)


def landed_metadata(spark: SparkSession, paths: Mapping[tuple[str, str], str]) -> DataFrame:
    """As ``table_metadata``, of Parquet tables by their paths, without reading a row: counts are pushed into the scan, which
    takes them from the files' footers, and times come from the listing (so a table whose files hold no row has one).

    The result belongs to a session of its own with the same settings but for the two that let counts be pushed down."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    parts = []
    for (database, table), path in paths.items():
        named = F.lit(database).alias("database"), F.lit(table).alias("table_name")
        counted, files = own.read.parquet(path).agg(F.count(F.lit(1)).alias("n")), own.read.format("binaryFile").load(path)
        parts += [counted.select(*named, F.col("n").alias("row_count"), F.lit(None).cast("timestamp_ntz").alias("last_altered")),
                  files.agg(F.max("modificationTime").cast("timestamp_ntz").alias("t")).select(*named, F.lit(None).cast("bigint").alias("row_count"), F.col("t").alias("last_altered"))]
    both = functools.reduce(DataFrame.unionByName, parts)
    # files without a row have no count in their footers: the pushed count of a table of such files is NULL
    return both.groupBy("database", "table_name").agg(F.coalesce(F.max("row_count"), F.lit(0)).cast("bigint").alias("row_count"), F.max("last_altered").alias("last_altered"))


def table_staleness(metadata: DataFrame, now: str, databases: Sequence[str], stale_days: int = STALE_DAYS,
                    ordered: bool = False) -> DataFrame:
    """Days since last change (day boundaries crossed) and stale/fresh; a table without a change time is neither."""
    now_ts = F.lit(now).cast("timestamp_ntz")
    x = metadata.filter(F.col("database").isin(list(databases)))
    days = F.datediff(now_ts.cast("date"), F.col("last_altered").cast("date"))
    out = x.select(F.col("database").alias("DATABASE"), F.col("table_name").alias("TABLE_NAME"),
                   F.col("row_count").alias("ROW_COUNT"), F.col("last_altered").alias("LAST_ALTERED"),
                   days.alias("DAYS_SINCE_UPDATE"),
                   F.when(days > stale_days, F.lit("stale")).when(days.isNull(), F.lit("unknown"))
                    .otherwise(F.lit("fresh")).alias("STATUS"))
    return out.orderBy(F.col("DAYS_SINCE_UPDATE").desc_nulls_first()) if ordered else out


# A22 --------------------------------------------------------------------------
def _threshold_seconds(count: Column, period: Column) -> Column:
    mult = (F.when(period == "minute", 60).when(period == "hour", 3600).when(period == "day", 86400))
    return count.cast("bigint") * mult


def source_freshness(loaded: DataFrame, source_config: DataFrame, table_overrides: DataFrame, now: str) -> DataFrame:
    """pass / warn / error per table from warn_after / error_after.

    ``loaded``: (database, table_name, loaded_at).  ``source_config``: one row
    per database with warn_count, warn_period, error_count, error_period
    (NULLs = no check).  ``table_overrides``: (database, table_name, enabled,
    warn_*, error_*), one row per table; a threshold it gives replaces the
    database's, one it leaves out (NULL) stays; enabled = false disables the
    check.  A table without a load time has status unknown.
    """
    now_ts = F.lit(now).cast("timestamp_ntz")
    parts = ("warn_count", "warn_period", "error_count", "error_period")
    cfg = source_config.select("database", *[F.col(c).alias(f"s_{c}") for c in parts])
    ov = table_overrides.select("database", "table_name", F.col("enabled").alias("o_enabled"), *[F.col(c).alias(f"o_{c}") for c in parts])
    x = lookup_join(loaded, cfg, "database", "left")
    x = lookup_join(x, ov, ["database", "table_name"], "left")
    warn, err = (F.coalesce(*[_threshold_seconds(F.col(f"{side}_{k}_count"), F.col(f"{side}_{k}_period")) for side in "os"]) for k in ("warn", "error"))
    enabled = F.coalesce(F.col("o_enabled"), F.lit(True)) & (warn.isNotNull() | err.isNotNull())
    age = F.timestamp_diff("SECOND", F.col("loaded_at").cast("timestamp_ntz"), now_ts)
    status = (F.when(~enabled, F.lit("skipped"))
              .when(age.isNull(), F.lit("unknown"))
              .when(err.isNotNull() & (age > err), F.lit("error"))
              .when(warn.isNotNull() & (age > warn), F.lit("warn"))
              .otherwise(F.lit("pass")))
    return x.select(F.col("database").alias("DATABASE"), F.col("table_name").alias("TABLE_NAME"),
                    age.cast("bigint").alias("AGE_SECONDS"), status.alias("STATUS"))
