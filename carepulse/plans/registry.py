"""Query registry: one Spark DataFrame builder per operator key.

Each builder takes (spark, sf_dir), derives the reference's source shapes
from the driver tables (``Fixtures``) and runs the operator on the whole
tables.  ``carepulse.plans.oracle.SQL`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from carepulse.operators import marts, staging, windows
from carepulse.sources.fixtures import AS_OF, TARGET_LA, Fixtures
from carepulse.sources.tables import DRIVER_TABLES, TableSet

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Builder] = {}


def register(name: str):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = fn
        return fn
    return deco


# ------------------------------------------------------------ shared parts ---
def staged_sources(fx: Fixtures) -> tuple[DataFrame, DataFrame, DataFrame]:
    a = staging.stg_accessava(fx.accessava, fx.accessava_locality, fx.topic_entry_point_map)
    b = staging.stg_advicepro(fx.advicepro_casework, fx.case_topic_bridge, fx.s_c_csi_map,
                              fx.universal_themes_map, fx.advicepro_demographics, fx.casework_locality)
    c = staging.stg_helplines(fx.helplines_aggregated_full)
    return a, b, c


def mentions(fx: Fixtures) -> DataFrame:
    return staging.stg_la_topic_mentions(*staged_sources(fx))


def la_slice(fx: Fixtures) -> DataFrame:
    return staging.slice_las(mentions(fx), [TARGET_LA])


# --------------------------------------------------------------- A1 scan ---
ORDERS_DECLARED = StructType([
    StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
    StructField("o_orderstatus", StringType()), StructField("o_orderpriority", StringType()),
])


@register("scan_source")
def q_scan_source(spark, sf):
    return TableSet(spark, sf)("orders", ORDERS_DECLARED)


# ---------------------------------------------------------------- staging ---
@register("explode_topics")
def q_explode_topics(spark, sf):
    fx = Fixtures.of(spark, sf)
    return staging.explode_topics(fx.accessava).select("transcript_id", "topic_entry_point", "topic_value")


@register("map_topic_to_theme")
def q_map_topic_to_theme(spark, sf):
    fx = Fixtures.of(spark, sf)
    x = staging.explode_topics(fx.accessava).select("transcript_id", "topic_entry_point", "topic_value")
    return staging.map_topic_to_theme(x, fx.topic_entry_point_map).select(
        "transcript_id", "topic_value", "SEGMENT", "UT2")


@register("stg_accessava")
def q_stg_accessava(spark, sf):
    return staged_sources(Fixtures.of(spark, sf))[0]


@register("parse_open_month")
def q_parse_open_month(spark, sf):
    from carepulse.functions.columns import parse_open_month
    c = Fixtures.of(spark, sf).advicepro_casework
    return c.select("case_reference", "case_open_month", parse_open_month("case_open_month").alias("QUERY_DATE"))


@register("map_case_to_theme")
def q_map_case_to_theme(spark, sf):
    fx = Fixtures.of(spark, sf)
    b = fx.case_topic_bridge.select("case_reference", "s_c_csi_id")
    return staging.map_case_to_theme(b, fx.s_c_csi_map, fx.universal_themes_map).select(
        "case_reference", "s_c_csi_id", "SEGMENT", "UT2")


@register("stg_advicepro")
def q_stg_advicepro(spark, sf):
    return staged_sources(Fixtures.of(spark, sf))[1]


@register("stg_helplines")
def q_stg_helplines(spark, sf):
    return staged_sources(Fixtures.of(spark, sf))[2]


@register("stg_la_topic_mentions")
def q_mentions(spark, sf):
    return mentions(Fixtures.of(spark, sf))


@register("stg_la_topic_mentions_slice")
def q_slice(spark, sf):
    return la_slice(Fixtures.of(spark, sf))


@register("monthly_theme_counts")
def q_monthly(spark, sf):
    return staging.monthly_theme_counts(mentions(Fixtures.of(spark, sf)))


@register("taxonomy_key")
def q_taxonomy_key(spark, sf):
    m = Fixtures.of(spark, sf).s_c_csi_map.select("supercategory", "category", "case_specific_issue")
    return staging.with_taxonomy_key(m)


# ---------------------------------------------------------------- windows ---
def _family_builder(family: str) -> Builder:
    def build(spark, sf):
        return windows.family_windows(la_slice(Fixtures.of(spark, sf)), family, AS_OF)
    return build


def _mart_builder(family: str, w: int) -> Builder:
    def build(spark, sf):
        return marts.mart(la_slice(Fixtures.of(spark, sf)), family, w, AS_OF)
    return build


for _fam in windows.FAMILIES:
    REGISTRY[_fam] = _family_builder(_fam)
    for _w in windows.WINDOWS:
        REGISTRY[f"mart_{_fam}_{_w}m"] = _mart_builder(_fam, _w)


@register("trailing_windows")
def q_trailing_windows(spark, sf):
    m = la_slice(Fixtures.of(spark, sf))
    return windows.trailing_windows(m, {"LA_NAME": F.col("LA_NAME"), "SOURCE_SYSTEM": F.col("SOURCE_SYSTEM")},
                                    {"QUERY_COUNT_RAW": F.col("QUERY_COUNT")}, AS_OF)


@register("suppress_small")
def q_suppress_small(spark, sf):
    from carepulse.functions.columns import suppress_small
    s = marts.la_query_summary(mentions(Fixtures.of(spark, sf)))
    return s.withColumn("QUERY_COUNT_DISPLAY", suppress_small("QUERY_COUNT"))


@register("mart_la_query_summary")
def q_la_query_summary(spark, sf):
    return marts.la_query_summary(mentions(Fixtures.of(spark, sf)))


# ---------------------------------------------------------------- chatbot ---
from carepulse.operators import chatbot, checks  # noqa: E402
from carepulse.sources.fixtures import RECON_MONTH  # noqa: E402


@register("conversations_monthly")
def q_conv_monthly(spark, sf):
    return chatbot.conversations_monthly(Fixtures.of(spark, sf).accessava)


@register("conversations_total")
def q_conv_total(spark, sf):
    return chatbot.conversations_total(Fixtures.of(spark, sf).accessava)


@register("top_tenants")
def q_top_tenants(spark, sf):
    return chatbot.top_tenants(chatbot.conversations_total(Fixtures.of(spark, sf).accessava))


@register("persona_bridge")
def q_persona_bridge(spark, sf):
    return chatbot.persona_bridge(Fixtures.of(spark, sf).accessava)


@register("persona_dim")
def q_persona_dim(spark, sf):
    return chatbot.persona_dim(chatbot.persona_bridge(Fixtures.of(spark, sf).accessava))


@register("bridge_diff")
def q_bridge_diff(spark, sf):
    a = Fixtures.of(spark, sf).accessava
    return chatbot.bridge_diff(chatbot.persona_bridge(a), chatbot.legacy_persona_bridge(a))


# ----------------------------------------------------------------- checks ---
@register("test_not_null")
def q_test_not_null(spark, sf):
    fx = Fixtures.of(spark, sf)
    return checks.union_summaries([
        checks.not_null_summary(mentions(fx), "stg_la_topic_mentions", ["LA_NAME", "QUERY_DATE", "SOURCE_SYSTEM"]),
        checks.not_null_summary(fx.accessava, "accessava", ["transcript_id", "tenant_name", "la_name"]),
    ])


@register("test_accepted_values")
def q_test_accepted(spark, sf):
    fx = Fixtures.of(spark, sf)
    return checks.union_summaries([
        checks.accepted_values_summary(mentions(fx), "stg_la_topic_mentions", "SOURCE_SYSTEM",
                                       ["AccessAva", "AdvicePro", "Helplines"]),
        checks.accepted_values_summary(fx.accessava, "accessava", "tenant_name",
                                       ["HOUSEHOLD", "MACHINERY", "FURNITURE", "BUILDING"], "warn"),
    ])


@register("test_unique")
def q_test_unique(spark, sf):
    fx = Fixtures.of(spark, sf)
    return checks.union_summaries([
        checks.unique_summary(fx.s_c_csi_map, "s_c_csi_map", "s_c_csi_id"),
        checks.unique_summary(chatbot.conversations_total(fx.accessava), "conversations_total", "TENANT_NAME"),
        checks.unique_summary(chatbot.persona_bridge(fx.accessava), "persona_bridge", "TRANSCRIPT_ID"),
    ])


def _bridge_with_repeats(fx):
    """The bridge with some pairs a second time, so that the test has something to find."""
    b = chatbot.persona_bridge(fx.accessava)
    return b.unionByName(b.filter(F.col("TRANSCRIPT_ID").endswith("7")))


def _children_with_orphans(fx):
    """Case topics, some with an id that no parent has."""
    orphan = F.when(F.col("case_reference").endswith("1"), F.concat(F.lit("orphan-"), F.col("s_c_csi_id")))
    return fx.case_topic_bridge.withColumn("s_c_csi_id", F.coalesce(orphan, F.col("s_c_csi_id")))


@register("test_unique_combination")
def q_test_unique_combo(spark, sf):
    fx = Fixtures.of(spark, sf)
    return checks.union_summaries([
        checks.unique_combination_summary(chatbot.conversations_monthly(fx.accessava), "conversations_monthly",
                                          ["TENANT_NAME", "CONVERSATION_MONTH"]),
        checks.unique_combination_summary(_bridge_with_repeats(fx), "persona_bridge",
                                          ["TRANSCRIPT_ID", "PERSONA"]),
    ])


@register("test_relationships")
def q_test_relationships(spark, sf):
    fx = Fixtures.of(spark, sf)
    return checks.relationships_summary(_children_with_orphans(fx), "case_topic_bridge", "s_c_csi_id",
                                        fx.s_c_csi_map, "s_c_csi_id")


def _monthly(fx):
    return staging.monthly_theme_counts(mentions(fx))


@register("warn_unmapped_share")
def q_unmapped_share(spark, sf):
    return checks.unmapped_share(_monthly(Fixtures.of(spark, sf)))


@register("unmapped_share_all")
def q_unmapped_share_all(spark, sf):
    return checks.unmapped_share(_monthly(Fixtures.of(spark, sf)), only_failing=False)


@register("recon_model_breakdown")
def q_recon_model(spark, sf):
    return checks.recon_model_breakdown(_monthly(Fixtures.of(spark, sf)), TARGET_LA, RECON_MONTH)


@register("recon_helplines_raw")
def q_recon_help(spark, sf):
    return checks.recon_helplines_raw(Fixtures.of(spark, sf).helplines_aggregated_full, TARGET_LA, RECON_MONTH)


@register("recon_accessava_raw")
def q_recon_ava(spark, sf):
    return checks.recon_accessava_raw(Fixtures.of(spark, sf).accessava, TARGET_LA, RECON_MONTH)


@register("recon_advicepro_raw")
def q_recon_ap(spark, sf):
    fx = Fixtures.of(spark, sf)
    return checks.recon_advicepro_raw(fx.advicepro_casework, fx.case_topic_bridge, TARGET_LA, RECON_MONTH)


@register("fanout_guard")
def q_fanout(spark, sf):
    fx = Fixtures.of(spark, sf)
    # some keys a second time in another spelling, so that the guard has something to find
    m, t = fx.universal_themes_map, fx.topic_entry_point_map
    m = m.unionByName(m.filter(F.col("ut1") == "Care plan").withColumn("t1", F.concat(F.lower("t1"), F.lit("  "))))
    t = t.unionByName(t.filter(F.length("topic_entry_point") % 2 == 0).withColumn("topic_entry_point", F.upper("topic_entry_point")))
    themes = checks.fanout_guard(m, ["t1", "t2"], org="advicepro")
    topics = checks.fanout_guard(t.withColumn("_none", F.lit("")), ["topic_entry_point", "_none"])
    return themes.unionByName(topics)


@register("recon_totals")
def q_recon_totals(spark, sf):
    """Both sides from one read of each source: the rows of the area and month are kept, staged and counted."""
    fx = Fixtures.of(spark, sf)
    ava, cases, topics, help_ = checks.recon_slices(fx.accessava, fx.advicepro_casework, fx.case_topic_bridge, fx.helplines_aggregated_full, TARGET_LA, RECON_MONTH)
    staged = staging.stg_la_topic_mentions(
        staging.stg_accessava(ava, fx.accessava_locality, fx.topic_entry_point_map),
        staging.stg_advicepro(cases, topics, fx.s_c_csi_map, fx.universal_themes_map, fx.advicepro_demographics, fx.casework_locality),
        staging.stg_helplines(help_))
    model = (checks.recon_model_breakdown(staging.monthly_theme_counts(staged), TARGET_LA, RECON_MONTH)
             .groupBy("SOURCE_SYSTEM").agg(F.sum("N").cast("bigint").alias("TOTAL")))
    h = checks.recon_helplines_raw(help_, TARGET_LA, RECON_MONTH).agg(
        F.lit("Helplines").alias("SOURCE_SYSTEM"), F.sum("N").cast("bigint").alias("TOTAL"))
    a = checks.recon_accessava_raw(ava, TARGET_LA, RECON_MONTH).select(
        F.lit("AccessAva").alias("SOURCE_SYSTEM"), F.col("CONVERSATIONS").alias("TOTAL"))
    p = checks.recon_advicepro_raw(cases, topics, TARGET_LA, RECON_MONTH).select(
        F.lit("AdvicePro").alias("SOURCE_SYSTEM"), F.col("TOPIC_PAIRS").alias("TOTAL"))
    return checks.recon_totals(model, h.unionByName(a).unionByName(p))


@register("window_row_counts")
def q_window_rows(spark, sf):
    return checks.window_row_counts(windows.family_windows(la_slice(Fixtures.of(spark, sf)), "query_segments", AS_OF))


@register("source_coverage")
def q_source_coverage(spark, sf):
    return checks.source_coverage(mentions(Fixtures.of(spark, sf)))


# ---------------------------------------------------------------- explore ---
from carepulse.operators import explore  # noqa: E402
from carepulse.sources.fixtures import (  # noqa: E402
    PERIOD_END, PERIOD_START, casework_demo_report, ilta_map_ava, ilta_map_casework)


@register("date_range_filter")
def q_date_range(spark, sf):
    a = Fixtures.of(spark, sf).accessava
    return explore.date_range_filter(a, "created_at", PERIOD_START, PERIOD_END).select("transcript_id", "created_at")


def _ava_long(fx):
    x = explore.date_range_filter(fx.accessava, "created_at", PERIOD_START, PERIOD_END)
    x = x.select("transcript_id", *explore.CHATBOT_FEATURES)
    return explore.unpivot_features(x, ["transcript_id"], explore.CHATBOT_FEATURES, "FEATURE", "ACCESSAVA")


@register("unpivot_features")
def q_unpivot(spark, sf):
    return _ava_long(Fixtures.of(spark, sf))


@register("map_features")
def q_map_features(spark, sf):
    return explore.map_features(_ava_long(Fixtures.of(spark, sf)), ilta_map_ava(spark), ["FEATURE", "ACCESSAVA"])


@register("uncount")
def q_uncount(spark, sf):
    return explore.uncount(casework_demo_report(Fixtures.of(spark, sf)), "Number of Person with Care Needss")


def _chatbot_counts(spark, fx):
    return explore.chatbot_feature_counts(fx.accessava, ilta_map_ava(spark), PERIOD_START, PERIOD_END)


def _casework_counts(spark, fx):
    return explore.casework_feature_counts(casework_demo_report(fx), ilta_map_casework(spark),
                                           PERIOD_START, PERIOD_END)


@register("chatbot_feature_counts")
def q_chatbot_counts(spark, sf):
    return _chatbot_counts(spark, Fixtures.of(spark, sf))


@register("casework_feature_counts")
def q_casework_counts(spark, sf):
    return _casework_counts(spark, Fixtures.of(spark, sf))


@register("combined_feature_totals")
def q_combined_totals(spark, sf):
    fx = Fixtures.of(spark, sf)
    return explore.combined_feature_totals(_chatbot_counts(spark, fx), _casework_counts(spark, fx))


def _combined(fx):
    return explore.combined_interactions(fx.accessava, fx.advicepro_casework)


@register("combined_interactions")
def q_combined(spark, sf):
    return _combined(Fixtures.of(spark, sf))


@register("monthly_series_filled")
def q_series(spark, sf):
    return explore.monthly_series_filled(_combined(Fixtures.of(spark, sf)))


@register("season_table")
def q_season(spark, sf):
    return explore.season_table(explore.monthly_series_filled(_combined(Fixtures.of(spark, sf))))


@register("top_k_categories")
def q_top_cats(spark, sf):
    return explore.top_k_categories(_combined(Fixtures.of(spark, sf)))


@register("top_k_las")
def q_top_las(spark, sf):
    return explore.top_k_las(_combined(Fixtures.of(spark, sf)))


@register("overall_totals")
def q_overall(spark, sf):
    fx = Fixtures.of(spark, sf)
    return explore.overall_totals(fx.accessava, fx.advicepro_casework, _combined(fx))


@register("resource_consumption")
def q_resources(spark, sf):
    return explore.resource_consumption(Fixtures.of(spark, sf).accessava, PERIOD_START, PERIOD_END)


# ----------------------------------------------------------------- ingest ---
from carepulse.operators import ingest  # noqa: E402
from carepulse.sources import fixtures as fxm  # noqa: E402


@register("normalise_columns")
def q_normalise_columns(spark, sf):
    return ingest.normalise_columns(casework_demo_report(Fixtures.of(spark, sf)))


@register("null_placeholders")
def q_null_placeholders(spark, sf):
    return ingest.clean_placeholders(fxm.demographics_report(Fixtures.of(spark, sf)))


@register("clean_demographics")
def q_clean_demographics(spark, sf):
    return ingest.clean_demographics(fxm.demographics_report(Fixtures.of(spark, sf)))


@register("demographics_load_report")
def q_demographics_report(spark, sf):
    raw = fxm.demographics_report(Fixtures.of(spark, sf))
    return ingest.demographics_load_report(raw, ingest.clean_demographics(raw))


@register("incremental_new_keys")
def q_new_keys(spark, sf):
    fx = Fixtures.of(spark, sf)
    rep = ingest.normalise_columns(fxm.postcode_report(fx))
    return ingest.incremental_new_keys(rep, fx.casework_locality, "case_reference")


@register("enrich_postcode")
def q_enrich_postcode(spark, sf):
    fx = Fixtures.of(spark, sf)
    return ingest.enrich_postcode(fxm.postcode_report(fx), fx.casework_locality, fxm.postcode_directory(fx))


def _flags(fx):
    return ingest.with_drift_flag(fxm.manifest_datasets(fx)).select("dataset_id", "DRIFT_FLAG")


def _plan(fx):
    return ingest.manifest_load_plan(fxm.manifest_datasets(fx), fxm.existing_tables(fx), fxm.landed_files(fx))


@register("extract_drift_flag")
def q_drift_flag(spark, sf):
    return _flags(Fixtures.of(spark, sf)).withColumnRenamed("dataset_id", "DATASET_ID")


@register("manifest_load_plan")
def q_load_plan(spark, sf):
    return _plan(Fixtures.of(spark, sf))


@register("tag_provenance")
def q_tag_provenance(spark, sf):
    fx = Fixtures.of(spark, sf)
    return ingest.tag_loaded_rows(fxm.dataset_rows(fx), _plan(fx), _flags(fx), fxm.RUN_ID, fxm.RUN_AT)


@register("external_sources_two_runs")
def q_two_runs(spark, sf):
    """A second load replaces the datasets it brings and leaves the others as the first one wrote them."""
    fx = Fixtures.of(spark, sf)
    target = _landing(spark, sf, "external_sources")
    # a dataset per line number; the second run brings the odd ones, each under the plan's action and provenance tags
    rows = fxm.dataset_rows(fx).withColumn("dataset_id", F.concat(F.lit("line_"), F.col("l_linenumber").cast("string")))
    first = ingest.tag_provenance(rows, "run-1", fxm.RUN_AT, None)
    first.write.mode("overwrite").partitionBy("dataset_id").parquet(target)
    files.replace_datasets(ingest.tag_provenance(rows.filter(F.col("l_linenumber") % 2 == 1), fxm.RUN_ID, fxm.RUN_AT, None), target)
    return spark.read.schema(first.schema).parquet(target).select("dataset_id", "l_linenumber", "l_quantity", "_RUN_ID")


@register("load_summary")
def q_load_summary(spark, sf):
    return ingest.load_summary(_plan(Fixtures.of(spark, sf)))


@register("member_orgs")
def q_member_orgs(spark, sf):
    return ingest.member_orgs(fxm.board_items(Fixtures.of(spark, sf)), fxm.CONTRACTS_GROUP)


@register("standardise_service_type")
def q_standardise(spark, sf):
    from carepulse.functions.columns import standardise_service_type
    b = fxm.board_items(Fixtures.of(spark, sf))
    return b.select("item_name", "Service", standardise_service_type("Service").alias("SERVICE_TYPE"))


@register("service_type_counts")
def q_service_counts(spark, sf):
    return ingest.service_type_counts(ingest.member_orgs(fxm.board_items(Fixtures.of(spark, sf)), fxm.CONTRACTS_GROUP))


@register("member_orgs_summary")
def q_member_summary(spark, sf):
    return ingest.member_orgs_summary(fxm.board_items(Fixtures.of(spark, sf)), fxm.CONTRACTS_GROUP)


@register("latest_snapshot")
def q_latest(spark, sf):
    return ingest.latest_snapshot(fxm.peer_signals(Fixtures.of(spark, sf)))


@register("filter_unit")
def q_filter_unit(spark, sf):
    return ingest.filter_unit(ingest.latest_snapshot(fxm.peer_signals(Fixtures.of(spark, sf))), TARGET_LA)


@register("narrative_for_la")
def q_narrative(spark, sf):
    docs = ingest.narrative_documents(fxm.peer_signals(Fixtures.of(spark, sf)))
    return ingest.narrative_for_la(docs, TARGET_LA)


@register("findings_envelope")
def q_findings(spark, sf):
    return ingest.findings_envelope(fxm.board_items(Fixtures.of(spark, sf)), fxm.FINDINGS_GROUP,
                                    "Hypothesis board", "board-1", fxm.RUN_AT)


@register("table_metadata")
def q_table_metadata(spark, sf):
    """Row counts of every landed table, from the files' footers; the files' times are only checked to be there."""
    tables = TableSet(spark, sf)
    found = ingest.landed_metadata(spark, {("LANDED", n.upper()): tables.path(n) for n in DRIVER_TABLES})
    return found.select(F.col("database").alias("DATABASE"), F.col("table_name").alias("TABLE_NAME"),
                        F.col("row_count").alias("ROW_COUNT"), F.col("last_altered").isNotNull().alias("HAS_CHANGE_TIME"))


@register("table_staleness")
def q_staleness(spark, sf):
    return ingest.table_staleness(fxm.table_metadata(Fixtures.of(spark, sf)), fxm.NOW, fxm.STALENESS_DATABASES)


@register("source_freshness")
def q_freshness(spark, sf):
    fx = Fixtures.of(spark, sf)
    loaded = fxm.table_metadata(fx).select("database", "table_name", F.col("last_altered").alias("loaded_at"))
    return ingest.source_freshness(loaded, fxm.freshness_config(spark), fxm.freshness_overrides(fx), fxm.NOW)


# ------------------------------------------------------ file round trips ---
# These land data derived from the driver tables in the session's shared
# checkpoint folder, run the file operator, and read the result back.  The
# folders are fixed per key and data folder and are overwritten each run.
import hashlib  # noqa: E402

from carepulse.session import ensure_checkpoint_dir  # noqa: E402
from carepulse.sources import files  # noqa: E402

HELPLINES_SCHEMA = StructType([StructField("la_name", StringType()), StructField("month_date", DateType()),
                               StructField("ut1", StringType()), StructField("n", LongType())])


def _landing(spark, sf: str, key: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    tag = hashlib.sha1(sf.rstrip("/").encode()).hexdigest()[:10]
    return f"{base}/carepulse-landing/{tag}/{key}"


@register("scan_csv_dataset")
def q_scan_csv(spark, sf):
    folder = _landing(spark, sf, "csv")
    fx = Fixtures.of(spark, sf)
    fx.helplines_aggregated_full.write.mode("overwrite").option("header", True).csv(f"{folder}/helplines.csv")
    return files.scan_csv_dataset(spark, folder, "helplines", HELPLINES_SCHEMA)


@register("append_locality")
def q_append_locality(spark, sf):
    from carepulse.operators import ingest as _ingest
    target = _landing(spark, sf, "locality_target")
    fx = Fixtures.of(spark, sf)
    null = F.lit(None).cast("string")
    initial = fx.casework_locality.select(F.col("case_reference").alias("CASE_REFERENCE"), null.alias("LA_NAME"),
                                          F.col("county").alias("COUNTY"), null.alias("COUNTY_CODE"))
    initial.write.mode("overwrite").parquet(target)
    existing = spark.read.parquet(target).select(F.col("CASE_REFERENCE").alias("case_reference"))
    new = _ingest.enrich_postcode(fxm.postcode_report(fx), existing, fxm.postcode_directory(fx))
    files.append_new_rows(new, target, "CASE_REFERENCE")
    files.append_new_rows(new, target, "CASE_REFERENCE")   # a rerun appends nothing
    return spark.read.parquet(target)


@register("export_json")
def q_export_json(spark, sf):
    folder = _landing(spark, sf, "export")
    m = marts.mart(la_slice(Fixtures.of(spark, sf)), "locality_overview", 12, AS_OF)
    files.export_json([("mart_locality_overview_12m", m)], folder)
    schema = "LA_NAME string, LOCALITY_NAME string, QUERY_COUNT_DISPLAY string, TIME_WINDOW_MONTHS int"
    return spark.read.schema(schema).json(f"{folder}/mart_locality_overview_12m")


@register("trailing_windows_shared")
def q_windows_shared(spark, sf):
    agg = windows.family_aggregate(la_slice(Fixtures.of(spark, sf)), AS_OF)
    return windows.families_from_aggregate(agg)["query_segments"]


# every LA, not one: a family's grouping is then the size of the data
def _all_las(family):
    return lambda spark, sf: windows.family_windows(mentions(Fixtures.of(spark, sf)), family, AS_OF)


for _fam in windows.FAMILIES:
    REGISTRY[f"{_fam}_all_las"] = _all_las(_fam)


@register("narrative_data")
def q_narrative_data(spark, sf):
    """Topics out of the LA's whole object, for every snapshot."""
    docs = ingest.narrative_documents(fxm.peer_signals(Fixtures.of(spark, sf)))
    data = F.from_json("DATA", "total_signals int, topics array<struct<signal: string, n: bigint>>")
    x = ingest.narrative_data(docs, TARGET_LA).select("RUN_DATE", data.alias("d"))
    return x.select("RUN_DATE", F.col("d.total_signals").alias("TOTAL_SIGNALS"), F.explode("d.topics").alias("t")).select(
        "RUN_DATE", "TOTAL_SIGNALS", F.col("t.signal").alias("SIGNAL"), F.col("t.n").alias("N"))


def _land_manifest(spark, sf):
    """A manifest document of one dataset per supplier, in a landing folder."""
    path = f"{_landing(spark, sf, 'external')}/manifest.json"
    k = F.col("s_suppkey")
    status = F.when(k % 4 == 0, "SUCCESS").when(k % 4 == 1, "NO_UPDATE").when(k % 4 == 2, "LIMITATION").otherwise("PARTIAL")
    drift = F.array(F.struct(F.lit("SCHEMA_DRIFT").alias("code"), F.lit("m").alias("message"), F.lit("d").alias("details")))
    dataset = F.struct(F.concat(F.lit("supplier_"), k.cast("string")).alias("dataset_id"), status.alias("status"),
                       F.struct(F.when(k % 8 == 0, drift).alias("warnings")).alias("provenance"))
    # one document by nature, an entry per dataset
    doc = Fixtures.of(spark, sf).t("supplier").agg(F.collect_list(dataset).alias("datasets"))
    doc.select(F.to_json(F.struct(F.lit("run-x").alias("run_id"), F.lit("now").alias("run_at"), "datasets")).alias("value")).write.mode("overwrite").text(path)
    return path


@register("manifest_datasets")
def q_manifest_datasets(spark, sf):
    from carepulse.plans.external import read_manifest
    x = ingest.with_drift_flag(read_manifest(spark, _land_manifest(spark, sf)))
    return x.select("run_id", "dataset_id", "status", F.col("DRIFT_FLAG").isNotNull().alias("drifted"))


# ------------------------------------------------- tables that are kept up ---
import dataclasses  # noqa: E402
import json  # noqa: E402
import uuid  # noqa: E402

from carepulse.operators import distinct, incremental, membership  # noqa: E402
from carepulse.plans import pipeline  # noqa: E402
from carepulse.plans.external import load_external_sources  # noqa: E402
from carepulse.sources import layout, versioned  # noqa: E402


def _fresh(spark, sf: str, key: str) -> str:
    """A folder of this run's own, for what starts from nothing."""
    return f"{_landing(spark, sf, key)}/{uuid.uuid4().hex}"


def _put_manifest(spark, folder: str, run: str, datasets: list[tuple[str, str, bool]]) -> None:
    warning = {"warnings": [{"code": "SCHEMA_DRIFT", "message": "m", "details": "d"}]}
    doc = {"run_id": run, "run_at": fxm.RUN_AT, "datasets": [{"dataset_id": d, "status": s, **({"provenance": warning} if w else {})} for d, s, w in datasets]}
    spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/manifest.json")


@register("external_load")
def q_external_load(spark, sf):
    """Two loads of datasets with columns of their own, from manifest and CSV files to published tables: the second
    replaces what it brings, loads one for the first time, and leaves the skipped ones as they were."""
    fx, base = Fixtures.of(spark, sf), _fresh(spark, sf, "external_load")
    land, target = f"{base}/land", f"{base}/tables"
    lines = fx.t("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").withColumnsRenamed({"l_orderkey": "k", "l_linenumber": "v"})
    orders = fx.t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v"), "o_orderstatus")
    put = lambda df, name: df.write.mode("overwrite").option("header", True).csv(f"{land}/{name}.csv")
    for flag in ("A", "N", "R"):
        put(lines.filter(F.col("l_returnflag") == flag).drop("l_returnflag"), f"lines_{flag}")
    put(orders.filter(F.col("o_orderstatus") == "F"), "orders_F")
    put(orders.filter(F.col("o_orderstatus") == "P"), "orders_P")
    plain, status = "k bigint, v bigint", "k bigint, v bigint, o_orderstatus string"
    schemas = {**{f"lines_{f}": plain for f in "AN"}, "orders_F": status, "orders_O": status}
    _put_manifest(spark, land, "run-1", [("lines_A", "SUCCESS", False), ("lines_N", "SUCCESS", True), ("lines_R", "SUCCESS", False), ("orders_F", "SUCCESS", False), ("orders_P", "LIMITATION", False)])
    load_external_sources(spark, land, target, schemas)
    put(lines.filter((F.col("l_returnflag") == "R") & (F.col("v") % 2 == 1)).drop("l_returnflag"), "lines_R")
    put(orders.filter(F.col("o_orderstatus") == "O"), "orders_O")
    _put_manifest(spark, land, fxm.RUN_ID, [("lines_A", "NO_UPDATE", True), ("lines_R", "SUCCESS", True), ("orders_F", "SUCCESS", False), ("orders_O", "NO_UPDATE", False), ("orders_P", "LIMITATION", False)])
    load_external_sources(spark, land, target, schemas)
    parts = [versioned.read_table(spark, f"{target}/{n}").select(F.lit(n).alias("DATASET_ID"), F.col("k").cast("bigint").alias("K"), F.col("v").cast("bigint").alias("V"), F.col("_RUN_ID").alias("RUN_ID"), F.col("_DRIFT_FLAG").isNotNull().alias("DRIFTED"))
             for n in versioned.list_tables(spark, target)]
    return checks.union_summaries(parts)


@register("declared_tests")
def q_declared_tests(spark, sf):
    """Every declared test: on the rows while the models are written, on sets from the written tables."""
    src = pipeline.Sources.from_fixtures(Fixtures.of(spark, sf))
    # a landed table in the reference: the staged cases and the relationships test read it, its joins run once
    bridge = layout.made_once(src.case_topic_bridge.select("case_reference", "s_c_csi_id"), "bridge")
    src = dataclasses.replace(src, case_topic_bridge=bridge)
    return pipeline.build_models(spark, src, _fresh(spark, sf, "declared_tests"))[1]


@register("windows_by_month")
def q_windows_by_month(spark, sf):
    """Windows over mentions that are laid out by month: the scan opens the folders of the longest window only."""
    laid = versioned.publish(layout.by_month(layout.made_once(mentions(Fixtures.of(spark, sf)), "staged")), _fresh(spark, sf, "mentions"), [windows.MONTH_COL])
    return windows.family_windows(laid, "query_segments", AS_OF)


def _long(families: dict[str, DataFrame]) -> DataFrame:
    """All intermediates as one table: the dimension beside the area as text."""
    parts = []
    for family, dims in windows.FAMILY_SETS.items():
        df = families[family]
        dim = F.col(dims[1]).cast("string") if len(dims) > 1 else F.lit(None).cast("string")
        letters = F.col("HAS_LETTER_RAW") if family == "legal_letters" else F.lit(None).cast("bigint")
        parts.append(df.select(F.lit(family).alias("FAMILY"), "LA_NAME", dim.alias("DIM"), "QUERY_COUNT_RAW", letters.alias("HAS_LETTER_RAW"), windows.WINDOW_COL))
    return checks.union_summaries(parts)


@register("windows_incremental")
def q_windows_incremental(spark, sf):
    """Every family of every LA after a first build and two loads at later dates, each from the state before it."""
    m = mentions(Fixtures.of(spark, sf)).checkpoint()
    dates = ["2001-06-30", "2001-07-31", AS_OF]
    when = F.when(F.col("QUERY_DATE") <= dates[0], 0).when(F.col("QUERY_DATE") <= dates[1], F.pmod(F.xxhash64(*m.columns), F.lit(3)).cast("int")).otherwise(2)
    days = incremental.daily_sums(m.filter(when == 0)).checkpoint()
    totals = incremental.window_totals(days, dates[0]).checkpoint()
    for i in (1, 2):
        new = incremental.daily_sums(m.filter(when == i)).checkpoint()
        totals = incremental.advance(totals, days, new, dates[i - 1], dates[i]).checkpoint()
        days = incremental.recent(incremental.add_days(days, new), dates[i])
    return _long(incremental.families(totals))


def _bitmaps(spark, sf):
    """The monthly bitmaps of two loads, merged; the second load's conversations get keys after the first one's."""
    rows = Fixtures.of(spark, sf).accessava.select("transcript_id", "tenant_name", "created_at").checkpoint()
    late = F.pmod(F.xxhash64("transcript_id", "created_at"), F.lit(4)) == 0
    first, second = rows.filter(~late), rows.filter(late)
    keys = chatbot.dense_keys(first, "transcript_id", distinct.KEY).checkpoint()
    both = keys.unionByName(chatbot.extend_keys(keys, second, "transcript_id", distinct.KEY))
    return distinct.merge_bitmaps(distinct.conversation_bitmaps(first, keys), distinct.conversation_bitmaps(second, both))


@register("conversations_monthly_bitmaps")
def q_monthly_bitmaps(spark, sf):
    return distinct.monthly_from_bitmaps(_bitmaps(spark, sf))


@register("conversations_total_bitmaps")
def q_total_bitmaps(spark, sf):
    return distinct.total_from_bitmaps(_bitmaps(spark, sf))


@register("incremental_new_keys_filtered")
def q_new_keys_filtered(spark, sf):
    """As ``incremental_new_keys``, by the target's stored key filter: two appends, the second's keys merged in."""
    fx = Fixtures.of(spark, sf)
    rep = ingest.normalise_columns(fxm.postcode_report(fx))
    known, key = fx.casework_locality, "case_reference"
    blocks = membership.blocks_for(known.count())
    early = F.pmod(F.xxhash64(key), F.lit(3)) > 0
    stored = membership.merge_filters(membership.key_filter(known.filter(early), key, blocks), membership.key_filter(known.filter(~early), key, blocks))
    return membership.new_rows(rep, key, stored, blocks, known)


@register("locality_stream")
def q_locality_stream(spark, sf):
    """Reports that repeat cases, landed in two goes: the stream appends each new case once."""
    from carepulse.streaming.locality import start_locality_stream
    fx, base = Fixtures.of(spark, sf), _fresh(spark, sf, "locality_stream")
    rep = fxm.postcode_report(fx)
    early = F.pmod(F.xxhash64("Case Reference"), F.lit(2)) == 0
    for part in (rep.filter(early).unionByName(rep.filter(early)), rep):
        part.write.mode("append").option("header", True).csv(f"{base}/landing")
        start_locality_stream(spark, f"{base}/landing", f"{base}/target", fxm.postcode_directory(fx), checkpoint=f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/target")


@register("latest_snapshot_by_folder")
def q_latest_by_folder(spark, sf):
    """As ``latest_snapshot``, with a folder per snapshot: the folders' names tell the last, and it alone is read."""
    signals, table = fxm.peer_signals(Fixtures.of(spark, sf)), _fresh(spark, sf, "signals")
    signals.repartition("file_name").write.partitionBy("file_name").parquet(table)
    return files.latest_partition(spark, table, "file_name", signals.schema).select(*signals.columns)
