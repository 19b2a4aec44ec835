"""Daily batch: sources -> staging -> windows -> marts -> tests -> export.

Materialisation points are published tables (``sources.versioned``: parquet,
replaced whole or not at all) under ``out_dir``, which on a cluster must be
shared storage.  Writing the staged mentions once cuts the lineage: every
downstream aggregate re-reads that table instead of re-running the joins, and
a lost executor only recomputes from there.  Mentions are laid out by month
and area, so windows open the folders of their months; the windowed
intermediates are written partitioned by TIME_WINDOW_MONTHS, so each mart is a
partition-pruned read.  Tests that rows pass or fail on their own are counted
while a model is written; the others read the written tables.
"""

from __future__ import annotations

import dataclasses
import functools
import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carepulse.operators import chatbot, checks, incremental, marts, staging, windows
from carepulse.plans.external import load_external_sources
from carepulse.sources import layout
from carepulse.sources.files import export_json
from carepulse.sources.versioned import current_version, publish, read_table

log = logging.getLogger(__name__)


@dataclass
class Sources:
    accessava: DataFrame
    accessava_locality: DataFrame
    topic_entry_point_map: DataFrame
    advicepro_casework: DataFrame
    case_topic_bridge: DataFrame
    s_c_csi_map: DataFrame
    universal_themes_map: DataFrame
    advicepro_demographics: DataFrame
    casework_locality: DataFrame
    helplines_aggregated_full: DataFrame
    people_receiving_care: DataFrame

    @classmethod
    def from_fixtures(cls, fx) -> Sources:
        return cls(**{f: getattr(fx, f) for f in cls.__dataclass_fields__})

    @classmethod
    def from_paths(cls, spark: SparkSession, root: str, fmt: str = "parquet") -> Sources:
        """Landed source tables ``<root>/<name>`` read with declared schemas."""
        from carepulse.sources.schemas import SOURCE_SCHEMAS
        from carepulse.sources.tables import scan_source
        return cls(**{f: scan_source(spark, f"{root.rstrip('/')}/{f}", SOURCE_SCHEMAS[f], fmt)
                      for f in cls.__dataclass_fields__})

    def with_loaded(self, out_dir: str, locality_target: str) -> Sources:
        """These sources with the tables that ``run_loaders`` wrote: cleaned demographics, enriched localities and, where
        it is loaded, people receiving care."""
        spark, out = self.accessava.sparkSession, out_dir.rstrip("/")
        own = {"advicepro_demographics": read_table(spark, f"{out}/advicepro_demographics").select("case_reference", "age_range"),
               "casework_locality": spark.read.parquet(locality_target).select(F.col("CASE_REFERENCE").alias("case_reference"), F.col("COUNTY").alias("county"))}
        if current_version(spark, f"{out}/external_sources/people_receiving_care"):
            own["people_receiving_care"] = read_table(spark, f"{out}/external_sources/people_receiving_care")
        return dataclasses.replace(self, **own)

    def land(self, root: str) -> None:
        """Write every source table under ``root`` (fixtures -> landed data)."""
        for f in self.__dataclass_fields__:
            getattr(self, f).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{f}")


SYSTEMS = (staging.SOURCE_ACCESSAVA, staging.SOURCE_ADVICEPRO, staging.SOURCE_HELPLINES)
_PART = "_part"

#: The declared tests that a row passes or fails on its own, by the table they are counted on when it is written.  The
#: staged parts are tested as they are staged, each against its own source system.
ROW_TESTS: dict[str, list[checks.ColumnTest]] = {
    "stg_la_topic_mentions": [
        *[t for part in ("stg_accessava", "stg_advicepro", "stg_helplines") for t in checks.not_nulls(part, ["LA_NAME", "QUERY_DATE"])],
        *[checks.ColumnTest(part, "accepted_values", "SOURCE_SYSTEM", (system,)) for part, system in zip(("stg_accessava", "stg_advicepro", "stg_helplines"), SYSTEMS, strict=True)],
        *checks.not_nulls("stg_la_topic_mentions", ["LA_NAME", "QUERY_DATE", "SOURCE_SYSTEM"]),
        checks.ColumnTest("stg_la_topic_mentions", "accepted_values", "SOURCE_SYSTEM", SYSTEMS)],
    "helplines_advicepro_accessava": [
        *checks.not_nulls("helplines_advicepro_accessava", ["LA_NAME", "MONTH_DATE", "SOURCE_SYSTEM", "UT1", "QUERY_COUNT"]),
        checks.ColumnTest("helplines_advicepro_accessava", "accepted_values", "SOURCE_SYSTEM", SYSTEMS)],
    "mart_la_query_summary": [
        *checks.not_nulls("mart_la_query_summary", ["LA_NAME", "SOURCE_SYSTEM", "QUERY_COUNT"]),
        checks.ColumnTest("mart_la_query_summary", "accepted_values", "SOURCE_SYSTEM", SYSTEMS)],
    "conversations_monthly": checks.not_nulls("conversations_monthly", ["TENANT_NAME", "CONVERSATION_MONTH", "CONVERSATION_COUNT"]),
    "conversations_total": checks.not_nulls("conversations_total", ["TENANT_NAME", "TOTAL_CONVERSATIONS"]),
    "persona_bridge": checks.not_nulls("persona_bridge", ["TRANSCRIPT_ID", "PERSONA"]),
    "persona_dim": checks.not_nulls("persona_dim", ["PERSONA_ID", "PERSONA"]),
}
#: What the metric of people receiving care may be.
CARE_METRICS = ("new_clients", "long_term_clients")


def staged_parts(src: Sources) -> dict[str, DataFrame]:
    return {"stg_accessava": staging.stg_accessava(src.accessava, src.accessava_locality, src.topic_entry_point_map),
            "stg_advicepro": staging.stg_advicepro(src.advicepro_casework, src.case_topic_bridge, src.s_c_csi_map,
                                                   src.universal_themes_map, src.advicepro_demographics, src.casework_locality),
            "stg_helplines": staging.stg_helplines(src.helplines_aggregated_full)}


def _tested(name: str, df: DataFrame, path: str, results: list[tuple], partition_by: Sequence[str] = ()) -> DataFrame:
    """Publish a model, counting the failures of its row tests on the way."""
    tests = ROW_TESTS[name]
    parts = {t.model: F.col(_PART) == t.model for t in tests if t.model != name}
    seen, observation = checks.observe_tests(df, tests, parts)
    out = publish(seen.drop(_PART), path, partition_by)
    results += checks.observed_results(tests, observation)
    return out


def build_models(spark: SparkSession, src: Sources, out_dir: str, parts: dict[str, DataFrame] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Staging, summary and chatbot models, and one summary row for each declared test of them and of their sources.

    ``parts`` replaces the staged parts (tests of the tests do)."""
    out, built, results = out_dir.rstrip("/"), {}, []
    parts = parts or staged_parts(src)
    union = functools.reduce(DataFrame.unionByName, [p.withColumn(_PART, F.lit(name)) for name, p in parts.items()])
    mentions = _tested("stg_la_topic_mentions", layout.by_month(layout.made_once(union, "staged")), f"{out}/stg_la_topic_mentions", results, [windows.MONTH_COL])
    built["stg_la_topic_mentions"] = mentions
    monthly = _tested("helplines_advicepro_accessava", staging.monthly_theme_counts(mentions), f"{out}/helplines_advicepro_accessava", results)
    built["helplines_advicepro_accessava"] = monthly
    built["mart_la_query_summary"] = _tested("mart_la_query_summary", marts.la_query_summary(mentions), f"{out}/mart_la_query_summary", results)

    # chatbot
    for name, df, table in (("conversations_monthly", chatbot.conversations_monthly(src.accessava), "mart_chatbot_conversations_by_tenant_monthly"),
                            ("conversations_total", chatbot.conversations_total(src.accessava), "mart_chatbot_conversations_by_tenant_total"),
                            ("persona_bridge", chatbot.persona_bridge(src.accessava), "persona_bridge")):
        built[name] = _tested(name, df, f"{out}/{table}", results)
    built["persona_dim"] = _tested("persona_dim", chatbot.persona_dim(built["persona_bridge"]), f"{out}/persona_dim", results)

    on_write = spark.createDataFrame(results, checks.SUMMARY_SCHEMA)
    summary = checks.with_status(checks.union_summaries([on_write, *set_tests(built, src)]))
    built["test_results"] = publish(summary, f"{out}/test_results")
    return built, built["test_results"]


def set_tests(built: dict[str, DataFrame], src: Sources) -> list[DataFrame]:
    """Summaries of the declared tests that compare rows, and of those on sources, which nobody writes here."""
    return [
        checks.unique_combination_summary(built["conversations_monthly"], "conversations_monthly", ["TENANT_NAME", "CONVERSATION_MONTH"]),
        checks.unique_summary(built["conversations_total"], "conversations_total", "TENANT_NAME"),
        checks.unique_summary(built["persona_dim"], "persona_dim", "PERSONA_ID"),
        checks.unique_summary(built["persona_dim"], "persona_dim", "PERSONA"),
        checks.unique_summary(src.s_c_csi_map, "s_c_csi_map", "s_c_csi_id"),
        checks.not_null_summary(src.s_c_csi_map, "s_c_csi_map", ["s_c_csi_id"]),
        checks.relationships_summary(src.case_topic_bridge, "case_topic_bridge", "s_c_csi_id", src.s_c_csi_map, "s_c_csi_id"),
        checks.accepted_values_summary(src.people_receiving_care, "people_receiving_care", "metric", CARE_METRICS, "warn"),
        # fan-out guards: map keys that collide after lower/trim multiply rows
        checks.fanout_guard(src.universal_themes_map, ["t1", "t2"], org=staging.ADVICEPRO_ORG).agg(
            *checks.summary_columns("universal_themes_map", "fanout_guard", "t1,t2", "warn", F.count(F.lit(1)))),
        checks.fanout_guard(src.topic_entry_point_map.withColumn("_k2", F.lit("")), ["topic_entry_point", "_k2"]).agg(
            *checks.summary_columns("topic_entry_point_map", "fanout_guard", "topic_entry_point", "warn", F.count(F.lit(1)))),
    ]


def build_marts(built: dict[str, DataFrame], intermediates: dict[str, DataFrame], out: str, workers: int = 4) -> None:
    """Publish the seven intermediates by window, and the 35 suppressed slices of them, some at a time: they are small."""
    def family(item) -> dict[str, DataFrame]:
        fam, inter = item[0], publish(item[1], f"{out}/int_{item[0]}", [windows.WINDOW_COL])
        made = {f"int_{fam}": inter}
        for w in windows.WINDOWS:
            made[f"mart_{fam}_{w}m"] = publish(marts.mart(None, fam, w, intermediate=inter), f"{out}/mart_{fam}_{w}m")
        return made

    spark = next(iter(intermediates.values())).sparkSession
    with ThreadPoolExecutor(workers) as pool:
        for made in pool.map(inheritable_thread_target(spark)(family), intermediates.items()):
            built.update(made)


def build_all(spark: SparkSession, src: Sources, as_of: str, las: Sequence[str], out_dir: str,
              export_dir: str | None = None, fail_on_error: bool = True) -> dict[str, DataFrame]:
    out = out_dir.rstrip("/")
    built, results = build_models(spark, src, out)

    # windows: every family and window from ONE scan of the slice (grouping sets): sums by day, which later loads are
    # added to (``advance_windows``), the windows' totals from them, then a split per family
    days = incremental.recent(incremental.daily_sums(staging.slice_las(built["stg_la_topic_mentions"], las)), as_of).checkpoint()
    totals = _publish_state(days, incremental.window_totals(days, as_of), as_of, None, out)[1]
    build_marts(built, incremental.families(totals), out)

    # a row per declared test and per source system: as many as are declared, whatever the data
    rows = results.collect()
    failed = [r for r in rows if r.STATUS == "fail"]
    for r in [r for r in rows if r.STATUS == "warn"]:
        log.warning("test warn: %s.%s %s (%s failures)", r.MODEL, r.COLUMN_NAME, r.TEST_NAME, r.FAILURES)
    drift = checks.unmapped_share(built["helplines_advicepro_accessava"])
    for r in drift.collect():
        log.warning("unmapped share %s: %s%%", r.SOURCE_SYSTEM, r.UNMAPPED_PCT)
    if failed and fail_on_error:
        raise RuntimeError(f"{len(failed)} data test(s) failed: "
                           + ", ".join(f"{r.MODEL}.{r.COLUMN_NAME}:{r.TEST_NAME}" for r in failed))

    if export_dir:
        for name, result in export_json([(n, df) for n, df in built.items() if n.startswith("mart_")], export_dir).items():
            if result != "ok":
                log.warning("export %s: %s", name, result)
    return built


#: What a run hands to the next: sums by day of the longest window, and the windows' totals (no month), in one table that
#: is replaced whole, with the date and the last load that they stand for.
WINDOW_STATE = "family_window_state"


def _publish_state(days: DataFrame, totals: DataFrame, as_of: str, load: str | None, out: str) -> tuple[DataFrame, DataFrame]:
    both = days.unionByName(totals, allowMissingColumns=True)
    state = publish(both.withColumns({"AS_OF": F.lit(str(as_of)), "LOAD_ID": F.lit(load).cast("string")}), f"{out}/{WINDOW_STATE}", [windows.MONTH_COL])
    return _state_parts(state)


def _state_parts(state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The day sums and the totals of a state; both filters prune folders."""
    month, state = F.col(windows.MONTH_COL), state.drop("AS_OF", "LOAD_ID")
    return state.filter(month.isNotNull()).drop(windows.WINDOW_COL), state.filter(month.isNull()).drop(incremental.DAY, windows.MONTH_COL)


def advance_windows(spark: SparkSession, loaded: DataFrame, load: str, as_of: str, las: Sequence[str], out_dir: str) -> dict[str, DataFrame]:
    """Move the windows that ``build_all`` published on to ``as_of`` with the mentions ``loaded`` since, and publish the
    intermediates and marts again.  Earlier mentions are not read, only the sums of the days that leave a window.

    ``load`` names the load: one that the state has already is not added a second time when a run is repeated."""
    out, built = out_dir.rstrip("/"), {}
    state = read_table(spark, f"{out}/{WINDOW_STATE}")
    at = state.agg(F.max("AS_OF").alias("AS_OF"), F.max("LOAD_ID").alias("LOAD_ID")).head()
    days, totals = _state_parts(state)
    if at["LOAD_ID"] != load:
        new = incremental.daily_sums(staging.slice_las(loaded, las)).checkpoint()
        moved = incremental.advance(totals, days, new, at["AS_OF"] or str(as_of), as_of)
        kept = incremental.recent(incremental.add_days(days, new), as_of)
        totals = _publish_state(kept, moved, as_of, load, out)[1]
    build_marts(built, incremental.families(totals), out)
    return built


# ----------------------------------------------------------------- loaders ---
@dataclass
class LoaderInputs:
    """What the upstream pulls landed, as DataFrames (one per loader)."""
    board: DataFrame                  # member-org board items
    demographics_report: DataFrame    # casework demographics export
    postcode_report: DataFrame        # case reference + postcode export
    postcode_directory: DataFrame     # postcode -> geography
    external_folder: str              # manifest.json and a CSV file per landed dataset
    external_schemas: dict = dataclasses.field(default_factory=dict)   # declared types by dataset


def run_loaders(inputs: LoaderInputs, out_dir: str, contracts_group: str, locality_target: str) -> dict[str, str]:
    """Stage 1: the four loaders in order; every loader runs, failures are
    counted, and the stage fails at the end if any loader failed."""
    from carepulse.operators import ingest
    from carepulse.sources.files import append_new_rows
    from carepulse.sources.keyed import unseen

    out = out_dir.rstrip("/")
    spark = inputs.board.sparkSession
    results: dict[str, str] = {}

    def member_orgs():
        orgs = ingest.member_orgs(inputs.board, contracts_group, check_nonempty=True)
        publish(orgs, f"{out}/member_orgs")

    def demographics():
        raw = ingest.require_rows(inputs.demographics_report, "demographics report")
        cleaned = publish(ingest.clean_demographics(raw), f"{out}/advicepro_demographics")
        report = ingest.demographics_load_report(raw, cleaned).first()
        if report["AT_PAGE_LIMIT"]:
            log.warning("demographics: %s rows is the report's page limit, rows may be missing", report["N_IN"])
        if report["N_DROPPED"]:
            log.warning("demographics: %s duplicate row(s) dropped", report["N_DROPPED"])

    def external_sources():
        load_external_sources(spark, inputs.external_folder, f"{out}/external_sources", inputs.external_schemas)

    def locality():
        report = unseen(ingest.normalise_columns(inputs.postcode_report), "case_reference", locality_target, "CASE_REFERENCE")
        new = ingest.enrich_postcode(report, None, inputs.postcode_directory)
        append_new_rows(new, locality_target, "CASE_REFERENCE", check_unique=True)

    for name, step in (("member_orgs", member_orgs), ("demographics", demographics),
                       ("external_sources", external_sources), ("locality", locality)):
        try:
            step()
            results[name] = "ok"
        except Exception as e:  # noqa: BLE001 - counted, reported together below
            log.error("loader %s failed: %s", name, e)
            results[name] = f"failed: {e}"
    failed = [n for n, r in results.items() if r != "ok"]
    if failed:
        raise RuntimeError(f"{len(failed)} loader(s) failed: {', '.join(failed)}")
    return results


def run_monitoring(metadata: DataFrame, source_config: DataFrame, table_overrides: DataFrame, now: str,
                   databases: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Stage 5 (non-fatal): staleness per table and source freshness."""
    from carepulse.operators import ingest
    stale = ingest.table_staleness(metadata, now, databases)
    loaded = metadata.select("database", "table_name", F.col("last_altered").alias("loaded_at"))
    fresh = ingest.source_freshness(loaded, source_config, table_overrides, now)
    return stale, fresh
