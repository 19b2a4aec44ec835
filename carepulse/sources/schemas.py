"""Declared schemas of the source tables (the source registry).

Reading with a declared schema skips inference and, for parquet, reads only
the declared columns.  Names are the lower-case source column names; the
pipeline's outputs use upper-case names.
"""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)


def _s(*cols: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


S, D, L = StringType(), DateType(), LongType()

SOURCE_SCHEMAS: dict[str, StructType] = {
    "accessava": _s(("transcript_id", S), ("created_at", D), ("tenant_name", S), ("la_name", S),
                    ("topic_entry_point", S), ("age", S), ("lettercode", S), ("persona", S),
                    ("supercategories", S), ("disability_text", S), ("disability_n_y", S), ("age_range", S),
                    ("ethnicity", S), ("consumed_resources", S), ("letter_downloaded", BooleanType())),
    "accessava_locality": _s(("transcript_id", S), ("county", S)),
    "topic_entry_point_map": _s(("topic_entry_point", S), ("ut1", S), ("ut2", S)),
    "advicepro_casework": _s(("case_reference", S), ("case_open_month", S), ("la_name", S), ("super_category", S)),
    "case_topic_bridge": _s(("case_reference", S), ("s_c_csi_id", S), ("csi_group_raw", S), ("csi_raw", S)),
    "s_c_csi_map": _s(("supercategory", S), ("category", S), ("case_specific_issue", S), ("s_c_csi_id", S)),
    "universal_themes_map": _s(("org", S), ("t1", S), ("t2", S), ("ut1", S), ("ut2", S)),
    "advicepro_demographics": _s(("case_reference", S), ("age_range", S)),
    "casework_locality": _s(("case_reference", S), ("county", S)),
    "helplines_aggregated_full": _s(("la_name", S), ("month_date", D), ("ut1", S), ("n", L)),
    "people_receiving_care": _s(("metric", S)),
    "table_metadata": _s(("database", S), ("table_name", S), ("row_count", L), ("last_altered", TimestampNTZType())),
}

#: The names of the further columns and sources that are declared.
#: Declared columns that no model reads (all text unless typed): part of a source's full schema only.
FURTHER_COLUMNS: dict[str, tuple[tuple[str, object], ...]] = {
    "accessava_locality": tuple((c, S) for c in (
        "la_name", "county_code", "ward", "ward_code", "lso_area_name", "mso_area_name")),
    "casework_locality": tuple((c, S) for c in (
        "postcode", "county_code", "ward", "ward_code", "lso_area_name", "lso_area_code", "mso_area_name", "la_name")),
    "advicepro_demographics": tuple((c, S) for c in (
        "gender", "do_you_have_a_disability", "what_type_of_disability_do_you_consider_you_have", "ethnic_origin")),
    "advicepro_casework": (
        *((c, S) for c in ("case_close_month", "case_status", "case_level", "case_outcome", "case_specific_issues_group",
                           "case_specific_issues")),
        ("number_of_cases", L),
        *((c, S) for c in ("referred_from_account", "member_canonical_name", "la_code", "la_name_original"))),
}

#: Sources declared by name only, by group: read with the columns of their files.
OPEN_SOURCES: dict[str, tuple[str, ...]] = {
    "reference": (
        "census_ts007a_utla", "census_ts021_utla", "census_ts029_utla", "census_ts038_utla", "census_ts051_utla",
        "census_ts054_utla", "census_ts062_utla", "census_ts067_utla", "census_rm073_utla", "census_rm070_utla",
        "lann_ethnicity", "lann_english_proficiency", "lann_housing_tenure", "lann_ns_sec", "lann_population_data",
        "lann_qualification_level", "lann_rooms", "lann_area_sqkm", "lann_distance_to_sea", "lsoa21_to_utla22",
        "sam_utla_2021"),
    "data_portal": (
        "ascfr_salt", "cqc_ratings", "asc_workforce", "people_receiving_care", "metric", "dols", "population",
        "disability_prevalence", "imd_deprivation", "ombudsman", "discharge_delays"),
    "monday": (
        "monday_hypothesis_tracker", "monday_la_budgets", "monday_la_useful_contacts", "monday_data_strategy_initiatives"),
}


def full_schema(name: str) -> StructType | None:
    """Every declared column of a source; None if only its name is declared."""
    if name in SOURCE_SCHEMAS:
        return StructType([*SOURCE_SCHEMAS[name].fields, *_s(*FURTHER_COLUMNS.get(name, ())).fields])
    if any(name in names for names in OPEN_SOURCES.values()):
        return None
    raise KeyError(f"no source {name!r} is declared")
