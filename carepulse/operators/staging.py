"""Staging: explode multi-valued topics, map every source on to the shared
UT1/UT2 taxonomy and union them at topic-mention grain (B1-B11).

Canonical nine-column interface (order matters, the union is positional in
the reference):
LA_NAME, QUERY_DATE, SOURCE_SYSTEM, QUERY_COUNT, SEGMENT, UT2, AGE_BAND,
HAS_LETTER, LOCALITY_NAME.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepulse.functions.columns import parse_open_month, regex_literal, taxonomy_key
from carepulse.operators.lookup import lookup_join

# --- fixed values ------------------------------------------------------------
TOPIC_SEPARATOR = "; "           # topic_entry_point list separator
UNMATCHED = "Unmatched"          # source recorded no topic
UNMAPPED = "Unmapped"            # topic recorded but absent from the map (drift)
NA_LITERAL = "NA"                # map's literal for "no second level"
COMMUNITY_CARE = "Community Care"
ADVICEPRO_ORG = "advicepro"
SOURCE_ACCESSAVA = "AccessAva"
SOURCE_ADVICEPRO = "AdvicePro"
SOURCE_HELPLINES = "Helplines"
# -----------------------------------------------------------------------------

INTERFACE = ("LA_NAME", "QUERY_DATE", "SOURCE_SYSTEM", "QUERY_COUNT", "SEGMENT", "UT2",
             "AGE_BAND", "HAS_LETTER", "LOCALITY_NAME")
INTERFACE_TYPES = {"LA_NAME": "string", "QUERY_DATE": "date", "SOURCE_SYSTEM": "string",
                   "QUERY_COUNT": "bigint", "SEGMENT": "string", "UT2": "string",
                   "AGE_BAND": "string", "HAS_LETTER": "int", "LOCALITY_NAME": "string"}


def _interface(cols: dict[str, Column]) -> list[Column]:
    return [cols[name].cast(INTERFACE_TYPES[name]).alias(name) for name in INTERFACE]


# B1 --------------------------------------------------------------------------
def explode_topics(df: DataFrame, col: str = "topic_entry_point", sep: str = TOPIC_SEPARATOR,
                   out: str = "topic_value", la_col: str = "la_name") -> DataFrame:
    """One row per list element, OUTER: a NULL list keeps one row with NULL.

    Elements are trimmed of spaces; a trailing separator yields an '' element
    (which later maps to Unmapped, not Unmatched).  Rows without an LA are
    dropped first, which Catalyst keeps below the Generate.
    """
    if la_col:
        df = df.filter(F.col(la_col).isNotNull())
    exploded = df.withColumn(out, F.explode_outer(F.split(F.col(col), regex_literal(sep))))
    return exploded.withColumn(out, F.trim(F.col(out)))


# B2 --------------------------------------------------------------------------
def normalise_topic_map(topic_map: DataFrame) -> DataFrame:
    """Map key normalised once: lower(trim(topic_entry_point))."""
    return topic_map.select(F.lower(F.trim("topic_entry_point")).alias("_topic_key"),
                            F.col("ut1").alias("_ut1"), F.col("ut2").alias("_ut2"))


def map_topic_to_theme(mentions: DataFrame, topic_map: DataFrame, list_col: str = "topic_entry_point",
                       value_col: str = "topic_value") -> DataFrame:
    """Left join on lower(topic) = lower(trim(map key)); adds SEGMENT and UT2.

    SEGMENT = 'Unmatched' when the source list was NULL, else the map's UT1 or
    'Unmapped'.  UT2 = map's UT2 with the literal 'NA' turned into NULL.
    Duplicate map keys fan out, as in the reference (guard: fanout_guard).
    """
    m = normalise_topic_map(topic_map)
    x = mentions.withColumn("_topic_key", F.lower(F.col(value_col)))
    x = lookup_join(x, m, "_topic_key", "left")
    segment = (F.when(F.col(list_col).isNull(), F.lit(UNMATCHED))
               .otherwise(F.coalesce(F.col("_ut1"), F.lit(UNMAPPED))))
    return (x.withColumn("SEGMENT", segment)
             .withColumn("UT2", F.nullif(F.col("_ut2"), F.lit(NA_LITERAL)))
             .drop("_topic_key", "_ut1", "_ut2"))


# B3 --------------------------------------------------------------------------
def stg_accessava(accessava: DataFrame, locality: DataFrame, topic_map: DataFrame) -> DataFrame:
    """Chatbot conversations at topic-mention grain, mapped to UT1/UT2.

    The locality join runs at conversation grain, before the explode, so the
    shuffle on transcript_id moves one row per conversation, not per mention.
    """
    conv = (accessava.filter(F.col("la_name").isNotNull())
            .select("transcript_id", "la_name", "created_at", "age", "lettercode", "topic_entry_point"))
    loc = locality.select("transcript_id", "county")
    conv = conv.join(loc, "transcript_id", "left")
    x = explode_topics(conv, la_col=None)
    x = map_topic_to_theme(x, topic_map)
    return x.select(*_interface({
        "LA_NAME": F.col("la_name"),
        "QUERY_DATE": F.col("created_at").cast("date"),
        "SOURCE_SYSTEM": F.lit(SOURCE_ACCESSAVA),
        "QUERY_COUNT": F.lit(1),
        "SEGMENT": F.col("SEGMENT"),
        "UT2": F.col("UT2"),
        "AGE_BAND": F.col("age"),
        "HAS_LETTER": F.when(F.col("lettercode").isNotNull(), 1).otherwise(0),
        "LOCALITY_NAME": F.col("county"),
    }))


# B5 --------------------------------------------------------------------------
def case_theme_keys(supercategory: Column, category: Column, issue: Column) -> tuple[Column, Column]:
    """Conditional composite key: Community Care keys on (category, issue),
    every other supercategory on (supercategory, category).  A NULL
    supercategory takes the second branch (IFF semantics)."""
    cc = supercategory == COMMUNITY_CARE
    k1 = F.when(cc, category).otherwise(supercategory)
    k2 = F.when(cc, issue).otherwise(category)
    return F.lower(F.trim(k1)), F.lower(F.trim(k2))


def map_case_to_theme(rows: DataFrame, csi_map: DataFrame, themes_map: DataFrame,
                      id_col: str = "s_c_csi_id") -> DataFrame:
    """Taxonomy id -> (supercategory, category, issue) -> UT1/UT2 (advicepro rows
    of the themes map only).  Adds SEGMENT ('Unmapped' when no theme) and UT2."""
    m = csi_map.select(F.col("s_c_csi_id").alias("_csi_id"), F.col("supercategory").alias("_sc"),
                       F.col("category").alias("_cat"), F.col("case_specific_issue").alias("_csi"))
    x = rows.withColumn("_csi_id", F.col(id_col))
    x = lookup_join(x, m, "_csi_id", "left")
    k1, k2 = case_theme_keys(F.col("_sc"), F.col("_cat"), F.col("_csi"))
    x = x.withColumn("_k1", k1).withColumn("_k2", k2)
    u = (themes_map.filter(F.col("org") == ADVICEPRO_ORG)
         .select(F.lower(F.trim("t1")).alias("_k1"), F.lower(F.trim("t2")).alias("_k2"),
                 F.col("ut1").alias("_ut1"), F.col("ut2").alias("_ut2")))
    x = lookup_join(x, u, ["_k1", "_k2"], "left")
    return (x.withColumn("SEGMENT", F.coalesce(F.col("_ut1"), F.lit(UNMAPPED)))
             .withColumn("UT2", F.nullif(F.col("_ut2"), F.lit(NA_LITERAL)))
             .drop("_csi_id", "_sc", "_cat", "_csi", "_k1", "_k2", "_ut1", "_ut2"))


# B6 --------------------------------------------------------------------------
def stg_advicepro(casework: DataFrame, bridge: DataFrame, csi_map: DataFrame, themes_map: DataFrame,
                  demographics: DataFrame, locality: DataFrame, strict_dates: bool = True) -> DataFrame:
    """Casework cases at topic-mention grain, mapped to UT1/UT2.

    Every large join keys on case_reference, so each input is shuffled once
    and the joins reuse that partitioning; the two taxonomy maps
    are broadcast where Spark finds them small.  The case x topic bridge joins
    first: it is the side where one case could hold a large share of the
    rows, and only a join whose two inputs come straight from a shuffle can
    have a hot partition split by AQE's skew handling.
    """
    c = (casework.filter(F.col("la_name").isNotNull())
         .select("case_reference", "case_open_month", "la_name"))
    d = demographics.select("case_reference", F.col("age_range"))
    loc = locality.select("case_reference", F.col("county"))
    b = bridge.select("case_reference", "s_c_csi_id")
    x = (c.join(b, "case_reference", "inner")
          .join(d, "case_reference", "left")
          .join(loc, "case_reference", "left"))
    x = map_case_to_theme(x, csi_map, themes_map)
    return x.select(*_interface({
        "LA_NAME": F.col("la_name"),
        "QUERY_DATE": parse_open_month("case_open_month", strict=strict_dates),
        "SOURCE_SYSTEM": F.lit(SOURCE_ADVICEPRO),
        "QUERY_COUNT": F.lit(1),
        "SEGMENT": F.col("SEGMENT"),
        "UT2": F.col("UT2"),
        "AGE_BAND": F.col("age_range"),
        "HAS_LETTER": F.lit(0),
        "LOCALITY_NAME": F.col("county"),
    }))


def reject_bad_open_months(casework: DataFrame) -> DataFrame:
    """Lenient companion of B4: cases whose open month does not parse."""
    return casework.filter(F.col("case_open_month").isNotNull()
                           & parse_open_month("case_open_month", strict=False).isNull())


# B7 --------------------------------------------------------------------------
def stg_helplines(helplines: DataFrame) -> DataFrame:
    """Pre-aggregated helpline counts projected on to the interface."""
    h = helplines.filter(F.col("la_name").isNotNull())
    null = F.lit(None).cast("string")
    return h.select(*_interface({
        "LA_NAME": F.col("la_name"),
        "QUERY_DATE": F.col("month_date").cast("date"),
        "SOURCE_SYSTEM": F.lit(SOURCE_HELPLINES),
        "QUERY_COUNT": F.col("n").cast("bigint"),
        "SEGMENT": F.col("ut1"),
        "UT2": null,
        "AGE_BAND": null,
        "HAS_LETTER": F.lit(0),
        "LOCALITY_NAME": null,
    }))


# B8 --------------------------------------------------------------------------
def stg_la_topic_mentions(*parts: DataFrame) -> DataFrame:
    """UNION ALL of staged sources after asserting the identical interface."""
    if not parts:
        raise ValueError("nothing to union")
    expected = [(n, INTERFACE_TYPES[n]) for n in INTERFACE]
    for p in parts:
        got = [(f.name, f.dataType.simpleString()) for f in p.schema.fields]
        if got != expected:
            raise ValueError(f"staged part does not match the interface: {got}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# B9 --------------------------------------------------------------------------
def slice_las(mentions: DataFrame, las: Sequence[str]) -> DataFrame:
    """Keep the listed local authorities (pushed down to every union branch)."""
    return mentions.filter(F.col("LA_NAME").isin(list(las)))


# B10 -------------------------------------------------------------------------
def monthly_theme_counts(mentions: DataFrame) -> DataFrame:
    """Sum per LA x month x source x UT1 x UT2 (a NULL UT2 is its own group)."""
    return (mentions.groupBy(F.col("LA_NAME"), F.trunc("QUERY_DATE", "MM").alias("MONTH_DATE"),
                             F.col("SOURCE_SYSTEM"), F.col("SEGMENT").alias("UT1"), F.col("UT2"))
            .agg(F.sum("QUERY_COUNT").cast("bigint").alias("QUERY_COUNT")))


# B11 -------------------------------------------------------------------------
def with_taxonomy_key(df: DataFrame, out: str = "s_c_csi_id", supercategory: str = "supercategory",
                      category: str = "category", issue: str = "case_specific_issue") -> DataFrame:
    return df.withColumn(out, taxonomy_key(supercategory, category, issue))
