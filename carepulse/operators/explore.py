"""Exploratory analysis operators (X1-X14): feature counts against a shared
value map, combined interaction series, top-k breakdowns, resource usage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepulse.operators.lookup import lookup_join

# --- fixed values ------------------------------------------------------------
NOT_RECORDED = ("[Not Specified]", "Not Stated")   # recoded to NULL in casework features
RESOURCE_TOKENS = ("easyread", "factsheet")
CHATBOT_FEATURES = ("disability_text", "disability_n_y", "age_range", "ethnicity")
CASEWORK_DISABILITY = "Do you have a disability"
SOURCE_AVA = "AVA"
SOURCE_CASEWORK = "Casework"
# -----------------------------------------------------------------------------


# X1 ---------------------------------------------------------------------------
def date_range_filter(df: DataFrame, col: str | Column, start: str, end: str, closed: bool = False) -> DataFrame:
    """``start <= d < end`` (or ``<= end`` when closed), DATE literals."""
    d = F.col(col) if isinstance(col, str) else col
    lo = F.lit(start).cast("date")
    hi = F.lit(end).cast("date")
    return df.filter((d >= lo) & ((d <= hi) if closed else (d < hi)))


# X2 ---------------------------------------------------------------------------
def unpivot_features(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None,
                     name_col: str = "FEATURE", value_col: str = "VALUE") -> DataFrame:
    """Wide -> long, NULL values kept (one row per id x feature)."""
    values = list(values) if values is not None else [c for c in df.columns if c not in ids]
    df = df.select(*ids, *[F.col(f"`{c}`").cast("string").alias(c) for c in values])
    return df.unpivot(list(ids), values, name_col, value_col)


# X3 ---------------------------------------------------------------------------
def map_features(long: DataFrame, value_map: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on ``on`` where NULL matches NULL (natural-join semantics of
    the analysis).  Null-safe equality still plans as a hash join."""
    m = value_map.select(*[F.col(c).alias(f"_m_{c}") for c in value_map.columns])
    cond = None
    for c in on:
        e = F.col(c).eqNullSafe(F.col(f"_m_{c}"))
        cond = e if cond is None else cond & e
    j = lookup_join(long, m, cond, "left")
    extra = [c for c in value_map.columns if c not in on]
    return j.select(*long.columns, *[F.col(f"_m_{c}").alias(c) for c in extra])


# X4 ---------------------------------------------------------------------------
def uncount(df: DataFrame, weight: str) -> DataFrame:
    """Repeat each row ``weight`` times and drop the weight (0 -> no row).

    Prefer carrying the weight and summing it (see casework_feature_counts):
    the row expansion is only needed when rows themselves are the output.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c != weight]
    return (df.select(*rest, F.explode(F.array_repeat(F.lit(0), F.col(f"`{weight}`").cast("int"))).alias("_rep"))
            .drop("_rep"))


# X5 ---------------------------------------------------------------------------
def chatbot_feature_counts(accessava: DataFrame, value_map: DataFrame, start: str, end: str,
                           features: Sequence[str] = CHATBOT_FEATURES) -> DataFrame:
    x = date_range_filter(accessava, "created_at", start, end).select("transcript_id", *features)
    long = unpivot_features(x, ["transcript_id"], features, "FEATURE", "ACCESSAVA")
    mapped = map_features(long, value_map, ["FEATURE", "ACCESSAVA"])
    return mapped.groupBy("FEATURE", "ILTA").agg(F.count(F.lit(1)).alias("N"))


# X6 ---------------------------------------------------------------------------
def casework_feature_counts(report: DataFrame, value_map: DataFrame, start: str, end: str,
                            date_col: str = "Case Open Date",
                            weight_col: str = "Number of Person with Care Needss") -> DataFrame:
    """Casework demographics counted like the chatbot features.

    The report's weight column repeats each row; instead of materialising the
    repeats the weight is carried through the unpivot and summed (rows with
    weight 0 drop out, as they would after the repeat).
    """
    d = F.to_date(F.col(f"`{date_col}`"), "dd/MM/yyyy")
    x = date_range_filter(report, d, start, end).drop(date_col)
    x = x.filter(F.col(f"`{weight_col}`") > 0).withColumnRenamed(weight_col, "_w")
    feats = [c for c in x.columns if c != "_w"]
    long = unpivot_features(x, ["_w"], feats, "FEATURE", "CASEWORK")
    long = long.withColumn("CASEWORK", F.when(F.col("CASEWORK").isin(*NOT_RECORDED), F.lit(None).cast("string"))
                           .otherwise(F.col("CASEWORK"))).drop("FEATURE")
    mapped = map_features(long, value_map, ["CASEWORK"])
    mapped = mapped.withColumn("FEATURE", F.when(F.col("FEATURE") == CASEWORK_DISABILITY, F.lit("disability_n_y"))
                               .otherwise(F.col("FEATURE")))
    return mapped.groupBy("FEATURE", "ILTA").agg(F.sum("_w").cast("bigint").alias("N"))


# X7 ---------------------------------------------------------------------------
def combined_feature_totals(*counts: DataFrame) -> DataFrame:
    u = counts[0]
    for c in counts[1:]:
        u = u.unionByName(c)
    return u.groupBy("FEATURE", "ILTA").agg(F.sum("N").cast("bigint").alias("TOTAL"))


# X8 ---------------------------------------------------------------------------
def combined_interactions(accessava: DataFrame, casework: DataFrame) -> DataFrame:
    """Chatbot and casework rows in one long table, category list split on ';'
    (a NULL list stays one NULL row) and trimmed."""
    ava = accessava.select(F.lit(SOURCE_AVA).alias("source"), F.col("transcript_id").alias("id"),
                           F.date_format("created_at", "yyyy-MM").alias("month"),
                           F.col("supercategories").alias("category"), F.col("la_name").alias("la"))
    opened = F.to_date(F.concat(F.col("case_open_month"), F.lit("/01")), "yyyy/MM/dd")
    cw = casework.select(F.lit(SOURCE_CASEWORK).alias("source"), F.col("case_reference").alias("id"),
                         F.date_format(opened, "yyyy-MM").alias("month"),
                         F.col("super_category").alias("category"), F.col("la_name").alias("la"))
    u = ava.unionByName(cw)
    u = u.withColumn("category", F.explode_outer(F.split("category", ";")))
    return u.withColumn("category", F.trim("category"))


# X9 ---------------------------------------------------------------------------
def monthly_series_filled(combined: DataFrame) -> DataFrame:
    """Count per source x month; months missing between each source's own
    first and last month appear with a NULL count."""
    counts = (combined.withColumn("MONTH", F.to_date(F.concat("month", F.lit("-01"))))
              .groupBy(F.col("source").alias("SOURCE"), "MONTH").agg(F.count(F.lit(1)).alias("N")))
    bounds = counts.groupBy("SOURCE").agg(F.min("MONTH").alias("_lo"), F.max("MONTH").alias("_hi"))
    grid = bounds.select("SOURCE", F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 MONTH"))).alias("MONTH"))
    return grid.join(counts, ["SOURCE", "MONTH"], "left")


# X10 --------------------------------------------------------------------------
def season_table(series: DataFrame) -> DataFrame:
    return series.select("SOURCE", F.year("MONTH").alias("YEAR"), F.month("MONTH").alias("MONTH_OF_YEAR"), "N")


# X11 / X12 --------------------------------------------------------------------
def top_k_breakdown(combined: DataFrame, key: str, k: int = 20, drop_blank: bool = True) -> DataFrame:
    """Top-k keys by row count (key breaks ties), and their counts by source.

    Rows are counted once, by key and source; a key's list of sources is as
    long as there are sources, and the k largest keys are picked from those."""
    keep = F.col(key).isNotNull()
    if drop_blank:
        keep = keep & (F.col(key) != "")
    counts = combined.filter(keep).groupBy(key, "source").agg(F.count(F.lit(1)).alias("N"))
    top = (counts.groupBy(key).agg(F.sum("N").alias("_n"), F.collect_list(F.struct(F.col("source").alias("SOURCE"), "N")).alias("_by"))
           .orderBy(F.col("_n").desc(), F.col(key).asc()).limit(k))
    return top.select(F.col(key).alias(key.upper()), F.explode("_by").alias("_x")).select("_x.SOURCE", key.upper(), "_x.N")


def top_k_categories(combined: DataFrame, k: int = 20) -> DataFrame:
    return top_k_breakdown(combined, "category", k, drop_blank=True)


def top_k_las(combined: DataFrame, k: int = 20) -> DataFrame:
    return top_k_breakdown(combined, "la", k, drop_blank=False)


# X13 --------------------------------------------------------------------------
def overall_totals(accessava: DataFrame, casework: DataFrame, combined: DataFrame) -> DataFrame:
    """Row counts of both inputs and of the combined table, in one job."""
    tagged = (accessava.select(F.lit(1).alias("_t"))
              .unionByName(casework.select(F.lit(2).alias("_t")))
              .unionByName(combined.select(F.lit(3).alias("_t"))))
    return tagged.agg(F.count_if(F.col("_t") == 1).alias("N_CHATBOT"),
                      F.count_if(F.col("_t") == 2).alias("N_CASEWORK"),
                      F.count_if(F.col("_t") == 3).alias("N_COMBINED"))


# X14 --------------------------------------------------------------------------
def resource_consumption(accessava: DataFrame, start: str, end: str,
                         tokens: Sequence[str] = RESOURCE_TOKENS) -> DataFrame:
    """Letters downloaded plus resource tokens equal to one of ``tokens``
    in the closed period; '|' lists are split with a character class."""
    x = date_range_filter(accessava, "created_at", start, end, closed=True)
    parts = F.split(F.col("consumed_resources"), "[|]")
    n_tok = F.size(F.filter(parts, lambda t: t.isin(*tokens)))
    agg = x.agg(F.count_if(F.col("letter_downloaded")).alias("LETTERS_DOWNLOADED"),
                F.sum(F.when(F.col("consumed_resources").isNotNull(), n_tok).otherwise(0))
                .cast("bigint").alias("EASYREADS_AND_FACTSHEETS"))
    return agg.withColumn("TOTAL", F.col("LETTERS_DOWNLOADED") + F.col("EASYREADS_AND_FACTSHEETS"))
