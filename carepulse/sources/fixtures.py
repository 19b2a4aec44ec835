"""Adapter views: the reference's source shapes derived from the driver tables.

The reference reads live warehouse tables that are not public.  These views
re-create the same columns, NULL patterns and drift cases from the driver's
TPC-H-style parquet tables, so every operator runs over whole tables whose
size grows with the scale factor.  The same views are written in DuckDB SQL
in ``carepulse.plans.oracle`` for the correctness oracle; see FIXTURES.md.

Dimension joins (nation, region) are small by construction and are left to
the planner's broadcast threshold; fact-to-fact joins shuffle on their keys.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carepulse.functions.columns import taxonomy_key
from carepulse.operators.lookup import literal_lookup
from carepulse.sources.tables import TableSet

# Target local authority and reporting date used by the registered queries.
TARGET_LA = "NATION_7"
AS_OF = "2001-08-15"
# Month used by the reconciliation analyses.
RECON_MONTH = "2001-06-01"

# --- fixed values: topic entry point map (padding and case on purpose) -------
TOPIC_MAP_ROWS = (
    (" Economy", "Assessments", "NA"),
    ("SMALL", "Carers", "Support"),
    ("medium ", "Charging", None),
    ("Promo", "UNMATCHED", "NA"),
    ("standard", "Safeguarding", "Adults"),
)
# ---------------------------------------------------------------------------


def _age_from_custkey(custkey: Column) -> Column:
    m = custkey % 3
    return F.when(m == 0, "18-24").when(m == 1, "25-64").otherwise("65+")


def _age_from_balance(bal: Column) -> Column:
    return (F.when(bal < 0, F.lit(None).cast("string")).when(bal < 3000, "18-24")
            .when(bal < 6000, "25-64").otherwise("65+"))


class Fixtures:
    """All adapter views of one data folder (lazy DataFrames).

    ``Fixtures.of(spark, sf_dir)`` returns one shared instance per session
    and folder: the views are immutable plans, so queries of one session can
    share their declarations.
    Nothing is cached as data; every query executes its whole plan.
    """

    _shared: dict[tuple[int, str], Fixtures] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = TableSet(spark, sf_dir)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Fixtures:
        key = (id(spark), sf_dir.rstrip("/"))
        fx = cls._shared.get(key)
        if fx is None or fx.spark is not spark:
            fx = cls._shared[key] = cls(spark, sf_dir)
        return fx

    @classmethod
    def forget(cls) -> None:
        cls._shared.clear()

    # -- helpers ------------------------------------------------------------
    def _orders_customer_nation(self) -> DataFrame:
        o = self.t("orders")
        c = self.t("customer")
        n = self.t("nation")
        return (o.join(c, o.o_custkey == c.c_custkey)
                .join(n, c.c_nationkey == n.n_nationkey))

    @cached_property
    def order_topics(self) -> DataFrame:
        """Per order: its distinct part types, sorted, joined by '; '."""
        li = self.t("lineitem").select("l_orderkey", "l_partkey")
        p = self.t("part").select("p_partkey", "p_type")
        return (li.join(p, li.l_partkey == p.p_partkey)
                .groupBy("l_orderkey")
                .agg(F.array_join(F.array_sort(F.collect_set("p_type")), "; ").alias("topics")))

    # -- chatbot ------------------------------------------------------------
    @cached_property
    def accessava(self) -> DataFrame:
        x = self._orders_customer_nation()
        t = self.order_topics
        x = x.join(t, x.o_orderkey == t.l_orderkey, "left")
        k, pri, status, bal = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("c_acctbal")
        topics = F.col("topics")
        return x.select(
            F.concat(F.lit("T"), k.cast("string")).alias("transcript_id"),
            F.col("o_orderdate").cast("date").alias("created_at"),
            F.when(k % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("tenant_name"),
            F.when(k % 40 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("la_name"),
            F.when(k % 2 == 0, F.lower(topics)).otherwise(topics).alias("topic_entry_point"),
            F.when(k % 20 == 1, _age_from_custkey(F.col("o_custkey"))).alias("age"),
            F.when(pri == "1-URGENT", F.concat(F.lit("L"), (k % 5).cast("string"))).alias("lettercode"),
            F.when(status == "P", F.lit(None).cast("string"))
             .otherwise(F.concat(pri, F.lit("; "), status,
                                 F.when(k % 7 == 0, F.lit("; ")).otherwise(F.lit(""))))
             .alias("persona"),
            F.regexp_replace(topics, "; ", ";").alias("supercategories"),
            F.when(bal < 0, F.lit("Not Stated")).when(bal < 5000, F.lit(None).cast("string"))
             .otherwise(F.lit("Mobility")).alias("disability_text"),
            F.when(bal < 0, F.lit(None).cast("string")).when(bal < 5000, F.lit("No"))
             .otherwise(F.lit("Yes")).alias("disability_n_y"),
            _age_from_custkey(F.col("o_custkey")).alias("age_range"),
            F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("string"))
             .otherwise(F.lower(F.col("c_mktsegment"))).alias("ethnicity"),
            F.when(pri == "1-URGENT", F.lit("easyread|factsheet"))
             .when(pri == "2-HIGH", F.lit("factsheet|letter|factsheet"))
             .when(pri == "3-MEDIUM", F.lit("guide"))
             .when(pri == "5-LOW", F.lit("easyread|easyread-plus"))
             .alias("consumed_resources"),
            (pri.isin("1-URGENT", "2-HIGH") & (status == "F")).alias("letter_downloaded"),
        )

    @cached_property
    def accessava_locality(self) -> DataFrame:
        x = self._orders_customer_nation().filter(F.col("o_orderpriority") != "3-MEDIUM")
        r = self.t("region")
        x = x.join(r, (x.n_regionkey + x.o_orderkey) % 5 == r.r_regionkey)
        return x.select(F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("transcript_id"),
                        F.col("r_name").alias("county"))

    @cached_property
    def topic_entry_point_map(self) -> DataFrame:
        return literal_lookup(self.spark.createDataFrame(list(TOPIC_MAP_ROWS),
                                                       "topic_entry_point string, ut1 string, ut2 string"))

    # -- casework -----------------------------------------------------------
    @cached_property
    def s_c_csi_map(self) -> DataFrame:
        p = self.t("part").filter(F.col("p_brand") != "Brand#25")
        x = p.select(
            F.when(F.col("p_type") == "ECONOMY", F.lit("Community Care")).otherwise(F.col("p_type")).alias("supercategory"),
            F.col("p_brand").alias("category"),
            F.when(F.col("p_brand").isin("Brand#1", "Brand#2"), F.lit("[Category only]"))
             .otherwise(F.concat(F.col("p_brand"), F.lit(" issue"))).alias("case_specific_issue"),
        ).distinct()
        return x.withColumn("s_c_csi_id", taxonomy_key("supercategory", "category", "case_specific_issue"))

    @cached_property
    def case_topic_bridge(self) -> DataFrame:
        li = self.t("lineitem").select("l_orderkey", "l_partkey")
        p = self.t("part").select("p_partkey", "p_type", "p_brand")
        m = self.s_c_csi_map
        # de-duplicate on the narrow keys first; the id and the text columns
        # are functions of (l_orderkey, p_type, p_brand)
        x = li.join(p, li.l_partkey == p.p_partkey).select("l_orderkey", "p_type", "p_brand").distinct()
        sc = F.when(F.col("p_type") == "ECONOMY", F.lit("Community Care")).otherwise(F.col("p_type"))
        x = x.join(m, (m.supercategory == sc) & (m.category == x.p_brand), "left")
        return x.select(
            F.concat(F.lit("C"), F.col("l_orderkey").cast("string")).alias("case_reference"),
            F.col("s_c_csi_id"),
            F.col("p_type").alias("csi_group_raw"),
            F.col("p_brand").alias("csi_raw"),
        )

    @cached_property
    def universal_themes_map(self) -> DataFrame:
        m = self.s_c_csi_map.filter(F.col("category") != "Brand#24")
        cc = F.col("supercategory") == "Community Care"
        base = m.select(
            F.when(cc, F.col("category")).otherwise(F.col("supercategory")).alias("t1"),
            F.when(cc, F.col("case_specific_issue")).otherwise(F.col("category")).alias("t2"),
        ).distinct()
        main = base.select(
            F.lit("advicepro").alias("org"),
            F.concat(F.lit(" "), F.upper("t1")).alias("t1"),
            F.concat(F.col("t2"), F.lit(" ")).alias("t2"),
            F.when(F.length("t2") % 2 == 0, F.lit("Care plan")).otherwise(F.lit("Direct payments")).alias("ut1"),
            F.when(F.col("t1") == "SMALL", F.lit("NA")).otherwise(F.concat(F.lit("L2 "), F.col("t2"))).alias("ut2"),
        )
        foreign = self.spark.createDataFrame([("cab", "SMALL", "Brand#1", "Carers", "NA")],
                                             "org string, t1 string, t2 string, ut1 string, ut2 string")
        return main.unionByName(foreign)

    @cached_property
    def advicepro_casework(self) -> DataFrame:
        x = self._orders_customer_nation().filter(F.col("o_orderstatus") == "F")
        k = F.col("o_orderkey")
        return x.select(
            F.concat(F.lit("C"), k.cast("string")).alias("case_reference"),
            F.regexp_replace(F.substring(F.col("o_orderdate").cast("date").cast("string"), 1, 7), "-", "/")
             .alias("case_open_month"),
            F.when(k % 30 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("la_name"),
            F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None).cast("string"))
             .otherwise(F.concat(F.upper("c_mktsegment"), F.lit("; "), F.substring("o_orderpriority", 3, 20)))
             .alias("super_category"),
        )

    @cached_property
    def advicepro_demographics(self) -> DataFrame:
        o = self.t("orders").filter(F.col("o_orderpriority") != "4-NOT SPECIFIED")
        c = self.t("customer")
        x = o.join(c, o.o_custkey == c.c_custkey)
        return x.select(F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("case_reference"),
                        _age_from_balance(F.col("c_acctbal")).alias("age_range"))

    @cached_property
    def casework_locality(self) -> DataFrame:
        o = self.t("orders").filter(F.col("o_orderpriority") != "2-HIGH")
        r = self.t("region")
        x = o.join(r, o.o_orderkey % 5 == r.r_regionkey)
        return x.select(F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("case_reference"),
                        F.col("r_name").alias("county"))

    # -- helplines ----------------------------------------------------------
    @cached_property
    def helplines_aggregated_full(self) -> DataFrame:
        li = self.t("lineitem").select("l_suppkey", "l_shipdate", "l_returnflag")
        s = self.t("supplier").select("s_suppkey", "s_nationkey")
        n = self.t("nation").select("n_nationkey", "n_name")
        flag = F.col("l_returnflag")
        # count on the narrow keys, then attach the nation name to the
        # aggregated rows (one per nation x month x theme)
        counts = (li.join(s, li.l_suppkey == s.s_suppkey)
                  .groupBy(F.col("s_nationkey"),
                           F.last_day(F.col("l_shipdate").cast("date")).alias("month_date"),
                           F.when(flag == "A", "Assessments").when(flag == "N", "Carers")
                            .otherwise("Mental capacity").alias("ut1"))
                  .agg(F.count(F.lit(1)).alias("n")))
        x = counts.join(n, counts.s_nationkey == n.n_nationkey)
        return x.select(F.col("n_name").alias("la_name"), "month_date", "ut1", "n")


    # -- data portal ----------------------------------------------------------
    @cached_property
    def people_receiving_care(self) -> DataFrame:
        """A row per order line; the metric of some is none of the accepted values."""
        li = self.t("lineitem").select("l_linenumber", "l_returnflag", "l_quantity")
        metric = F.when(F.col("l_linenumber") == 7, F.concat(F.lit("other_"), F.col("l_returnflag"))).when(F.col("l_returnflag") == "N", "new_clients").otherwise("long_term_clients")
        return li.select(metric.alias("metric"))


# --- fixed values: exploratory value maps (NULL rows match NULL values) ------
ILTA_MAP_AVA_ROWS = (
    ("age_range", "18-24", "Young adult"), ("age_range", "25-64", "Adult"), ("age_range", "65+", "Older adult"),
    ("disability_n_y", "Yes", "Disabled"), ("disability_n_y", "No", "Not disabled"),
    ("disability_n_y", None, "Unknown"), ("disability_text", "Mobility", "Physical"),
    ("disability_text", "Not Stated", "Unknown"), ("ethnicity", "household", "Group A"),
    ("ethnicity", "machinery", "Group B"), ("ethnicity", None, "Not recorded"),
)
ILTA_MAP_CASEWORK_ROWS = (
    ("18-24", "age_range", "Young adult"), ("25-64", "age_range", "Adult"), ("65+", "age_range", "Older adult"),
    ("Yes", "Do you have a disability", "Disabled"), ("No", "Do you have a disability", "Not disabled"),
    (None, "Do you have a disability", "Unknown"), ("Household", "ethnicity", "Group A"),
    ("Machinery", "ethnicity", "Group B"),
)
# Analysis period: half-open for the feature counts, closed for resources.
PERIOD_START = "2000-10-01"
PERIOD_END = "2001-03-31"
# -----------------------------------------------------------------------------


def ilta_map_ava(spark: SparkSession) -> DataFrame:
    return literal_lookup(spark.createDataFrame(list(ILTA_MAP_AVA_ROWS), "FEATURE string, ACCESSAVA string, ILTA string"))


def ilta_map_casework(spark: SparkSession) -> DataFrame:
    return literal_lookup(spark.createDataFrame(list(ILTA_MAP_CASEWORK_ROWS),
                                              "CASEWORK string, FEATURE string, ILTA string"))


def casework_demo_report(fx: Fixtures) -> DataFrame:
    """Raw casework demographics export: one row per order line, headers with
    spaces, dd/mm/yyyy dates, placeholder strings and a per-row weight."""
    li = fx.t("lineitem").select("l_orderkey", "l_linenumber")
    o = fx.t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = fx.t("customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    x = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
    bal, seg = F.col("c_acctbal"), F.col("c_mktsegment")
    return x.select(
        F.date_format(F.col("o_orderdate"), "dd/MM/yyyy").alias("Case Open Date"),
        (F.col("l_linenumber") - 1).alias("Number of Person with Care Needss"),
        F.when(bal < 0, F.lit("[Not Specified]")).when(bal < 3000, F.lit("18-24"))
         .when(bal < 6000, F.lit("25-64")).otherwise(F.lit("65+")).alias("Age Range"),
        F.when(bal < 1000, F.lit("Not Stated")).when(bal < 5000, F.lit("No"))
         .otherwise(F.lit("Yes")).alias("Do you have a disability"),
        F.when(seg == "HOUSEHOLD", F.lit("Household")).when(seg == "MACHINERY", F.lit("Machinery"))
         .when(seg == "BUILDING", F.lit(None).cast("string")).otherwise(F.lit("Other")).alias("Ethnic Origin"),
    )


# --- ingest fixtures (A3-A22) --------------------------------------------------
# fixed values: board texts (cover every standardisation rule), groups, run ids
BOARD_SERVICES = (
    "Casework Membership 1 day per week", "Advice & Casework (bespoke)",
    "Advice & Casework Membership 4days pm", "Advice & Casework 2days pm",
    "Advice & Casework 1day pm", "Advice Membership - annual", "Training only", None,
)
BOARD_GROUPS = ("Contracts", "Prospects", "Approved findings")
CONTRACTS_GROUP = "Contracts"
FINDINGS_GROUP = "Approved findings"
RUN_ID = "run-2001-12-01"
RUN_AT = "2001-12-01T06:00:00Z"
NOW = "2001-12-01 06:00:00"
STALENESS_DATABASES = ("CASEWORK", "AVA", "HELPLINES")


def demographics_report(fx: Fixtures) -> DataFrame:
    """Raw casework demographics export at order-line grain: headers with
    spaces, the same case written with different case/padding, placeholders,
    and an ingest sequence that fixes which duplicate came first."""
    li = fx.t("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    o = fx.t("orders").select("o_orderkey", "o_custkey")
    c = fx.t("customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    x = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
    k, ln, bal = F.col("l_orderkey").cast("string"), F.col("l_linenumber"), F.col("c_acctbal")
    ref = (F.when(ln % 3 == 1, F.concat(F.lit("C"), k))
           .when(ln % 3 == 2, F.concat(F.lit(" c"), k, F.lit(" ")))
           .otherwise(F.concat(F.lit("c"), k, F.lit("\t"))))
    age = (F.when((ln == 1) & (bal < 0), F.lit("")).when(ln == 2, F.lit("[Not Specified]"))
           .otherwise(_age_from_balance(bal)))
    flag = F.col("l_returnflag")
    return x.select(
        ref.alias("Case Reference"),
        age.alias("Age Range"),
        F.when(flag == "R", F.lit("Female")).when(flag == "A", F.lit("Male"))
         .otherwise(F.lit("[Not Specified]")).alias("Gender"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(F.lower("c_mktsegment"))
         .alias("Ethnic Origin"),
        (F.col("l_orderkey") * 8 + ln).alias("ingest_seq"),
    )


def postcode_report(fx: Fixtures) -> DataFrame:
    o = fx.t("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = fx.t("customer").select("c_custkey", "c_nationkey")
    x = o.join(c, o.o_custkey == c.c_custkey)
    pri = F.col("o_orderpriority")
    return x.select(
        F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("Case Reference"),
        F.when(pri == "5-LOW", F.lit(None).cast("string")).when(pri == "4-NOT SPECIFIED", F.lit("  "))
         .otherwise(F.concat(F.lit("P"), F.col("c_nationkey").cast("string"))).alias("Postcode"))


def postcode_directory(fx: Fixtures) -> DataFrame:
    """Postcode -> geography; nations of region 4 are missing (unresolved)."""
    n = fx.t("nation").filter(F.col("n_regionkey") != 4)
    r = fx.t("region")
    x = n.join(r, n.n_regionkey == r.r_regionkey)
    return x.select(F.concat(F.lit("P"), F.col("n_nationkey").cast("string")).alias("postcode"),
                    F.col("n_name").alias("la_name"), F.col("r_name").alias("county"),
                    F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("county_code"))


def manifest_datasets(fx: Fixtures) -> DataFrame:
    """One manifest dataset per order; its provenance warnings are the order's
    lines in line-number order (bounded: a handful of lines per order)."""
    o = fx.t("orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    li = fx.t("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    flag = F.col("l_returnflag")
    code = (F.when(flag == "R", F.lit("SCHEMA_DRIFT")).when(flag == "A", F.lit("SEMANTIC_DRIFT_SUSPECTED"))
            .when(F.col("l_linestatus") == "F", F.lit("STALE_SOURCE")))
    w = (li.groupBy("l_orderkey")
         .agg(F.array_sort(F.collect_list(F.struct(
             F.col("l_linenumber").alias("ln"), code.alias("code"),
             F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("message"),
             F.col("l_linestatus").alias("details")))).alias("_w")))
    x = o.join(w, o.o_orderkey == w.l_orderkey, "left")
    pri = F.col("o_orderpriority")
    status = (F.when(pri == "1-URGENT", F.lit("SUCCESS")).when(pri == "2-HIGH", F.lit("NO_UPDATE"))
              .when(pri == "3-MEDIUM", F.lit("LIMITATION"))
              .when(pri == "4-NOT SPECIFIED", F.concat(F.lit("FAILED_"), F.col("o_orderstatus")))
              .otherwise(F.lit("PARTIAL")))
    warnings = F.transform(F.col("_w"), lambda s: F.struct(s["code"].alias("code"), s["message"].alias("message"),
                                                           s["details"].alias("details")))
    return x.select(F.concat(F.lit("ds_"), F.col("o_orderkey").cast("string")).alias("dataset_id"),
                    status.alias("status"),
                    F.struct(warnings.alias("warnings")).alias("provenance"))


def existing_tables(fx: Fixtures) -> DataFrame:
    o = fx.t("orders").filter(F.col("o_orderstatus") == "F")
    return o.select(F.concat(F.lit("ds_"), F.col("o_orderkey").cast("string")).alias("table_name"))


def landed_files(fx: Fixtures) -> DataFrame:
    o = fx.t("orders").filter(F.col("o_orderstatus") != "P")
    return o.select(F.concat(F.lit("ds_"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file_name"))


def dataset_rows(fx: Fixtures) -> DataFrame:
    li = fx.t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return li.select(F.concat(F.lit("ds_"), F.col("l_orderkey").cast("string")).alias("dataset_id"),
                     "l_linenumber", "l_quantity")


def board_items(fx: Fixtures) -> DataFrame:
    s = fx.t("supplier").select("s_suppkey", "s_name")
    k = F.col("s_suppkey")
    service = None
    for i, text in enumerate(BOARD_SERVICES):
        v = F.lit(text) if text is not None else F.lit(None).cast("string")
        service = F.when(k % len(BOARD_SERVICES) == i, v) if service is None else service.when(
            k % len(BOARD_SERVICES) == i, v)
    group = None
    for i, g in enumerate(BOARD_GROUPS):
        group = F.when(k % len(BOARD_GROUPS) == i, F.lit(g)) if group is None else group.when(
            k % len(BOARD_GROUPS) == i, F.lit(g))
    return s.select(F.col("s_name").alias("item_name"), service.alias("Service"), group.alias("group_title"))


def peer_signals(fx: Fixtures) -> DataFrame:
    """Signal rows with the dated snapshot file each would have landed in."""
    e = fx.t("events").select("user_id", "ts", "event_type", "value")
    return e.select(
        F.concat(F.lit("la_peer_signals_"), F.date_format("ts", "yyyyMMdd"), F.lit(".csv")).alias("file_name"),
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("unit"),
        F.col("event_type").alias("signal"), F.col("value"))


def table_metadata(fx: Fixtures) -> DataFrame:
    """Per supplier 'table': database, row count and last change time."""
    li = fx.t("lineitem").select("l_suppkey", "l_shipdate")
    s = fx.t("supplier").select("s_suppkey", "s_nationkey")
    x = li.join(s, li.l_suppkey == s.s_suppkey)
    m = F.col("s_nationkey") % 4
    db = (F.when(m == 0, F.lit("CASEWORK")).when(m == 1, F.lit("AVA")).when(m == 2, F.lit("HELPLINES"))
          .otherwise(F.lit("SCRATCH")))
    per = (x.groupBy(db.alias("database"), F.col("l_suppkey"))
           .agg(F.count(F.lit(1)).alias("row_count"), F.max(F.col("l_shipdate")).alias("last_altered")))
    k = F.col("l_suppkey")
    # some tables have no change time; some names stand in a second database
    cols = [F.concat(F.lit("T_"), k.cast("string")).alias("table_name"), F.col("row_count"),
            F.when(k % 17 != 0, F.col("last_altered")).alias("last_altered")]
    again = per.filter((k % 5 == 0) & (F.col("database") != "AVA"))
    return per.select("database", *cols).unionByName(again.select(F.lit("AVA").alias("database"), *cols))


# fixed values: source-level freshness settings (warn/error after count+period)
FRESHNESS_CONFIG_ROWS = (
    ("CASEWORK", 36, "hour", 72, "hour"),
    ("AVA", 45, "day", 90, "day"),
    ("HELPLINES", None, None, None, None),
)


def freshness_config(spark: SparkSession) -> DataFrame:
    return literal_lookup(spark.createDataFrame(list(FRESHNESS_CONFIG_ROWS),
                                              "database string, warn_count int, warn_period string, "
                                              "error_count int, error_period string"))


def freshness_overrides(fx: Fixtures) -> DataFrame:
    """Table-level overrides: suppliers in debit are disabled, rich ones get
    yearly thresholds, some of them for the warning alone."""
    s = fx.t("supplier").filter((F.col("s_acctbal") < 0) | (F.col("s_acctbal") > 9000))
    neg = F.col("s_acctbal") < 0
    null_i, null_s = F.lit(None).cast("int"), F.lit(None).cast("string")
    m = F.col("s_nationkey") % 4
    db = (F.when(m == 0, F.lit("CASEWORK")).when(m == 1, F.lit("AVA")).when(m == 2, F.lit("HELPLINES"))
          .otherwise(F.lit("SCRATCH")))
    part = neg | (F.col("s_suppkey") % 3 == 0)
    return s.select(db.alias("database"), F.concat(F.lit("T_"), F.col("s_suppkey").cast("string")).alias("table_name"),
                    (~neg).alias("enabled"),
                    F.when(neg, null_i).otherwise(F.lit(400)).alias("warn_count"),
                    F.when(neg, null_s).otherwise(F.lit("day")).alias("warn_period"),
                    F.when(part, null_i).otherwise(F.lit(550)).alias("error_count"),
                    F.when(part, null_s).otherwise(F.lit("day")).alias("error_period"))
