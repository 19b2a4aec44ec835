"""Independent ANSI-SQL formulation of every registered query (DuckDB oracle).

Written the way the reference writes its models: five UNION ALL branches per
windowed intermediate, LATERAL-style unnest for topic lists, literal CASE for
suppression.  The Spark side is written independently with the DataFrame API,
so agreement checks both the fixture views and the operator rewrites (W1).

``compose(body, *names)`` prepends the named CTEs and, transitively, the CTEs
they depend on, in dependency order.
"""

from __future__ import annotations

import re

from carepulse.sources.fixtures import AS_OF, RECON_MONTH, TARGET_LA
from carepulse.sources.tables import DRIVER_TABLES

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def _deps(sql: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql))
    return [n for n in CTES if n in words]


def compose(body: str, *extra: str) -> str:
    order: list[str] = []

    def visit(name: str, stack=()):
        if name in order:
            return
        for d in _deps(CTES[name]):
            if d != name and d not in stack:
                visit(d, stack + (name,))
        order.append(name)

    for n in list(extra) + _deps(body):
        visit(n)
    if not order:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order) + "\n" + body.strip()


AS_OF_SQL = f"DATE '{AS_OF}'"


def cutoff(months: int) -> str:
    return f"CAST({AS_OF_SQL} - INTERVAL {months} MONTH AS DATE)"


def suppress(expr: str) -> str:
    return f"CASE WHEN {expr} < 5 THEN '1-5' ELSE CAST({expr} AS VARCHAR) END"


# ---------------------------------------------------------------- fixtures ---
cte("order_topics", """
SELECT l_orderkey, string_agg(DISTINCT p_type, '; ' ORDER BY p_type) AS topics
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""")

cte("accessava", """
SELECT 'T' || CAST(o.o_orderkey AS VARCHAR) AS transcript_id,
  CAST(o.o_orderdate AS DATE) AS created_at,
  CASE WHEN o.o_orderkey % 50 = 0 THEN NULL ELSE c.c_mktsegment END AS tenant_name,
  CASE WHEN o.o_orderkey % 40 = 0 THEN NULL ELSE n.n_name END AS la_name,
  CASE WHEN o.o_orderkey % 2 = 0 THEN lower(t.topics) ELSE t.topics END AS topic_entry_point,
  CASE WHEN o.o_orderkey % 20 = 1 THEN (CASE o.o_custkey % 3 WHEN 0 THEN '18-24' WHEN 1 THEN '25-64' ELSE '65+' END) END AS age,
  CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'L' || CAST(o.o_orderkey % 5 AS VARCHAR) END AS lettercode,
  CASE WHEN o.o_orderstatus = 'P' THEN NULL
       ELSE o.o_orderpriority || '; ' || o.o_orderstatus || CASE WHEN o.o_orderkey % 7 = 0 THEN '; ' ELSE '' END END AS persona,
  replace(t.topics, '; ', ';') AS supercategories,
  CASE WHEN c.c_acctbal < 0 THEN 'Not Stated' WHEN c.c_acctbal < 5000 THEN NULL ELSE 'Mobility' END AS disability_text,
  CASE WHEN c.c_acctbal < 0 THEN NULL WHEN c.c_acctbal < 5000 THEN 'No' ELSE 'Yes' END AS disability_n_y,
  CASE o.o_custkey % 3 WHEN 0 THEN '18-24' WHEN 1 THEN '25-64' ELSE '65+' END AS age_range,
  CASE WHEN c.c_mktsegment = 'BUILDING' THEN NULL ELSE lower(c.c_mktsegment) END AS ethnicity,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'easyread|factsheet' WHEN '2-HIGH' THEN 'factsheet|letter|factsheet'
       WHEN '3-MEDIUM' THEN 'guide' WHEN '5-LOW' THEN 'easyread|easyread-plus' END AS consumed_resources,
  (o.o_orderpriority IN ('1-URGENT', '2-HIGH') AND o.o_orderstatus = 'F') AS letter_downloaded
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN order_topics t ON o.o_orderkey = t.l_orderkey""")

cte("accessava_locality", """
SELECT 'T' || CAST(o.o_orderkey AS VARCHAR) AS transcript_id, r.r_name AS county
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON (n.n_regionkey + o.o_orderkey) % 5 = r.r_regionkey
WHERE o.o_orderpriority <> '3-MEDIUM'""")

cte("topic_entry_point_map", """
SELECT * FROM (VALUES (' Economy', 'Assessments', 'NA'), ('SMALL', 'Carers', 'Support'),
  ('medium ', 'Charging', NULL), ('Promo', 'UNMATCHED', 'NA'), ('standard', 'Safeguarding', 'Adults'))
  AS t(topic_entry_point, ut1, ut2)""")

cte("s_c_csi_map", """
SELECT supercategory, category, case_specific_issue,
  md5(supercategory || '|' || category || '|' || case_specific_issue) AS s_c_csi_id
FROM (SELECT DISTINCT CASE WHEN p_type = 'ECONOMY' THEN 'Community Care' ELSE p_type END AS supercategory,
        p_brand AS category,
        CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN '[Category only]' ELSE p_brand || ' issue' END AS case_specific_issue
      FROM part WHERE p_brand <> 'Brand#25') x""")

cte("case_topic_bridge", """
SELECT 'C' || CAST(x.l_orderkey AS VARCHAR) AS case_reference, m.s_c_csi_id,
  x.p_type AS csi_group_raw, x.p_brand AS csi_raw
FROM (SELECT DISTINCT l.l_orderkey, p.p_type, p.p_brand FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey) x
LEFT JOIN s_c_csi_map m
  ON m.supercategory = CASE WHEN x.p_type = 'ECONOMY' THEN 'Community Care' ELSE x.p_type END
 AND m.category = x.p_brand""")

cte("universal_themes_map", """
SELECT 'advicepro' AS org, ' ' || upper(t1) AS t1, t2 || ' ' AS t2,
  CASE WHEN length(t2) % 2 = 0 THEN 'Care plan' ELSE 'Direct payments' END AS ut1,
  CASE WHEN t1 = 'SMALL' THEN 'NA' ELSE 'L2 ' || t2 END AS ut2
FROM (SELECT DISTINCT CASE WHEN supercategory = 'Community Care' THEN category ELSE supercategory END AS t1,
        CASE WHEN supercategory = 'Community Care' THEN case_specific_issue ELSE category END AS t2
      FROM s_c_csi_map WHERE category <> 'Brand#24') x
UNION ALL SELECT 'cab', 'SMALL', 'Brand#1', 'Carers', 'NA'""")

cte("advicepro_casework", """
SELECT 'C' || CAST(o_orderkey AS VARCHAR) AS case_reference,
  replace(substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 7), '-', '/') AS case_open_month,
  CASE WHEN o_orderkey % 30 = 0 THEN NULL ELSE n_name END AS la_name,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
       ELSE upper(c_mktsegment) || '; ' || substr(o_orderpriority, 3, 20) END AS super_category
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus = 'F'""")

cte("advicepro_demographics", """
SELECT 'C' || CAST(o_orderkey AS VARCHAR) AS case_reference,
  CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 3000 THEN '18-24'
       WHEN c_acctbal < 6000 THEN '25-64' ELSE '65+' END AS age_range
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority <> '4-NOT SPECIFIED'""")

cte("casework_locality", """
SELECT 'C' || CAST(o_orderkey AS VARCHAR) AS case_reference, r_name AS county
FROM orders JOIN region ON o_orderkey % 5 = r_regionkey WHERE o_orderpriority <> '2-HIGH'""")

cte("helplines_aggregated_full", """
SELECT n_name AS la_name, last_day(CAST(l_shipdate AS DATE)) AS month_date,
  CASE l_returnflag WHEN 'A' THEN 'Assessments' WHEN 'N' THEN 'Carers' ELSE 'Mental capacity' END AS ut1,
  count(*) AS n
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY 1, 2, 3""")

# ----------------------------------------------------------------- staging ---
# Rules: a conversation counts once per topic of its list, once if it has no list; a topic's theme comes from
# the topic map by lower-cased, trimmed name.  Conversations with a list and those without are written apart.
cte("ava_topics", """
SELECT transcript_id AS id, lower(trim(topic)) AS topic
FROM accessava, LATERAL (SELECT unnest(string_split(topic_entry_point, '; ')) AS topic) each_topic
WHERE topic_entry_point IS NOT NULL""")
cte("topic_themes", """
SELECT lower(trim(topic_entry_point)) AS topic, ut1, CASE WHEN ut2 <> 'NA' THEN ut2 END AS theme2
FROM topic_entry_point_map""")
cte("ava_themes", """
SELECT id, coalesce(ut1, 'Unmapped') AS theme1, theme2 FROM ava_topics LEFT JOIN topic_themes USING (topic)
UNION ALL
SELECT transcript_id, 'Unmatched', NULL FROM accessava WHERE topic_entry_point IS NULL""")
cte("stg_accessava", """
WITH conversation AS (
  SELECT transcript_id AS id, la_name, created_at, age, CAST(lettercode IS NOT NULL AS INTEGER) AS letter
  FROM accessava WHERE la_name IS NOT NULL),
place AS (SELECT transcript_id AS id, county FROM accessava_locality)
SELECT la_name AS LA_NAME, created_at AS QUERY_DATE, 'AccessAva' AS SOURCE_SYSTEM, 1::BIGINT AS QUERY_COUNT,
  theme1 AS SEGMENT, theme2 AS UT2, age AS AGE_BAND, letter AS HAS_LETTER, county AS LOCALITY_NAME
FROM ava_themes JOIN conversation USING (id) LEFT JOIN place USING (id)""")

# Rules: a taxonomy id names two levels; community care is looked up one level further down than the rest.
cte("csi_keys", """
SELECT s_c_csi_id, lower(trim(category)) AS key1, lower(trim(case_specific_issue)) AS key2
FROM s_c_csi_map WHERE supercategory = 'Community Care'
UNION ALL
SELECT s_c_csi_id, lower(trim(supercategory)), lower(trim(category))
FROM s_c_csi_map WHERE supercategory IS DISTINCT FROM 'Community Care'""")
cte("casework_themes", """
SELECT lower(trim(t1)) AS key1, lower(trim(t2)) AS key2, ut1, CASE WHEN ut2 <> 'NA' THEN ut2 END AS theme2
FROM universal_themes_map WHERE org = 'advicepro'""")
cte("stg_advicepro", """
WITH topic AS (
  SELECT case_reference, coalesce(ut1, 'Unmapped') AS theme1, theme2
  FROM case_topic_bridge LEFT JOIN csi_keys USING (s_c_csi_id) LEFT JOIN casework_themes USING (key1, key2)),
opened AS (
  SELECT case_reference, la_name, strptime(case_open_month || '/01', '%Y/%m/%d')::DATE AS first_day
  FROM advicepro_casework WHERE la_name IS NOT NULL)
SELECT la_name AS LA_NAME, first_day AS QUERY_DATE, 'AdvicePro' AS SOURCE_SYSTEM, 1::BIGINT AS QUERY_COUNT,
  theme1 AS SEGMENT, theme2 AS UT2, age_range AS AGE_BAND, 0 AS HAS_LETTER, county AS LOCALITY_NAME
FROM topic JOIN opened USING (case_reference)
LEFT JOIN (SELECT case_reference, age_range FROM advicepro_demographics) ages USING (case_reference)
LEFT JOIN (SELECT case_reference, county FROM casework_locality) places USING (case_reference)""")

cte("stg_helplines", """
SELECT la_name AS LA_NAME, CAST(month_date AS DATE) AS QUERY_DATE, 'Helplines' AS SOURCE_SYSTEM,
  CAST(n AS BIGINT) AS QUERY_COUNT, ut1 AS SEGMENT, CAST(NULL AS VARCHAR) AS UT2,
  CAST(NULL AS VARCHAR) AS AGE_BAND, 0 AS HAS_LETTER, CAST(NULL AS VARCHAR) AS LOCALITY_NAME
FROM helplines_aggregated_full WHERE la_name IS NOT NULL""")

cte("stg_la_topic_mentions", """
SELECT * FROM stg_accessava UNION ALL SELECT * FROM stg_advicepro UNION ALL SELECT * FROM stg_helplines""")

cte("stg_la_topic_mentions_slice", f"""
SELECT * FROM stg_la_topic_mentions WHERE LA_NAME = '{TARGET_LA}'""")

cte("helplines_advicepro_accessava", """
SELECT LA_NAME, CAST(date_trunc('month', QUERY_DATE) AS DATE) AS MONTH_DATE, SOURCE_SYSTEM,
  SEGMENT AS UT1, UT2, CAST(SUM(QUERY_COUNT) AS BIGINT) AS QUERY_COUNT
FROM stg_la_topic_mentions
GROUP BY LA_NAME, CAST(date_trunc('month', QUERY_DATE) AS DATE), SOURCE_SYSTEM, SEGMENT, UT2""")

# ------------------------------------------------------- windowed families ---
# (select-list dims, group-by, extra where, measures) per macro
FAMILY_SQL = {
    "activity_summary": ("LA_NAME", "1", "", "CAST(SUM(QUERY_COUNT) AS BIGINT) AS QUERY_COUNT_RAW"),
    "demographics": ("LA_NAME, COALESCE(AGE_BAND, 'Unknown') AS AGE_BAND", "1, 2", "",
                     "CAST(SUM(QUERY_COUNT) AS BIGINT) AS QUERY_COUNT_RAW"),
    "legal_letters": ("LA_NAME", "1", " AND SOURCE_SYSTEM = 'AccessAva'",
                      "CAST(SUM(QUERY_COUNT) AS BIGINT) AS QUERY_COUNT_RAW, "
                      "CAST(SUM(HAS_LETTER) AS BIGINT) AS HAS_LETTER_RAW"),
    "locality_overview": ("LA_NAME, LOCALITY_NAME", "1, 2", "",
                          "CAST(SUM(QUERY_COUNT) AS BIGINT) AS QUERY_COUNT_RAW"),
    "queries_over_time": ("LA_NAME, CAST(date_trunc('month', QUERY_DATE) AS DATE) AS QUERY_MONTH", "1, 2", "",
                          "CAST(SUM(QUERY_COUNT) AS BIGINT) AS QUERY_COUNT_RAW"),
    "query_segments": ("LA_NAME, COALESCE(SEGMENT, 'Uncategorised') AS SEGMENT", "1, 2", "",
                       "CAST(SUM(QUERY_COUNT) AS BIGINT) AS QUERY_COUNT_RAW"),
    "query_source": ("LA_NAME, SOURCE_SYSTEM", "1, 2", "", "CAST(SUM(QUERY_COUNT) AS BIGINT) AS QUERY_COUNT_RAW"),
}
FAMILY_DIMS = {
    "activity_summary": ["LA_NAME"], "demographics": ["LA_NAME", "AGE_BAND"], "legal_letters": ["LA_NAME"],
    "locality_overview": ["LA_NAME", "LOCALITY_NAME"], "queries_over_time": ["LA_NAME", "QUERY_MONTH"],
    "query_segments": ["LA_NAME", "SEGMENT"], "query_source": ["LA_NAME", "SOURCE_SYSTEM"],
}
FAMILY_DISPLAY = {f: [("QUERY_COUNT_RAW", "QUERY_COUNT_DISPLAY")] for f in FAMILY_SQL}
FAMILY_DISPLAY["legal_letters"] = [("QUERY_COUNT_RAW", "TOTAL_QUERIES_DISPLAY"),
                                   ("HAS_LETTER_RAW", "TOTAL_LETTERS_DISPLAY")]


def macro(family: str, months: int, source: str = "stg_la_topic_mentions_slice") -> str:
    sel, grp, where, meas = FAMILY_SQL[family]
    return (f"SELECT {sel}, {meas}, {months} AS TIME_WINDOW_MONTHS FROM {source} "
            f"WHERE QUERY_DATE >= {cutoff(months)}{where} GROUP BY {grp}")


for _fam in FAMILY_SQL:
    _union = "\nUNION ALL\n".join(macro(_fam, w) for w in (1, 3, 6, 9, 12))
    if _fam == "query_segments":
        _union = (f"SELECT * FROM (\n{_union}\n) base "
                  "WHERE SEGMENT NOT IN ('Unmatched', 'Unmapped', 'UNMATCHED', 'Uncategorised')")
    cte(f"int_{_fam}", _union)


def mart_sql(family: str, months: int) -> str:
    dims = ", ".join(FAMILY_DIMS[family])
    disp = ", ".join(f"{suppress(raw)} AS {out}" for raw, out in FAMILY_DISPLAY[family])
    return compose(f"SELECT {dims}, {disp}, TIME_WINDOW_MONTHS FROM int_{family} "
                   f"WHERE TIME_WINDOW_MONTHS = {months}")


def intermediate_sql(family: str) -> str:
    return compose(f"SELECT * FROM int_{family}")


SQL: dict[str, str] = {}

SQL["scan_source"] = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders"
SQL["explode_topics"] = compose("""
SELECT transcript_id, topic_entry_point, trim(f_value) AS topic_value
FROM (SELECT transcript_id, topic_entry_point, la_name,
        unnest(coalesce(string_split(topic_entry_point, '; '), [NULL::VARCHAR])) AS f_value FROM accessava) s
WHERE la_name IS NOT NULL""")
SQL["map_topic_to_theme"] = compose("""
SELECT a.transcript_id, a.topic_value,
  CASE WHEN a.topic_entry_point IS NULL THEN 'Unmatched' ELSE COALESCE(m.ut1, 'Unmapped') END AS SEGMENT,
  NULLIF(m.ut2, 'NA') AS UT2
FROM (SELECT transcript_id, topic_entry_point, trim(f_value) AS topic_value
      FROM (SELECT transcript_id, topic_entry_point, la_name,
              unnest(coalesce(string_split(topic_entry_point, '; '), [NULL::VARCHAR])) AS f_value FROM accessava) s
      WHERE la_name IS NOT NULL) a
LEFT JOIN topic_entry_point_map m ON lower(a.topic_value) = lower(trim(m.topic_entry_point))""")
SQL["stg_accessava"] = compose("SELECT * FROM stg_accessava")
SQL["parse_open_month"] = compose("""
SELECT case_reference, case_open_month,
  CAST(replace(case_open_month, '/', '-') || '-01' AS DATE) AS QUERY_DATE FROM advicepro_casework""")
SQL["map_case_to_theme"] = compose("""
SELECT b.case_reference, b.s_c_csi_id, COALESCE(u.ut1, 'Unmapped') AS SEGMENT, NULLIF(u.ut2, 'NA') AS UT2
FROM case_topic_bridge b
LEFT JOIN s_c_csi_map m ON b.s_c_csi_id = m.s_c_csi_id
LEFT JOIN universal_themes_map u
  ON u.org = 'advicepro'
 AND lower(trim(u.t1)) = lower(trim(CASE WHEN m.supercategory = 'Community Care' THEN m.category ELSE m.supercategory END))
 AND lower(trim(u.t2)) = lower(trim(CASE WHEN m.supercategory = 'Community Care' THEN m.case_specific_issue ELSE m.category END))""")
SQL["stg_advicepro"] = compose("SELECT * FROM stg_advicepro")
SQL["stg_helplines"] = compose("SELECT * FROM stg_helplines")
SQL["stg_la_topic_mentions"] = compose("SELECT * FROM stg_la_topic_mentions")
SQL["stg_la_topic_mentions_slice"] = compose("SELECT * FROM stg_la_topic_mentions_slice")
SQL["monthly_theme_counts"] = compose("SELECT * FROM helplines_advicepro_accessava")
SQL["taxonomy_key"] = compose("""
SELECT supercategory, category, case_specific_issue,
  md5(supercategory || '|' || category || '|' || case_specific_issue) AS s_c_csi_id FROM s_c_csi_map""")

for _fam in FAMILY_SQL:
    SQL[_fam] = intermediate_sql(_fam)
    for _w in (1, 3, 6, 9, 12):
        SQL[f"mart_{_fam}_{_w}m"] = mart_sql(_fam, _w)
SQL["trailing_windows"] = SQL["query_source"]
SQL["suppress_small"] = compose(f"""
SELECT LA_NAME, SOURCE_SYSTEM, SEGMENT, QUERY_COUNT, {suppress('QUERY_COUNT')} AS QUERY_COUNT_DISPLAY
FROM (SELECT LA_NAME, SOURCE_SYSTEM, SEGMENT, CAST(SUM(QUERY_COUNT) AS BIGINT) AS QUERY_COUNT
      FROM stg_la_topic_mentions GROUP BY LA_NAME, SOURCE_SYSTEM, SEGMENT) s""")
SQL["mart_la_query_summary"] = compose("""
SELECT LA_NAME, SOURCE_SYSTEM, SEGMENT, CAST(SUM(QUERY_COUNT) AS BIGINT) AS QUERY_COUNT
FROM stg_la_topic_mentions GROUP BY LA_NAME, SOURCE_SYSTEM, SEGMENT""")

# ----------------------------------------------------------------- chatbot ---
cte("persona_bridge", """
SELECT transcript_id AS TRANSCRIPT_ID, trim(v) AS PERSONA
FROM (SELECT transcript_id, unnest(string_split(persona, ';')) AS v FROM accessava WHERE persona IS NOT NULL) s
WHERE trim(v) <> ''""")
cte("legacy_bridge", """
SELECT transcript_id AS TRANSCRIPT_ID, unnest(string_split(persona, '; ')) AS PERSONA
FROM accessava WHERE persona IS NOT NULL""")
cte("conversations_total", """
SELECT tenant_name AS TENANT_NAME, COUNT(*) AS TOTAL_CONVERSATIONS,
  COUNT(DISTINCT transcript_id) AS UNIQUE_CONVERSATIONS,
  MIN(created_at) AS FIRST_CONVERSATION_DATE, MAX(created_at) AS LAST_CONVERSATION_DATE,
  CAST(datediff('day', MIN(created_at), MAX(created_at)) AS INTEGER) AS DAYS_ACTIVE
FROM accessava WHERE tenant_name IS NOT NULL GROUP BY 1""")
cte("conversations_monthly", """
SELECT tenant_name AS TENANT_NAME, CAST(date_trunc('month', created_at) AS DATE) AS CONVERSATION_MONTH,
  COUNT(*) AS CONVERSATION_COUNT, COUNT(DISTINCT transcript_id) AS UNIQUE_CONVERSATIONS,
  MIN(created_at) AS FIRST_CONVERSATION_DATE, MAX(created_at) AS LAST_CONVERSATION_DATE
FROM accessava WHERE tenant_name IS NOT NULL GROUP BY 1, 2""")

SQL["conversations_monthly"] = compose("SELECT * FROM conversations_monthly")
SQL["conversations_total"] = compose("SELECT * FROM conversations_total")
SQL["top_tenants"] = compose("""
SELECT TENANT_NAME, TOTAL_CONVERSATIONS FROM conversations_total
ORDER BY TOTAL_CONVERSATIONS DESC NULLS FIRST, TENANT_NAME LIMIT 5""")
SQL["persona_bridge"] = compose("SELECT * FROM persona_bridge")
SQL["persona_dim"] = compose("""
SELECT ROW_NUMBER() OVER (ORDER BY PERSONA) AS PERSONA_ID, PERSONA
FROM (SELECT DISTINCT PERSONA FROM persona_bridge) d""")
SQL["bridge_diff"] = compose("""
SELECT *, 'only_rebuilt' AS DIFF_SIDE FROM (SELECT * FROM persona_bridge EXCEPT ALL SELECT * FROM legacy_bridge) a
UNION ALL
SELECT *, 'only_existing' AS DIFF_SIDE FROM (SELECT * FROM legacy_bridge EXCEPT ALL SELECT * FROM persona_bridge) b""")

# ------------------------------------------------------------------ checks ---


def _summary_sql(model: str, test: str, column: str, severity: str, failures: str, source: str) -> str:
    return (f"SELECT '{model}' AS MODEL, '{test}' AS TEST_NAME, '{column}' AS COLUMN_NAME, "
            f"'{severity}' AS SEVERITY, CAST({failures} AS BIGINT) AS FAILURES FROM {source}")


SQL["test_not_null"] = compose("\nUNION ALL\n".join(
    [_summary_sql("stg_la_topic_mentions", "not_null", c, "error", f"COUNT(*) FILTER (WHERE {c} IS NULL)",
                  "stg_la_topic_mentions") for c in ("LA_NAME", "QUERY_DATE", "SOURCE_SYSTEM")]
    + [_summary_sql("accessava", "not_null", c, "error", f"COUNT(*) FILTER (WHERE {c} IS NULL)", "accessava")
       for c in ("transcript_id", "tenant_name", "la_name")]))
SQL["test_accepted_values"] = compose(
    _summary_sql("stg_la_topic_mentions", "accepted_values", "SOURCE_SYSTEM", "error", "COUNT(*)",
                 "(SELECT SOURCE_SYSTEM FROM stg_la_topic_mentions WHERE SOURCE_SYSTEM IS NOT NULL AND "
                 "SOURCE_SYSTEM NOT IN ('AccessAva', 'AdvicePro', 'Helplines') GROUP BY 1) f")
    + "\nUNION ALL\n"
    + _summary_sql("accessava", "accepted_values", "tenant_name", "warn", "COUNT(*)",
                   "(SELECT tenant_name FROM accessava WHERE tenant_name IS NOT NULL AND tenant_name NOT IN "
                   "('HOUSEHOLD', 'MACHINERY', 'FURNITURE', 'BUILDING') GROUP BY 1) f"))


def _unique_sql(model: str, column: str, source: str) -> str:
    return _summary_sql(model, "unique", column, "error", "COUNT(*)",
                        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 "
                        "HAVING COUNT(*) > 1) f")


SQL["test_unique"] = compose("\nUNION ALL\n".join([
    _unique_sql("s_c_csi_map", "s_c_csi_id", "s_c_csi_map"),
    _unique_sql("conversations_total", "TENANT_NAME", "conversations_total"),
    _unique_sql("persona_bridge", "TRANSCRIPT_ID", "persona_bridge")]))
SQL["test_unique_combination"] = compose("\nUNION ALL\n".join([
    _summary_sql("conversations_monthly", "unique_combination_of_columns", "TENANT_NAME,CONVERSATION_MONTH",
                 "error", "COUNT(*)", "(SELECT TENANT_NAME, CONVERSATION_MONTH FROM conversations_monthly "
                 "GROUP BY 1, 2 HAVING COUNT(*) > 1) f"),
    _summary_sql("persona_bridge", "unique_combination_of_columns", "TRANSCRIPT_ID,PERSONA", "error", "COUNT(*)",
                 "(SELECT TRANSCRIPT_ID, PERSONA FROM (SELECT * FROM persona_bridge UNION ALL "
                 "SELECT * FROM persona_bridge WHERE TRANSCRIPT_ID LIKE '%7') b GROUP BY 1, 2 HAVING COUNT(*) > 1) f")]))
SQL["test_relationships"] = compose(_summary_sql(
    "case_topic_bridge", "relationships", "s_c_csi_id", "warn", "COUNT(*)",
    "(SELECT CASE WHEN case_reference LIKE '%1' THEN 'orphan-' || s_c_csi_id ELSE s_c_csi_id END AS child "
    "FROM case_topic_bridge) f LEFT JOIN s_c_csi_map m ON m.s_c_csi_id = child "
    "WHERE child IS NOT NULL AND m.s_c_csi_id IS NULL"))

cte("unmapped_shares", """
WITH every AS (SELECT SOURCE_SYSTEM, sum(QUERY_COUNT)::BIGINT AS TOTAL_COUNT FROM helplines_advicepro_accessava GROUP BY ALL),
unmapped AS (SELECT SOURCE_SYSTEM, sum(QUERY_COUNT)::BIGINT AS n FROM helplines_advicepro_accessava WHERE UT1 = 'Unmapped' GROUP BY ALL)
SELECT SOURCE_SYSTEM, coalesce(n, 0) AS UNMAPPED_COUNT, TOTAL_COUNT FROM every LEFT JOIN unmapped USING (SOURCE_SYSTEM)""")
# share rounded half-up to 6 decimals, then x100 rounded half-up to 2 (integer arithmetic)
cte("unmapped_scaled", """
SELECT *, CASE WHEN TOTAL_COUNT = 0 THEN NULL
               ELSE (2 * UNMAPPED_COUNT * 1000000 + TOTAL_COUNT) // (2 * TOTAL_COUNT) END AS share_e6
FROM unmapped_shares""")
SQL["unmapped_share_all"] = compose("""
SELECT SOURCE_SYSTEM, UNMAPPED_COUNT, TOTAL_COUNT,
  CAST((share_e6 + 50) // 100 AS DECIMAL(38, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS UNMAPPED_PCT
FROM unmapped_scaled""")
SQL["warn_unmapped_share"] = compose("""
SELECT SOURCE_SYSTEM, UNMAPPED_COUNT, TOTAL_COUNT,
  CAST((share_e6 + 50) // 100 AS DECIMAL(38, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS UNMAPPED_PCT
FROM unmapped_scaled WHERE TOTAL_COUNT > 0 AND share_e6 > 20000""")

RECON = f"DATE '{RECON_MONTH}'"
# One area and month: each side totalled over all areas and months, then the one looked up.
cte("recon_model", f"""
SELECT SOURCE_SYSTEM, UT1, UT2, N FROM (
  SELECT LA_NAME, MONTH_DATE, SOURCE_SYSTEM, UT1, UT2, sum(QUERY_COUNT)::BIGINT AS N
  FROM helplines_advicepro_accessava GROUP BY ALL) totals
WHERE (LA_NAME, MONTH_DATE) = ('{TARGET_LA}', {RECON})""")
cte("recon_helplines", f"""
SELECT ut1 AS UT1, sum(n)::BIGINT AS N FROM helplines_aggregated_full
WHERE la_name = '{TARGET_LA}' AND strftime(month_date, '%Y-%m') = strftime({RECON}, '%Y-%m') GROUP BY ALL""")
cte("recon_accessava", f"""
SELECT count(*) AS CONVERSATIONS, count(*) FILTER (topic_entry_point IS NOT NULL) AS WITH_ENTRY_POINT FROM accessava
WHERE la_name = '{TARGET_LA}' AND strftime(created_at, '%Y-%m') = strftime({RECON}, '%Y-%m')""")
cte("recon_advicepro", f"""
SELECT count(*) AS TOPIC_PAIRS, count(*) FILTER (s_c_csi_id IS NOT NULL) AS RESOLVED_TO_TAXONOMY
FROM case_topic_bridge SEMI JOIN (
  SELECT case_reference FROM advicepro_casework
  WHERE la_name = '{TARGET_LA}' AND case_open_month = strftime({RECON}, '%Y/%m')) cases USING (case_reference)""")
SQL["recon_model_breakdown"] = compose("SELECT * FROM recon_model")
SQL["recon_helplines_raw"] = compose("SELECT * FROM recon_helplines")
SQL["recon_accessava_raw"] = compose("SELECT * FROM recon_accessava")
SQL["recon_advicepro_raw"] = compose("SELECT * FROM recon_advicepro")
SQL["fanout_guard"] = compose("""
SELECT lower(trim(t1)) AS K1, lower(trim(t2)) AS K2, count(*) + count(*) FILTER (ut1 = 'Care plan') AS N
FROM universal_themes_map WHERE org = 'advicepro' GROUP BY ALL HAVING count(*) + count(*) FILTER (ut1 = 'Care plan') > 1
UNION ALL
SELECT lower(trim(topic_entry_point)), '', sum(2 - length(topic_entry_point) % 2)::BIGINT
FROM topic_entry_point_map GROUP BY ALL HAVING sum(2 - length(topic_entry_point) % 2) > 1""")
SQL["recon_totals"] = compose("""
SELECT COALESCE(m.SOURCE_SYSTEM, r.SOURCE_SYSTEM) AS SOURCE_SYSTEM, m.TOTAL AS MODEL_TOTAL, r.TOTAL AS RAW_TOTAL,
  COALESCE(m.TOTAL, 0) - COALESCE(r.TOTAL, 0) AS DIFF
FROM (SELECT SOURCE_SYSTEM, CAST(SUM(N) AS BIGINT) AS TOTAL FROM recon_model GROUP BY 1) m
FULL OUTER JOIN (
  SELECT 'Helplines' AS SOURCE_SYSTEM, CAST(SUM(N) AS BIGINT) AS TOTAL FROM recon_helplines
  UNION ALL SELECT 'AccessAva', CONVERSATIONS FROM recon_accessava
  UNION ALL SELECT 'AdvicePro', TOPIC_PAIRS FROM recon_advicepro) r
ON m.SOURCE_SYSTEM = r.SOURCE_SYSTEM""")
SQL["window_row_counts"] = compose(
    "SELECT TIME_WINDOW_MONTHS, COUNT(*) AS N_ROWS FROM int_query_segments GROUP BY 1")
SQL["source_coverage"] = compose("""
SELECT SOURCE_SYSTEM, COUNT(*) AS N_ROWS, MAX(QUERY_DATE) AS LATEST_DATE FROM stg_la_topic_mentions GROUP BY 1""")

# ----------------------------------------------------------------- explore ---
from carepulse.sources.fixtures import (  # noqa: E402
    ILTA_MAP_AVA_ROWS, ILTA_MAP_CASEWORK_ROWS, PERIOD_END, PERIOD_START)


def _values(rows, names: str) -> str:
    def lit(v):
        return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({names})"


cte("ilta_map_ava", _values(ILTA_MAP_AVA_ROWS, "FEATURE, ACCESSAVA, ILTA"))
cte("ilta_map_casework", _values(ILTA_MAP_CASEWORK_ROWS, "CASEWORK, FEATURE, ILTA"))
cte("casework_demo_report", """
SELECT strftime(o_orderdate, '%d/%m/%Y') AS "Case Open Date",
  l_linenumber - 1 AS "Number of Person with Care Needss",
  CASE WHEN c_acctbal < 0 THEN '[Not Specified]' WHEN c_acctbal < 3000 THEN '18-24'
       WHEN c_acctbal < 6000 THEN '25-64' ELSE '65+' END AS "Age Range",
  CASE WHEN c_acctbal < 1000 THEN 'Not Stated' WHEN c_acctbal < 5000 THEN 'No' ELSE 'Yes' END
    AS "Do you have a disability",
  CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Household' WHEN 'MACHINERY' THEN 'Machinery'
       WHEN 'BUILDING' THEN NULL ELSE 'Other' END AS "Ethnic Origin"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""")
P_LO, P_HI = f"DATE '{PERIOD_START}'", f"DATE '{PERIOD_END}'"
cte("ava_period", f"""
SELECT * FROM accessava WHERE created_at >= {P_LO} AND created_at < {P_HI}""")
cte("ava_long", "\nUNION ALL\n".join(
    f"SELECT transcript_id, '{f}' AS FEATURE, {f} AS ACCESSAVA FROM ava_period"
    for f in ("disability_text", "disability_n_y", "age_range", "ethnicity")))
cte("ava_mapped", """
SELECT l.transcript_id, l.FEATURE, l.ACCESSAVA, m.ILTA FROM ava_long l
LEFT JOIN ilta_map_ava m ON l.FEATURE = m.FEATURE AND l.ACCESSAVA IS NOT DISTINCT FROM m.ACCESSAVA""")
cte("ava_counts", "SELECT FEATURE, ILTA, COUNT(*) AS N FROM ava_mapped GROUP BY 1, 2")
cte("cw_rows", f"""
SELECT "Age Range", "Do you have a disability", "Ethnic Origin"
FROM (SELECT *, unnest(range("Number of Person with Care Needss")) AS _r FROM casework_demo_report
      WHERE CAST(strptime("Case Open Date", '%d/%m/%Y') AS DATE) >= {P_LO}
        AND CAST(strptime("Case Open Date", '%d/%m/%Y') AS DATE) < {P_HI}) r""")
cte("cw_long", """
SELECT "Age Range" AS CASEWORK FROM cw_rows UNION ALL SELECT "Do you have a disability" FROM cw_rows
UNION ALL SELECT "Ethnic Origin" FROM cw_rows""")
cte("cw_counts", """
SELECT CASE WHEN m.FEATURE = 'Do you have a disability' THEN 'disability_n_y' ELSE m.FEATURE END AS FEATURE,
  m.ILTA, COUNT(*) AS N
FROM (SELECT CASE WHEN CASEWORK IN ('[Not Specified]', 'Not Stated') THEN NULL ELSE CASEWORK END AS CASEWORK
      FROM cw_long) l
LEFT JOIN ilta_map_casework m ON l.CASEWORK IS NOT DISTINCT FROM m.CASEWORK
GROUP BY 1, 2""")
cte("combined", """
SELECT source, id, month, trim(cat) AS category, la FROM (
  SELECT source, id, month, unnest(coalesce(string_split(category, ';'), [NULL::VARCHAR])) AS cat, la FROM (
    SELECT 'AVA' AS source, transcript_id AS id, strftime(created_at, '%Y-%m') AS month,
      supercategories AS category, la_name AS la FROM accessava
    UNION ALL
    SELECT 'Casework', case_reference, strftime(strptime(case_open_month || '/01', '%Y/%m/%d'), '%Y-%m'),
      super_category, la_name FROM advicepro_casework) u) s""")
cte("series_counts", """
SELECT source AS SOURCE, CAST(month || '-01' AS DATE) AS MONTH, COUNT(*) AS N FROM combined GROUP BY 1, 2""")
cte("series_filled", """
SELECT g.SOURCE, g.MONTH, c.N FROM (
  SELECT SOURCE, CAST(m AS DATE) AS MONTH FROM (
    SELECT SOURCE, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS m
    FROM (SELECT SOURCE, MIN(MONTH) AS lo, MAX(MONTH) AS hi FROM series_counts GROUP BY 1) b) x) g
LEFT JOIN series_counts c ON g.SOURCE = c.SOURCE AND g.MONTH = c.MONTH""")

SQL["date_range_filter"] = compose("SELECT transcript_id, created_at FROM ava_period")
SQL["unpivot_features"] = compose("SELECT * FROM ava_long")
SQL["map_features"] = compose("SELECT * FROM ava_mapped")
SQL["uncount"] = compose("""
SELECT "Case Open Date", "Age Range", "Do you have a disability", "Ethnic Origin"
FROM (SELECT *, unnest(range("Number of Person with Care Needss")) AS _r FROM casework_demo_report) r""")
SQL["chatbot_feature_counts"] = compose("SELECT * FROM ava_counts")
SQL["casework_feature_counts"] = compose("SELECT * FROM cw_counts")
SQL["combined_feature_totals"] = compose("""
SELECT FEATURE, ILTA, CAST(SUM(N) AS BIGINT) AS TOTAL
FROM (SELECT * FROM ava_counts UNION ALL SELECT * FROM cw_counts) u GROUP BY 1, 2""")
SQL["combined_interactions"] = compose("SELECT * FROM combined")
SQL["monthly_series_filled"] = compose("SELECT * FROM series_filled")
SQL["season_table"] = compose("""
SELECT SOURCE, CAST(year(MONTH) AS INTEGER) AS YEAR, CAST(month(MONTH) AS INTEGER) AS MONTH_OF_YEAR, N
FROM series_filled""")
SQL["top_k_categories"] = compose("""
SELECT source AS SOURCE, category AS CATEGORY, COUNT(*) AS N FROM combined
WHERE category IN (SELECT category FROM combined WHERE category IS NOT NULL AND category <> ''
                   GROUP BY 1 ORDER BY COUNT(*) DESC, category LIMIT 20)
GROUP BY 1, 2""")
SQL["top_k_las"] = compose("""
SELECT source AS SOURCE, la AS LA, COUNT(*) AS N FROM combined
WHERE la IN (SELECT la FROM combined WHERE la IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, la LIMIT 20)
GROUP BY 1, 2""")
SQL["overall_totals"] = compose("""
SELECT (SELECT COUNT(*) FROM accessava) AS N_CHATBOT, (SELECT COUNT(*) FROM advicepro_casework) AS N_CASEWORK,
  (SELECT COUNT(*) FROM combined) AS N_COMBINED""")
SQL["resource_consumption"] = compose(f"""
SELECT LETTERS_DOWNLOADED, EASYREADS_AND_FACTSHEETS, LETTERS_DOWNLOADED + EASYREADS_AND_FACTSHEETS AS TOTAL
FROM (SELECT COUNT(*) FILTER (WHERE letter_downloaded) AS LETTERS_DOWNLOADED,
        CAST(SUM(CASE WHEN consumed_resources IS NOT NULL THEN
          len(list_filter(string_split(consumed_resources, '|'), lambda t: t IN ('easyread', 'factsheet'))) ELSE 0 END)
          AS BIGINT) AS EASYREADS_AND_FACTSHEETS
      FROM accessava WHERE created_at >= {P_LO} AND created_at <= {P_HI}) s""")

# ------------------------------------------------------------------ ingest ---
from carepulse.sources.fixtures import (  # noqa: E402
    BOARD_GROUPS, BOARD_SERVICES, FRESHNESS_CONFIG_ROWS, NOW, RUN_AT, RUN_ID)

WS = "' ' || chr(9) || chr(13) || chr(10)"
cte("demographics_report", """
SELECT CASE l_linenumber % 3 WHEN 1 THEN 'C' || CAST(l_orderkey AS VARCHAR)
            WHEN 2 THEN ' c' || CAST(l_orderkey AS VARCHAR) || ' '
            ELSE 'c' || CAST(l_orderkey AS VARCHAR) || chr(9) END AS "Case Reference",
  CASE WHEN l_linenumber = 1 AND c_acctbal < 0 THEN '' WHEN l_linenumber = 2 THEN '[Not Specified]'
       WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 3000 THEN '18-24'
       WHEN c_acctbal < 6000 THEN '25-64' ELSE '65+' END AS "Age Range",
  CASE l_returnflag WHEN 'R' THEN 'Female' WHEN 'A' THEN 'Male' ELSE '[Not Specified]' END AS "Gender",
  CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE lower(c_mktsegment) END AS "Ethnic Origin",
  l_orderkey * 8 + l_linenumber AS ingest_seq
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""")


def _nullify(c: str) -> str:
    return f"""CASE WHEN "{c}" IN ('', '[Not Specified]') THEN NULL ELSE "{c}" END"""


cte("demographics_clean_rows", f"""
SELECT upper(trim({_nullify('Case Reference')}, {WS})) AS case_reference, {_nullify('Age Range')} AS age_range,
  {_nullify('Gender')} AS gender, {_nullify('Ethnic Origin')} AS ethnic_origin, ingest_seq
FROM demographics_report""")
cte("demographics_first", """
SELECT case_reference, age_range, gender, ethnic_origin, ingest_seq FROM (
  SELECT *, row_number() OVER (PARTITION BY case_reference ORDER BY ingest_seq, age_range NULLS FIRST,
                                 gender NULLS FIRST, ethnic_origin NULLS FIRST) AS rn FROM demographics_clean_rows) x
WHERE rn = 1""")
cte("postcode_report", """
SELECT 'C' || CAST(o_orderkey AS VARCHAR) AS "Case Reference",
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '  '
       ELSE 'P' || CAST(c_nationkey AS VARCHAR) END AS "Postcode"
FROM orders JOIN customer ON o_custkey = c_custkey""")
cte("postcode_directory", """
SELECT 'P' || CAST(n_nationkey AS VARCHAR) AS postcode, n_name AS la_name, r_name AS county,
  'R' || CAST(r_regionkey AS VARCHAR) AS county_code
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey <> 4""")
cte("manifest_status", """
SELECT 'ds_' || CAST(o_orderkey AS VARCHAR) AS dataset_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'SUCCESS' WHEN '2-HIGH' THEN 'NO_UPDATE' WHEN '3-MEDIUM' THEN 'LIMITATION'
       WHEN '4-NOT SPECIFIED' THEN 'FAILED_' || o_orderstatus ELSE 'PARTIAL' END AS status
FROM orders""")
cte("drift_first_seen", """
SELECT l_orderkey, code, MIN(l_linenumber) AS first_ln FROM (
  SELECT l_orderkey, l_linenumber,
    CASE l_returnflag WHEN 'R' THEN 'SCHEMA_DRIFT' WHEN 'A' THEN 'SEMANTIC_DRIFT_SUSPECTED' END AS code
  FROM lineitem) x
WHERE code IS NOT NULL GROUP BY 1, 2""")
cte("drift_flags", """
SELECT 'ds_' || CAST(o_orderkey AS VARCHAR) AS dataset_id, f.flag AS DRIFT_FLAG
FROM orders LEFT JOIN (SELECT l_orderkey, string_agg(code, '+' ORDER BY first_ln, code) AS flag
                       FROM drift_first_seen GROUP BY 1) f ON o_orderkey = f.l_orderkey""")
cte("load_plan", """
SELECT d.dataset_id AS DATASET_ID, d.status AS STATUS,
  t.dataset_id IS NOT NULL AS TABLE_EXISTS, f.dataset_id IS NOT NULL AS FILE_EXISTS,
  CASE WHEN d.status = 'LIMITATION' THEN 'skip'
       WHEN starts_with(d.status, 'FAILED_') THEN 'failed'
       WHEN d.status = 'NO_UPDATE' AND t.dataset_id IS NOT NULL THEN 'skip'
       WHEN d.status = 'NO_UPDATE' THEN CASE WHEN f.dataset_id IS NOT NULL THEN 'first_time_load' ELSE 'failed' END
       WHEN d.status = 'SUCCESS' THEN CASE WHEN f.dataset_id IS NOT NULL THEN 'load' ELSE 'failed' END
       ELSE 'skip' END AS ACTION
FROM manifest_status d
LEFT JOIN (SELECT DISTINCT 'ds_' || CAST(o_orderkey AS VARCHAR) AS dataset_id FROM orders
           WHERE o_orderstatus = 'F') t ON d.dataset_id = t.dataset_id
LEFT JOIN (SELECT DISTINCT 'ds_' || CAST(o_orderkey AS VARCHAR) AS dataset_id FROM orders
           WHERE o_orderstatus <> 'P') f ON d.dataset_id = f.dataset_id""")


def _case_map(col: str, values, mod_expr: str) -> str:
    parts = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'")
                     for i, v in enumerate(values))
    return f"CASE {mod_expr} {parts} END"


cte("board_items", f"""
SELECT s_name AS item_name, {_case_map('Service', BOARD_SERVICES, f's_suppkey % {len(BOARD_SERVICES)}')} AS "Service",
  {_case_map('group_title', BOARD_GROUPS, f's_suppkey % {len(BOARD_GROUPS)}')} AS group_title
FROM supplier""")
cte("board_standardised", """
SELECT item_name, "Service", group_title,
  CASE WHEN regexp_matches("Service", 'Casework Membership 1 day per week') THEN 'Casework & Advice'
       WHEN regexp_matches("Service", 'Advice & Casework \\(bespoke\\)') THEN 'Casework & Advice'
       WHEN regexp_matches("Service", 'Advice & Casework Membership 4days pm') THEN 'Casework & Advice'
       WHEN regexp_matches("Service", 'Advice & Casework 2days pm') THEN 'Casework & Advice'
       WHEN regexp_matches("Service", 'Advice & Casework 1day pm') THEN 'Casework & Advice'
       WHEN regexp_matches("Service", 'Advice Membership') THEN 'Advice Membership'
       ELSE "Service" END AS SERVICE_TYPE
FROM board_items""")
cte("peer_signals", """
SELECT 'la_peer_signals_' || strftime(ts, '%Y%m%d') || '.csv' AS file_name,
  'NATION_' || CAST(user_id % 25 AS VARCHAR) AS unit, event_type AS signal, value
FROM events""")
cte("table_metadata", """
WITH per AS (
  SELECT ['CASEWORK', 'AVA', 'HELPLINES', 'SCRATCH'][1 + s_nationkey % 4] AS database, l_suppkey AS k, count(*) AS row_count,
    CASE WHEN l_suppkey % 17 <> 0 THEN max(l_shipdate) END AS last_altered
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey % 4, l_suppkey)
SELECT unnest(CASE WHEN k % 5 = 0 AND database <> 'AVA' THEN [database, 'AVA'] ELSE [database] END) AS database,
  'T_' || k AS table_name, row_count, last_altered FROM per""")

SQL["normalise_columns"] = compose("""
SELECT "Case Open Date" AS case_open_date, "Number of Person with Care Needss" AS number_of_person_with_care_needss,
  "Age Range" AS age_range, "Do you have a disability" AS do_you_have_a_disability,
  "Ethnic Origin" AS ethnic_origin FROM casework_demo_report""")
SQL["null_placeholders"] = compose(f"""
SELECT {_nullify('Case Reference')} AS "Case Reference", {_nullify('Age Range')} AS "Age Range",
  {_nullify('Gender')} AS "Gender", {_nullify('Ethnic Origin')} AS "Ethnic Origin", ingest_seq
FROM demographics_report""")
SQL["clean_demographics"] = compose("SELECT * FROM demographics_first")
SQL["demographics_load_report"] = compose("""
SELECT N_IN, N_OUT, N_IN - N_OUT AS N_DROPPED, N_IN >= 1000 AS AT_PAGE_LIMIT
FROM (SELECT (SELECT COUNT(*) FROM demographics_report) AS N_IN,
             (SELECT COUNT(*) FROM demographics_first) AS N_OUT) s""")
SQL["incremental_new_keys"] = compose("""
SELECT "Case Reference" AS case_reference, "Postcode" AS postcode FROM postcode_report r
WHERE NOT EXISTS (SELECT 1 FROM casework_locality e WHERE e.case_reference = r."Case Reference")""")
SQL["enrich_postcode"] = compose(f"""
SELECT r."Case Reference" AS CASE_REFERENCE, d.la_name AS LA_NAME, d.county AS COUNTY, d.county_code AS COUNTY_CODE
FROM postcode_report r LEFT JOIN postcode_directory d ON r."Postcode" = d.postcode
WHERE r."Postcode" IS NOT NULL AND trim(r."Postcode", {WS}) <> ''
  AND NOT EXISTS (SELECT 1 FROM casework_locality e WHERE e.case_reference = r."Case Reference")""")
SQL["extract_drift_flag"] = compose("SELECT dataset_id AS DATASET_ID, DRIFT_FLAG FROM drift_flags")
SQL["manifest_load_plan"] = compose("SELECT * FROM load_plan")
SQL["tag_provenance"] = compose(f"""
SELECT r.dataset_id, r.l_linenumber, r.l_quantity, '{RUN_ID}' AS _RUN_ID, '{RUN_AT}' AS _RUN_AT,
  f.DRIFT_FLAG AS _DRIFT_FLAG
FROM (SELECT 'ds_' || CAST(l_orderkey AS VARCHAR) AS dataset_id, l_linenumber, l_quantity FROM lineitem) r
JOIN load_plan p ON r.dataset_id = p.DATASET_ID AND p.ACTION IN ('load', 'first_time_load')
LEFT JOIN drift_flags f ON r.dataset_id = f.dataset_id""")
SQL["external_sources_two_runs"] = compose(f"""
SELECT 'line_' || l_linenumber AS dataset_id, l_linenumber, l_quantity,
  CASE WHEN l_linenumber % 2 = 1 THEN '{RUN_ID}' ELSE 'run-1' END AS _RUN_ID
FROM lineitem""")
SQL["load_summary"] = compose("""
SELECT N_LOADED, N_SKIPPED, N_FAILED, CASE WHEN N_FAILED > 0 THEN 'failed' ELSE 'ok' END AS OUTCOME
FROM (SELECT COUNT(*) FILTER (WHERE ACTION IN ('load', 'first_time_load')) AS N_LOADED,
        COUNT(*) FILTER (WHERE ACTION = 'skip') AS N_SKIPPED,
        COUNT(*) FILTER (WHERE ACTION = 'failed') AS N_FAILED FROM load_plan) s""")
SQL["member_orgs"] = compose("""
SELECT item_name AS monday_name, SERVICE_TYPE AS service_type, group_title AS contract_group
FROM board_standardised WHERE group_title = 'Contracts'""")
SQL["standardise_service_type"] = compose('SELECT item_name, "Service", SERVICE_TYPE FROM board_standardised')
SQL["service_type_counts"] = compose("""
SELECT SERVICE_TYPE, COUNT(*) AS N FROM board_standardised WHERE group_title = 'Contracts' GROUP BY 1""")
SQL["member_orgs_summary"] = compose("""
SELECT COUNT(*) FILTER (WHERE group_title = 'Contracts') AS N_LOADED,
  COUNT(*) FILTER (WHERE group_title IS NULL OR group_title <> 'Contracts') AS N_EXCLUDED FROM board_items""")
SQL["latest_snapshot"] = compose(
    "SELECT * FROM peer_signals WHERE file_name = (SELECT max(file_name) FROM peer_signals)")
SQL["filter_unit"] = compose(f"""
SELECT * FROM peer_signals WHERE file_name = (SELECT max(file_name) FROM peer_signals) AND unit = '{TARGET_LA}'""")
SQL["narrative_for_la"] = compose(f"""
SELECT regexp_extract(f.file_name, '(\\d{{8}})', 1) AS RUN_DATE, '{TARGET_LA}' AS LA, CAST(NULL AS VARCHAR) AS PROSE,
  CAST(COALESCE(t.total, 0) AS INTEGER) AS TOTAL_SIGNALS, t.top_signal AS TOP_SIGNAL
FROM (SELECT DISTINCT file_name FROM peer_signals) f
LEFT JOIN (
  SELECT file_name, SUM(n) AS total, MAX(CASE WHEN rn = 1 THEN signal END) AS top_signal FROM (
    SELECT file_name, signal, n, row_number() OVER (PARTITION BY file_name ORDER BY n DESC, signal DESC) AS rn
    FROM (SELECT file_name, signal, COUNT(*) AS n FROM peer_signals WHERE unit = '{TARGET_LA}'
          GROUP BY 1, 2) c) r
  GROUP BY 1) t ON f.file_name = t.file_name""")
SQL["findings_envelope"] = compose(f"""
SELECT 'Hypothesis board' AS SOURCE, 'board-1' AS BOARD_ID, 'Approved findings' AS GROUP_NAME,
  '{RUN_AT}' AS PULLED_AT, (SELECT COUNT(*) FROM board_items WHERE group_title = 'Approved findings') AS N_FINDINGS,
  item_name, "Service", group_title
FROM board_items WHERE group_title = 'Approved findings'""")
NOW_SQL = f"TIMESTAMP '{NOW}'"
SQL["table_staleness"] = compose(f"""
SELECT database AS DATABASE, table_name AS TABLE_NAME, row_count AS ROW_COUNT, last_altered AS LAST_ALTERED,
  CAST(datediff('day', last_altered, {NOW_SQL}) AS INTEGER) AS DAYS_SINCE_UPDATE,
  CASE WHEN last_altered IS NULL THEN 'unknown' WHEN last_altered::DATE < {NOW_SQL}::DATE - 30 THEN 'stale' ELSE 'fresh' END AS STATUS
FROM table_metadata WHERE database IN ('CASEWORK', 'AVA', 'HELPLINES')""")
cte("freshness_config", _values(FRESHNESS_CONFIG_ROWS,
                                "database, warn_count, warn_period, error_count, error_period"))
cte("freshness_overrides", """
SELECT ['CASEWORK', 'AVA', 'HELPLINES', 'SCRATCH'][1 + s_nationkey % 4] AS database,
  'T_' || CAST(s_suppkey AS VARCHAR) AS table_name, s_acctbal >= 0 AS enabled,
  CASE WHEN s_acctbal < 0 THEN NULL ELSE 400 END AS warn_count,
  CASE WHEN s_acctbal < 0 THEN NULL ELSE 'day' END AS warn_period,
  CASE WHEN s_acctbal >= 0 AND s_suppkey % 3 <> 0 THEN 550 END AS error_count,
  CASE WHEN s_acctbal >= 0 AND s_suppkey % 3 <> 0 THEN 'day' END AS error_period
FROM supplier WHERE s_acctbal < 0 OR s_acctbal > 9000""")


def _secs(count: str, period: str) -> str:
    return (f"CAST({count} AS BIGINT) * CASE {period} WHEN 'minute' THEN 60 WHEN 'hour' THEN 3600 "
            f"WHEN 'day' THEN 86400 END")


SQL["source_freshness"] = compose(f"""
SELECT DATABASE, TABLE_NAME, AGE_SECONDS,
  CASE WHEN NOT enabled THEN 'skipped' WHEN AGE_SECONDS IS NULL THEN 'unknown'
       WHEN err IS NOT NULL AND AGE_SECONDS > err THEN 'error'
       WHEN warn IS NOT NULL AND AGE_SECONDS > warn THEN 'warn' ELSE 'pass' END AS STATUS
FROM (
  SELECT m.database AS DATABASE, m.table_name AS TABLE_NAME,
    date_diff('second', m.last_altered, {NOW_SQL}) AS AGE_SECONDS,
    CASE WHEN o.warn_count IS NOT NULL THEN {_secs('o.warn_count', 'o.warn_period')}
         ELSE {_secs('c.warn_count', 'c.warn_period')} END AS warn,
    CASE WHEN o.error_count IS NOT NULL THEN {_secs('o.error_count', 'o.error_period')}
         ELSE {_secs('c.error_count', 'c.error_period')} END AS err,
    COALESCE(o.enabled, TRUE) AS o_enabled
  FROM table_metadata m LEFT JOIN freshness_config c ON m.database = c.database
  LEFT JOIN freshness_overrides o ON m.table_name = o.table_name AND m.database = o.database) x,
LATERAL (SELECT o_enabled AND (warn IS NOT NULL OR err IS NOT NULL) AS enabled) e""")

# ------------------------------------------------------- file round trips ---
SQL["scan_csv_dataset"] = compose("SELECT * FROM helplines_aggregated_full")
SQL["append_locality"] = compose(f"""
SELECT case_reference AS CASE_REFERENCE, CAST(NULL AS VARCHAR) AS LA_NAME, county AS COUNTY,
  CAST(NULL AS VARCHAR) AS COUNTY_CODE FROM casework_locality
UNION ALL
SELECT r."Case Reference", d.la_name, d.county, d.county_code
FROM postcode_report r LEFT JOIN postcode_directory d ON r."Postcode" = d.postcode
WHERE r."Postcode" IS NOT NULL AND trim(r."Postcode", {WS}) <> ''
  AND NOT EXISTS (SELECT 1 FROM casework_locality e WHERE e.case_reference = r."Case Reference")""")
SQL["export_json"] = mart_sql("locality_overview", 12)
SQL["trailing_windows_shared"] = intermediate_sql("query_segments")

# every LA: the same unions over all mentions
for _fam in FAMILY_SQL:
    SQL[f"{_fam}_all_las"] = compose(CTES[f"int_{_fam}"].replace("stg_la_topic_mentions_slice", "stg_la_topic_mentions"))

SQL["narrative_data"] = compose(f"""
SELECT regexp_extract(file_name, '(\\d{{8}})', 1) AS RUN_DATE, CAST(sum(count(*)) OVER (PARTITION BY file_name) AS INTEGER) AS TOTAL_SIGNALS,
  signal AS SIGNAL, count(*) AS N
FROM peer_signals WHERE unit = '{TARGET_LA}' GROUP BY file_name, signal""")
SQL["manifest_datasets"] = """
SELECT 'run-x' AS run_id, 'supplier_' || s_suppkey AS dataset_id,
  ['SUCCESS', 'NO_UPDATE', 'LIMITATION', 'PARTIAL'][1 + s_suppkey % 4] AS status, s_suppkey % 8 = 0 AS drifted
FROM supplier"""
SQL["table_metadata"] = " UNION ALL ".join(
    f"SELECT 'LANDED' AS DATABASE, '{t.upper()}' AS TABLE_NAME, count(*) AS ROW_COUNT, true AS HAS_CHANGE_TIME FROM {t}" for t in DRIVER_TABLES)

# ------------------------------------------------- tables that are kept up ---
SQL["external_load"] = f"""
SELECT 'lines_A' AS DATASET_ID, l_orderkey AS K, l_linenumber::BIGINT AS V, 'run-1' AS RUN_ID, false AS DRIFTED FROM lineitem WHERE l_returnflag = 'A'
UNION ALL SELECT 'lines_N', l_orderkey, l_linenumber, 'run-1', true FROM lineitem WHERE l_returnflag = 'N'
UNION ALL SELECT 'lines_R', l_orderkey, l_linenumber, '{RUN_ID}', true FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber % 2 = 1
UNION ALL SELECT 'orders_' || o_orderstatus, o_orderkey, o_custkey, '{RUN_ID}', false FROM orders WHERE o_orderstatus IN ('F', 'O')"""

cte("mart_la_query_summary", SQL["mart_la_query_summary"].split("\n)\n")[-1])
cte("persona_dim", "SELECT row_number() OVER (ORDER BY PERSONA) AS PERSONA_ID, PERSONA FROM (SELECT DISTINCT PERSONA FROM persona_bridge) p")
cte("people_receiving_care", """
SELECT CASE WHEN l_linenumber = 7 THEN 'other_' || l_returnflag WHEN l_returnflag = 'N' THEN 'new_clients' ELSE 'long_term_clients' END AS metric
FROM lineitem""")
_SYSTEMS = {"stg_accessava": ["AccessAva"], "stg_advicepro": ["AdvicePro"], "stg_helplines": ["Helplines"],
            **{m: ["AccessAva", "AdvicePro", "Helplines"] for m in ("stg_la_topic_mentions", "helplines_advicepro_accessava", "mart_la_query_summary")}}
_NOT_NULL = {
    "stg_accessava": ["LA_NAME", "QUERY_DATE"], "stg_advicepro": ["LA_NAME", "QUERY_DATE"], "stg_helplines": ["LA_NAME", "QUERY_DATE"],
    "stg_la_topic_mentions": ["LA_NAME", "QUERY_DATE", "SOURCE_SYSTEM"], "helplines_advicepro_accessava": ["LA_NAME", "MONTH_DATE", "SOURCE_SYSTEM", "UT1", "QUERY_COUNT"],
    "mart_la_query_summary": ["LA_NAME", "SOURCE_SYSTEM", "QUERY_COUNT"], "conversations_monthly": ["TENANT_NAME", "CONVERSATION_MONTH", "CONVERSATION_COUNT"],
    "conversations_total": ["TENANT_NAME", "TOTAL_CONVERSATIONS"], "persona_bridge": ["TRANSCRIPT_ID", "PERSONA"], "persona_dim": ["PERSONA_ID", "PERSONA"], "s_c_csi_map": ["s_c_csi_id"]}


def _accepted_sql(model: str, column: str, values: list[str], severity: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return _summary_sql(model, "accepted_values", column, severity, f"count(DISTINCT {column}) FILTER ({column} NOT IN ({listed}))", model)


SQL["declared_tests"] = compose("SELECT *, CASE WHEN FAILURES = 0 THEN 'pass' WHEN SEVERITY = 'warn' THEN 'warn' ELSE 'fail' END AS STATUS FROM (\n" + "\nUNION ALL\n".join([
    *[_summary_sql(m, "not_null", c, "error", f"COUNT(*) FILTER (WHERE {c} IS NULL)", m) for m, columns in _NOT_NULL.items() for c in columns],
    *[_accepted_sql(m, "SOURCE_SYSTEM", values, "error") for m, values in _SYSTEMS.items()],
    _accepted_sql("people_receiving_care", "metric", ["new_clients", "long_term_clients"], "warn"),
    *[_unique_sql(m, c, m) for m, c in (("conversations_total", "TENANT_NAME"), ("persona_dim", "PERSONA_ID"), ("persona_dim", "PERSONA"), ("s_c_csi_map", "s_c_csi_id"))],
    _summary_sql("conversations_monthly", "unique_combination_of_columns", "TENANT_NAME,CONVERSATION_MONTH", "error", "COUNT(*)",
                 "(SELECT 1 FROM conversations_monthly GROUP BY TENANT_NAME, CONVERSATION_MONTH HAVING COUNT(*) > 1) f"),
    _summary_sql("case_topic_bridge", "relationships", "s_c_csi_id", "warn", "COUNT(*)",
                 "case_topic_bridge b ANTI JOIN s_c_csi_map m USING (s_c_csi_id) WHERE s_c_csi_id IS NOT NULL"),
    _summary_sql("universal_themes_map", "fanout_guard", "t1,t2", "warn", "COUNT(*)",
                 "(SELECT 1 FROM universal_themes_map WHERE org = 'advicepro' GROUP BY lower(trim(t1)), lower(trim(t2)) HAVING COUNT(*) > 1) f"),
    _summary_sql("topic_entry_point_map", "fanout_guard", "topic_entry_point", "warn", "COUNT(*)",
                 "(SELECT 1 FROM topic_entry_point_map GROUP BY lower(trim(topic_entry_point)) HAVING COUNT(*) > 1) f"),
]) + "\n) tests")
SQL["windows_by_month"] = SQL["query_segments_all_las"]


def _long_sql(family: str) -> str:
    dims = FAMILY_DIMS[family]
    dim = f"CAST({dims[1]} AS VARCHAR)" if len(dims) > 1 else "CAST(NULL AS VARCHAR)"
    letters = "HAS_LETTER_RAW" if family == "legal_letters" else "CAST(NULL AS BIGINT)"
    rows = CTES[f"int_{family}"].replace("stg_la_topic_mentions_slice", "stg_la_topic_mentions")
    return f"SELECT '{family}' AS FAMILY, LA_NAME, {dim} AS DIM, QUERY_COUNT_RAW, {letters} AS HAS_LETTER_RAW, TIME_WINDOW_MONTHS FROM (\n{rows}\n) {family}"


SQL["windows_incremental"] = compose("\nUNION ALL\n".join(_long_sql(f) for f in FAMILY_DIMS))
SQL["conversations_monthly_bitmaps"] = SQL["conversations_monthly"]
SQL["conversations_total_bitmaps"] = SQL["conversations_total"]
SQL["incremental_new_keys_filtered"] = SQL["incremental_new_keys"]
SQL["locality_stream"] = compose(f"""
SELECT r."Case Reference" AS CASE_REFERENCE, d.la_name AS LA_NAME, d.county AS COUNTY, d.county_code AS COUNTY_CODE
FROM postcode_report r LEFT JOIN postcode_directory d ON r."Postcode" = d.postcode
WHERE r."Postcode" IS NOT NULL AND trim(r."Postcode", {WS}) <> ''""")
SQL["latest_snapshot_by_folder"] = SQL["latest_snapshot"]
