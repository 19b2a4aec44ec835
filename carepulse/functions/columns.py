"""Column expressions shared by the operators.

All of these return ``Column`` objects built from ``pyspark.sql.functions``;
they stay inside whole-stage codegen and never call back into Python.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# --- fixed values (must equal the reference's for identical results) -------
# Small-number suppression: counts below 5 are shown as the label '1-5'.
SUPPRESSION_THRESHOLD = 5
SUPPRESSED_LABEL = "1-5"
# Provenance warning codes that count as drift, joined with '+'.
DRIFT_CODES = ("SCHEMA_DRIFT", "SEMANTIC_DRIFT_SUSPECTED")
DRIFT_SEPARATOR = "+"
# Placeholder strings that mean "no value" in casework report exports.
NULL_PLACEHOLDERS = ("", "[Not Specified]")
# Service-type standardisation: ordered (pattern, label) rules, first match wins.
SERVICE_TYPE_RULES = (
    (r"Casework Membership 1 day per week", "Casework & Advice"),
    (r"Advice & Casework \(bespoke\)", "Casework & Advice"),
    (r"Advice & Casework Membership 4days pm", "Casework & Advice"),
    (r"Advice & Casework 2days pm", "Casework & Advice"),
    (r"Advice & Casework 1day pm", "Casework & Advice"),
    (r"Advice Membership", "Advice Membership"),
)
# Whitespace removed by R's trimws(): space, tab, CR, LF.
R_WHITESPACE = " \t\r\n"
# ---------------------------------------------------------------------------


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def suppress_small(n: str | Column) -> Column:
    """Small-number suppression: ``n < 5`` -> '1-5', else the integer as text.

    NULL stays NULL; zero and negatives are suppressed too.  The value is cast
    to BIGINT before text so a DOUBLE count prints ``123`` not ``123.0``.
    """
    n = _col(n)
    return (F.when(n < SUPPRESSION_THRESHOLD, F.lit(SUPPRESSED_LABEL))
            .otherwise(n.cast("bigint").cast("string")))


def parse_open_month(m: str | Column, strict: bool = True) -> Column:
    """'YYYY/MM' text -> DATE of the first day of that month.

    ``strict`` raises on malformed text (ANSI ``to_date``); lenient mode
    returns NULL instead so the caller can route the row to a reject table.
    """
    text = F.concat(F.regexp_replace(_col(m), "/", "-"), F.lit("-01"))
    if strict:
        return F.to_date(text, "yyyy-MM-dd")
    return F.try_to_date(text, "yyyy-MM-dd")


def taxonomy_key(a: str | Column, b: str | Column, c: str | Column) -> Column:
    """Deterministic MD5 id of three fields joined by '|' (NULL in -> NULL out)."""
    return F.md5(F.concat(_col(a), F.lit("|"), _col(b), F.lit("|"), _col(c)))


def trim_ws(c: str | Column) -> Column:
    """Trim like R's trimws(): space, tab, CR and LF on both sides."""
    return F.btrim(_col(c), F.lit(R_WHITESPACE))


def rtrim_ws(c: str | Column) -> Column:
    return F.rtrim(_col(c), F.lit(R_WHITESPACE))


def normalise_name(name: str) -> str:
    """Header normalisation used by the report loaders: ' ' -> '_', lower-case."""
    return name.replace(" ", "_").lower()


def null_placeholders(df: DataFrame, placeholders: Sequence[str] = NULL_PLACEHOLDERS) -> DataFrame:
    """Turn placeholder strings into NULL on every string column."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, StringType):
            c = F.when(c.isin(*placeholders), F.lit(None).cast("string")).otherwise(c)
        exprs.append(c.alias(f.name))
    return df.select(*exprs)


def standardise_service_type(c: str | Column,
                             rules: Iterable[tuple[str, str]] = SERVICE_TYPE_RULES) -> Column:
    """Ordered regex rules to labels; unmatched values pass through unchanged."""
    c = _col(c)
    out = None
    for pattern, label in rules:
        cond = c.rlike(pattern)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return c if out is None else out.otherwise(c)


def drift_flag(warnings: str | Column, codes: Sequence[str] = DRIFT_CODES) -> Column:
    """Drift flag from an array of ``{code, message, details}`` structs.

    Keeps the drift codes, de-duplicates in first-seen order and joins them
    with '+'; NULL when none (or when the array is NULL/empty).  A missing
    code counts as ''.
    """
    w = _col(warnings)
    code_list = F.transform(w, lambda x: F.coalesce(x["code"], F.lit("")))
    kept = F.array_distinct(F.filter(code_list, lambda x: x.isin(*codes)))
    return F.nullif(F.array_join(kept, DRIFT_SEPARATOR), F.lit(""))


def regex_literal(text: str) -> str:
    """Quote a literal for use as a Java regex (``split`` takes a regex)."""
    return "\\Q" + text + "\\E"
