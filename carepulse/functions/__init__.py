"""Column-level building blocks (built-in Spark expressions only)."""

from carepulse.functions.columns import (  # noqa: F401
    SUPPRESSED_LABEL,
    SUPPRESSION_THRESHOLD,
    drift_flag,
    normalise_name,
    null_placeholders,
    parse_open_month,
    rtrim_ws,
    standardise_service_type,
    suppress_small,
    taxonomy_key,
    trim_ws,
)
