"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {...}, "sf"}.
Each query is fully executed (all rows produced and discarded by the JVM
via a ``noop`` write), after one untimed warm-up pass of the whole set on
the smallest data folder so JIT compilation is not billed to the first
query.  Queries of one session share the fixture view declarations
(``Fixtures.of``): plans, not data — every timed query executes its whole
plan from the parquet files.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from carepulse.plans.registry import REGISTRY  # noqa: E402
from carepulse.session import local_session  # noqa: E402

HEADLINE = [
    "stg_la_topic_mentions",
    "monthly_theme_counts",
    "mart_la_query_summary",
    "activity_summary", "demographics", "legal_letters", "locality_overview",
    "queries_over_time", "query_segments", "query_source", "trailing_windows_shared",
    "mart_query_source_1m", "mart_demographics_12m",
    "conversations_monthly", "conversations_total", "persona_dim", "bridge_diff",
    "test_not_null", "warn_unmapped_share", "recon_totals",
    "casework_feature_counts", "combined_interactions", "monthly_series_filled", "top_k_categories",
    "clean_demographics", "enrich_postcode", "manifest_load_plan", "tag_provenance",
    "narrative_for_la", "table_staleness", "source_freshness",
]


def run(spark, name: str, sf: str) -> float:
    t0 = time.perf_counter()
    REGISTRY[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in HEADLINE if n in REGISTRY]
    if len(sys.argv) > 1:
        names = [n for n in names if any(p in n for p in sys.argv[1:])]
    spark = local_session(cpus)
    warm = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        for n in names:
            run(spark, n, warm)
    times = {n: round(run(spark, n, sf), 3) for n in names}
    m = re.search(r"sf([0-9.]+)", sf)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf}))


if __name__ == "__main__":
    main()
