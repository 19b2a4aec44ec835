"""Exports: one LA's peer signals and narrative, and the findings board.

Compositions of the file and ingest operators: pick the latest dated
snapshot by listing (only the winning file is read), keep one LA, write
JSON Lines with NULL keys kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from carepulse.operators import ingest
from carepulse.sources import files

NARRATIVE_GLOB = "la_signals_narrative_*.json"
SIGNALS_GLOB = "la_peer_signals_*.csv"


def export_la_signals(spark: SparkSession, signal_dir: str, la: str, out_dir: str,
                      prose: str | None = None) -> dict[str, DataFrame]:
    """Latest narrative (one LA picked out) and latest signals CSV (rows of
    that LA) written under ``out_dir``; returns both frames."""
    nar_path = files.latest_file(spark, signal_dir, NARRATIVE_GLOB)
    sig_path = files.latest_file(spark, signal_dir, SIGNALS_GLOB)
    if nar_path is None or sig_path is None:
        raise FileNotFoundError(f"missing narrative or signals snapshot in {signal_dir}")
    docs = spark.read.text(nar_path, wholetext=True).select(F.col("value").alias("json"))
    narrative = ingest.narrative_for_la(docs, la, prose=prose)
    signals = ingest.filter_unit(spark.read.option("header", True).csv(sig_path), la)
    out = out_dir.rstrip("/")
    # the LA's object in full, as it stands in the document
    ingest.narrative_json(ingest.narrative_data(docs, la, prose=prose)).write.mode("overwrite").text(f"{out}/narrative_full")
    for name, df in (("narrative", narrative), ("signals", signals)):
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{out}/{name}")
    return {"narrative": narrative, "signals": signals}


def export_findings(board: DataFrame, group: str, source: str, board_id: str, pulled_at: str, out_dir: str) -> int:
    """Findings of one group with the envelope fields, as JSON Lines."""
    env = ingest.findings_envelope(board, group, source, board_id, pulled_at)
    seen = Observation("findings")
    env.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("ignoreNullFields", "false").json(out_dir)
    return int(seen.get["n"])
