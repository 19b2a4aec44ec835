"""Signals / narrative / findings exports end to end on landed files."""

import json
import os

from carepulse.operators import ingest
from carepulse.plans.exports import export_findings, export_la_signals
from carepulse.sources import fixtures as f


def _read_json_lines(folder):
    out = []
    for fn in sorted(os.listdir(folder)):
        if fn.endswith(".json"):
            out += [json.loads(x) for x in open(os.path.join(folder, fn)) if x.strip()]
    return out


def test_export_la_signals(spark, small_sf, tmpdir_path):
    fx = f.Fixtures(spark, small_sf)
    sig = f.peer_signals(fx)
    docs = ingest.narrative_documents(sig).collect()
    land = os.path.join(tmpdir_path, "signals")
    os.makedirs(land)
    # land every daily snapshot as the upstream job would (driver-side file
    # writes of the small test snapshots only)
    for d in docs:
        day = d.file_name[len("la_peer_signals_"):-len(".csv")]
        with open(os.path.join(land, f"la_signals_narrative_{day}.json"), "w") as fh:
            fh.write(d.json)
    rows = sig.collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.file_name, []).append(r)
    for name, rs in by_file.items():
        with open(os.path.join(land, name), "w") as fh:
            fh.write("unit,signal,value\n" + "".join(f"{r.unit},{r.signal},{r.value}\n" for r in rs))
    last = max(by_file)
    res = export_la_signals(spark, land, "NATION_7", os.path.join(tmpdir_path, "out"))
    nar = _read_json_lines(os.path.join(tmpdir_path, "out", "narrative"))
    assert len(nar) == 1 and nar[0]["LA"] == "NATION_7" and "PROSE" in nar[0]
    assert nar[0]["RUN_DATE"] == last[len("la_peer_signals_"):-len(".csv")]
    full = [json.loads(x) for fn in os.listdir(os.path.join(tmpdir_path, "out", "narrative_full")) if fn.endswith(".txt")
            for x in open(os.path.join(tmpdir_path, "out", "narrative_full", fn))]
    assert [set(x) for x in full] == [{"run_date", "la", "prose", "data"}]
    assert full[0]["data"]["total_signals"] == sum(t["n"] for t in full[0]["data"]["topics"]) == nar[0]["TOTAL_SIGNALS"]
    expected = sum(1 for r in by_file[last] if r.unit == "NATION_7")
    assert nar[0]["TOTAL_SIGNALS"] == expected == res["signals"].count()


def test_export_findings(spark, small_sf, tmpdir_path):
    fx = f.Fixtures(spark, small_sf)
    n = export_findings(f.board_items(fx), f.FINDINGS_GROUP, "board", "b1", f.RUN_AT, tmpdir_path + "/findings")
    got = _read_json_lines(tmpdir_path + "/findings")
    assert len(got) == n > 0 and all(g["N_FINDINGS"] == n for g in got) and "Service" in got[0]
