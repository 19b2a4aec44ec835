"""End-to-end batch on the smallest data set, with invariants."""

import pytest
from pyspark.sql import functions as F

from carepulse.plans import registry
from carepulse.plans.pipeline import Sources, build_all
from carepulse.sources.fixtures import AS_OF, TARGET_LA, Fixtures


def test_build_all(spark, small_sf, tmpdir_path):
    fx = Fixtures(spark, small_sf)
    built = build_all(spark, Sources.from_fixtures(fx), AS_OF, [TARGET_LA], tmpdir_path + "/out",
                      export_dir=tmpdir_path + "/export")
    assert len([k for k in built if k.startswith("mart_")]) == 36
    res = built["test_results"]
    assert res.filter(F.col("STATUS") == "fail").count() == 0
    # union total = sum of the three staged totals
    a, b, c = registry.staged_sources(fx)
    parts = sum(p.agg(F.sum("QUERY_COUNT")).first()[0] or 0 for p in (a, b, c))
    assert built["stg_la_topic_mentions"].agg(F.sum("QUERY_COUNT")).first()[0] == parts
    # marts from the written intermediate agree with a direct computation
    direct = registry.REGISTRY["mart_query_source_12m"](spark, small_sf)
    assert sorted(map(tuple, built["mart_query_source_12m"].select(*direct.columns).collect())) == \
        sorted(map(tuple, direct.collect()))


def loader_inputs(fx, folder):
    """What the pulls landed: reports as DataFrames, two datasets and a manifest as files."""
    import json
    import os

    from carepulse.plans.pipeline import LoaderInputs
    from carepulse.sources import fixtures as f
    os.makedirs(folder, exist_ok=True)
    fx.people_receiving_care.toPandas().to_csv(folder + "/people_receiving_care.csv", index=False)
    with open(folder + "/beds.csv", "w") as out:
        out.write("la,beds\nNATION_1,7\n")
    datasets = [{"dataset_id": d, "status": s} for d, s in (("people_receiving_care", "SUCCESS"), ("beds", "NO_UPDATE"), ("gone", "SUCCESS"))]
    with open(folder + "/manifest.json", "w") as out:
        json.dump({"run_id": f.RUN_ID, "run_at": f.RUN_AT, "datasets": datasets}, out)
    return LoaderInputs(board=f.board_items(fx), demographics_report=f.demographics_report(fx), postcode_report=f.postcode_report(fx),
                        postcode_directory=f.postcode_directory(fx), external_folder=folder, external_schemas={"people_receiving_care": "metric string"})


def test_loaders_and_monitoring(spark, small_sf, tmpdir_path):
    from carepulse.plans.pipeline import run_loaders, run_monitoring
    from carepulse.sources import fixtures as f
    from carepulse.sources.versioned import read_table
    fx = Fixtures(spark, small_sf)
    inputs = loader_inputs(fx, tmpdir_path + "/land")
    target, out = tmpdir_path + "/locality", tmpdir_path + "/out"
    # a SUCCESS dataset has no file: the load stage reports failure after every loader has run
    with pytest.raises(RuntimeError, match="^1 loader.*external_sources"):
        run_loaders(inputs, out, f.CONTRACTS_GROUP, target)
    assert read_table(spark, out + "/member_orgs").count() > 0
    n_before = spark.read.parquet(target).count()
    assert n_before > 0
    with pytest.raises(RuntimeError):
        run_loaders(inputs, out, f.CONTRACTS_GROUP, target)
    assert spark.read.parquet(target).count() == n_before   # rerun appends nothing
    care = read_table(spark, out + "/external_sources/people_receiving_care")
    assert care.count() == fx.people_receiving_care.count() and care.columns[0] == "metric" and "_RUN_ID" in care.columns
    stale, fresh = run_monitoring(f.table_metadata(fx), f.freshness_config(spark), f.freshness_overrides(fx),
                                  f.NOW, f.STALENESS_DATABASES)
    assert stale.count() > 0 and fresh.filter(F.col("STATUS") == "skipped").count() > 0


def test_what_the_loaders_wrote_feeds_the_build(spark, small_sf, tmpdir_path):
    """From landed files to marts: age bands and localities of casework are those of the loaded tables."""
    from carepulse.operators import windows as w
    from carepulse.plans.pipeline import run_loaders
    from carepulse.sources import fixtures as f
    fx = Fixtures(spark, small_sf)
    target, out = tmpdir_path + "/locality", tmpdir_path + "/out"
    with pytest.raises(RuntimeError):
        run_loaders(loader_inputs(fx, tmpdir_path + "/land"), out, f.CONTRACTS_GROUP, target)
    src = Sources.from_fixtures(fx).with_loaded(out, target)
    built = build_all(spark, src, AS_OF, [TARGET_LA], out)
    loaded = registry.ingest.clean_demographics(f.demographics_report(fx)).select("case_reference", "age_range")
    places = registry.ingest.enrich_postcode(f.postcode_report(fx), fx.casework_locality.limit(0), f.postcode_directory(fx))
    places = places.select(F.col("CASE_REFERENCE").alias("case_reference"), F.col("COUNTY").alias("county"))
    a, c = registry.staged_sources(fx)[0], registry.staged_sources(fx)[2]
    b = registry.staging.stg_advicepro(fx.advicepro_casework, fx.case_topic_bridge, fx.s_c_csi_map, fx.universal_themes_map, loaded, places)
    m = registry.staging.slice_las(registry.staging.stg_la_topic_mentions(a, b, c), [TARGET_LA])
    for family in ("demographics", "locality_overview"):
        want = w.family_windows(m, family, AS_OF)
        assert sorted(map(tuple, built[f"int_{family}"].select(want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    warned = {r.MODEL: r.FAILURES for r in built["test_results"].filter("STATUS = 'warn'").collect()}
    assert warned["people_receiving_care"] > 0


def test_every_row_test_is_seen_failing(spark, small_sf, tmpdir_path):
    """Broken staged parts: the tests on the write find in each part what is wrong there, and count as the scans do."""
    from carepulse.plans.pipeline import build_models, staged_parts
    src = Sources.from_fixtures(Fixtures(spark, small_sf))
    parts = {}
    for i, (name, df) in enumerate(staged_parts(src).items()):
        one = df.limit(40 + i)
        nulls = one.limit(3 + i).withColumns({"LA_NAME": F.lit(None).cast("string"), "QUERY_DATE": F.lit(None).cast("date"), "SOURCE_SYSTEM": F.lit(None).cast("string")})
        odd = one.limit(5).withColumn("SOURCE_SYSTEM", F.when(F.monotonically_increasing_id() % 2 == 0, "Elsewhere").otherwise("AdvicePro" if name != "stg_advicepro" else "Helplines"))
        parts[name] = one.unionByName(nulls).unionByName(odd).checkpoint()
    built, results = build_models(spark, src, tmpdir_path, parts)
    got = {(r.MODEL, r.TEST_NAME, r.COLUMN_NAME): r.FAILURES for r in results.collect()}
    for i, part in enumerate(parts):
        assert got[part, "not_null", "LA_NAME"] == got[part, "not_null", "QUERY_DATE"] == 3 + i
        assert got[part, "accepted_values", "SOURCE_SYSTEM"] == 2
    assert got["stg_la_topic_mentions", "not_null", "SOURCE_SYSTEM"] == 12
    assert got["stg_la_topic_mentions", "accepted_values", "SOURCE_SYSTEM"] == 1
    for model in ("helplines_advicepro_accessava", "mart_la_query_summary"):
        assert got[model, "not_null", "LA_NAME"] > 0 and got[model, "accepted_values", "SOURCE_SYSTEM"] == 1
    assert len(got) == 42 and "_part" not in built["stg_la_topic_mentions"].columns


def test_windows_move_on_with_a_load(spark, small_sf, tmpdir_path):
    """A build at one date and two loads after it give the marts of a build over everything; a repeated run adds nothing."""
    from carepulse.plans import pipeline
    fx = Fixtures(spark, small_sf)
    m = registry.mentions(fx).checkpoint()
    dates = ["2001-06-30", "2001-07-31", AS_OF]
    cut = F.when(F.col("QUERY_DATE") <= "2001-06-30", 0).when(F.xxhash64(*m.columns) % 3 == 0, 1).otherwise(2)
    loads = [m.filter(cut == i) for i in range(3)]
    sliced = registry.staging.slice_las(loads[0], [TARGET_LA])
    days = pipeline.incremental.daily_sums(sliced).checkpoint()
    pipeline._publish_state(days, pipeline.incremental.window_totals(days, dates[0]), dates[0], None, tmpdir_path)
    for i in (1, 2, 2):
        built = pipeline.advance_windows(spark, loads[i], f"load-{i}", dates[i], [TARGET_LA], tmpdir_path)
    everything = registry.staging.slice_las(m, [TARGET_LA])
    for family in registry.windows.FAMILIES:
        want = registry.windows.family_windows(everything, family, AS_OF)
        assert sorted(map(tuple, built[f"int_{family}"].select(want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    want = registry.marts.mart(everything, "query_source", 6, AS_OF)
    assert sorted(map(tuple, built["mart_query_source_6m"].select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_sources_from_landed_paths(spark, small_sf, tmpdir_path):
    from carepulse.operators import windows as w
    from carepulse.sources.schemas import SOURCE_SCHEMAS
    fx = Fixtures(spark, small_sf)
    src = Sources.from_fixtures(fx)
    src.land(tmpdir_path + "/landed")
    landed = Sources.from_paths(spark, tmpdir_path + "/landed")
    for f in Sources.__dataclass_fields__:
        assert getattr(landed, f).schema == SOURCE_SCHEMAS[f]
    direct = registry.REGISTRY["query_source"](spark, small_sf)
    m = registry.staging.slice_las(registry.staging.stg_la_topic_mentions(
        registry.staging.stg_accessava(landed.accessava, landed.accessava_locality, landed.topic_entry_point_map),
        registry.staging.stg_advicepro(landed.advicepro_casework, landed.case_topic_bridge, landed.s_c_csi_map,
                                       landed.universal_themes_map, landed.advicepro_demographics,
                                       landed.casework_locality),
        registry.staging.stg_helplines(landed.helplines_aggregated_full)), [TARGET_LA])
    got = w.family_windows(m, "query_source", AS_OF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, direct.collect()))
