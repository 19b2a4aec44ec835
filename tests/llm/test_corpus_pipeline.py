"""The pipeline's stages, each on the whole of what the one before kept."""

import __spark_entry__ as entry
import corpus_pipeline
from carepulse.llm.queries import QUERIES


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_stages_on_messy_rows(spark, messy, docs, small_sf):
    """Every stage keeps the columns of documents and takes any rows; what stays is what its operator says."""
    plain = docs.select(corpus_pipeline.COLUMNS)
    for frame in (plain, plain.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, small_sf)
            assert out.schema.names == corpus_pipeline.COLUMNS, name
            assert [f.dataType for f in out.schema] == [f.dataType for f in frame.schema], name
            assert out.count() <= frame.count()
        assert corpus_pipeline.STAGES[-1][1](spark, frame, small_sf).count() == frame.count()


def test_near_duplicates_keep_one_of_each_group(spark, docs, messy, small_sf):
    """As many rows as brute-force groups: a repeated id, or none, names no group."""
    from test_dedup import brute_fingerprint, brute_groups
    plain = docs.select(corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.near_duplicates(spark, plain, small_sf).collect()
    groups = brute_groups({brute_fingerprint(r[1]) for r in messy})
    assert len(kept) == len(set(groups.values()))
    assert len({groups[brute_fingerprint(r.text)] for r in kept}) == len(kept)


def test_near_duplicates_of_repeated_and_missing_ids(spark, small_sf):
    """Groups that have the same smallest doc_id, or none, keep a row each: counted by brute-force components."""
    import random

    from test_dedup import brute_fingerprint, brute_groups
    rnd = random.Random(11)
    texts = [" ".join(f"w{rnd.randrange(10_000)}" for _ in range(60)) for _ in range(8)]
    rows = [(None, t, "en", "s", 1) for t in texts[:4]] + [(5, t, "en", "s", 1) for t in texts[4:7]] + [(6, texts[7], "en", "s", 1)]
    rows += [(None, texts[0], "de", "s", 1), (7, texts[7], "en", "s", 1), (8, texts[1], "en", "s", 1)]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), small_sf).collect()
    groups = brute_groups({brute_fingerprint(r[1]) for r in rows})
    assert len(kept) == len(set(groups.values()))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in kept) == sorted(
        [(True, 0, t) for t in (texts[0], texts[2], texts[3])] + [(False, 8, texts[1])] + [(False, 5, t) for t in texts[4:7]] + [(False, 6, texts[7])])


def test_run(spark, small_sf):
    rows = corpus_pipeline.run(spark, small_sf).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect()}
    assert 0 < len(rows) < len(docs) and {r.doc_id for r in rows} <= set(docs)
    assert all(len(r.ids) == r.n_tokens for r in rows)
