"""Operators on embeddings against brute force, in whole numbers of Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from carepulse.llm import hard_negatives as hn
from carepulse.llm import hilbert, whitening
from carepulse.llm.queries import op13_embedding_whitening

ROWS = "vec_id long, embedding array<float>, label int"


def f32(values):
    return [None if v is None else float(np.float32(v)) for v in values]


def rows_of(seed, n=700, dim=9, spread=0.4, labels=4):
    """Clustered, tied and repeated vectors, nulls in every column, and ids and vectors that repeat."""
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = [(i, f32(c + rnd.gauss(0, spread) for c in rnd.choice(centres)), rnd.randrange(labels)) for i in range(n)]
    rows += [(n + i, rows[0][1], 1) for i in range(120)]  # a large group of copies
    rows += [(1000 * i, f32([0.0] * dim), i % 2) for i in range(1, 4)] + [(4100, rows[5][1], 2), (4100, rows[5][1], 2), (4100, rows[6][1], 3), (4100, rows[5][1], 2)]
    rows += [(5000, None, 1), (5100, rows[1][1], None), (5200, f32([None] * dim), 1), (5300, [float("nan")] * dim, 1), (5400, [float("inf")] + [0.0] * (dim - 1), 1), (None, rows[2][1], 1),
             (5500, [], 1), (5600, rows[3][1][:4], 0), (5700, [1e30] * dim, 1), (-200, rows[4][1], 3), (5800, f32([9000.0] + [0.5] * (dim - 1)), 2)]
    return rows


def whole(vec):
    return [math.floor(256 * float(v)) for v in vec]


def brute(rows, anchor, k=5, low=80, high=100):
    from itertools import zip_longest
    kept = [(i, whole(v), label) for i, v, label in rows if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    kept = [r for r in kept if all(abs(c) < 2**31 for c in r[1]) and sum(c * c for c in r[1]) < 2**55]
    out = []
    for a, (anchor_id, x, label) in enumerate(kept):
        if not anchor(anchor_id):
            continue
        scored = sorted((-sum(p * q for p, q in zip_longest(x, r[1], fillvalue=0)), r[0], r[2]) for b, r in enumerate(kept) if b != a)
        for s, pid, _ in [r for r in scored if r[2] == label][:k]:
            window = [r for r in scored if r[2] != label and low * -s <= 100 * -r[0] <= high * -s][:k]
            out += [(anchor_id, pid, i + 1, nid, -s, -t) for i, (t, nid, _) in enumerate(window)]
    return sorted(out)


def test_hilbert_curve_visits_neighbours():
    """Along the curve each cell differs from the one before by one step on one axis, and every cell is visited once."""
    for dims, bits in ((1, 3), (2, 1), (2, 4), (3, 2), (4, 2), (5, 1)):
        side = 1 << bits
        points = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = hilbert.hilbert_keys(points, bits)
        order = np.lexsort(keys.T[::-1])
        assert len(np.unique(keys, axis=0)) == len(points)
        assert (np.abs(np.diff(points[order], axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize(("seed", "block", "dim", "spread"), [(1, 1 << 18, 9, 0.4), (2, 16 * 4 * 9, 9, 0.05), (3, 20 * 4 * 3, 3, 0.02)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, seed, block, dim, spread):
    """Also with blocks of a few rows, so that the tree has many pages and prunes."""
    monkeypatch.setattr(hn, "BLOCK_BYTES", block)
    monkeypatch.setattr(hn, "PAGE_BITS", 2 if block < 1 << 18 else 9)
    monkeypatch.setattr(hn, "PARTS_BITS", 1 if block < 1 << 18 else 8)
    rows = rows_of(seed, dim=dim, spread=spread)
    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("clash") for c in ("x", "block", "aid", "rank", "place")})
    got = sorted(map(tuple, hn.hard_negatives(df, F.col("vec_id") % 20 == 0).collect()))
    assert got == brute(rows, lambda i: i % 20 == 0)


def test_blocks_out_of_reach_are_not_read(spark, monkeypatch):
    """Two far clusters: the requests of one never reach the other's blocks."""
    monkeypatch.setattr(hn, "BLOCK_BYTES", 64 * 4 * 4)
    rnd = random.Random(5)
    rows = [(i, f32(c + rnd.gauss(0, 0.01) for c in ([1, 0, 0, 0], [0, 0, 0, 1])[i % 2]), i % 3) for i in range(3000)]
    prepared = hn._prepared(spark.createDataFrame(rows, ROWS), F.col("vec_id") % 50 == 0)
    n, mean, std = hn._spread(prepared)
    blocks, parts = hn._blocks(prepared, n, mean, std)
    asked = hn._requests(blocks.select("block", "ids", "labels", "x", "anchors"), 4, 5, True, None)
    for i, pages in enumerate(hn._tree(blocks, parts, 4)):
        asked = hn._descend(asked, pages, i == 0, 4, True)
    pairs = asked.agg(F.sum("n")).head()[0]
    assert 60 <= pairs < 0.6 * 60 * blocks.count()


def test_windows_and_odd_scores(spark):
    """Positives below zero have no negatives; a positive of zero has those of zero; ties go to the smaller id."""
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-2.0, 0.0], 2), (20, [0.0, 1.0], 5), (21, [1.0, 0.0], 5), (22, [-1.0, 0.0], 6), (3, [0.0, 0.0], 7), (4, [0.0, 0.0], 7)]
    got = sorted(map(tuple, hn.hard_negatives(spark.createDataFrame(rows, ROWS), F.col("vec_id") % 20 == 0).collect()))
    assert got == brute(rows, lambda i: i % 20 == 0)
    assert {r[0] for r in got} == {20}


def test_products_are_exact():
    rnd = np.random.default_rng(3)
    for size in (100, 10**5, 2**26):
        a, b = rnd.integers(-size, size, (7, 5)).astype(np.int32), rnd.integers(-size, size, (9, 5)).astype(np.int32)
        assert hn.products(a, b).tolist() == [[sum(int(p) * int(q) for p, q in zip(r, s, strict=True)) for s in b] for r in a]


def test_empty_and_unusable_tables(spark):
    for rows in ([], [(0, None, 1)], [(0, [1.0], 1)], [(0, [], 1), (100, [], 2), (1, [], 1)]):
        got = sorted(map(tuple, hn.hard_negatives(spark.createDataFrame(rows, ROWS), F.col("vec_id") % 100 == 0).collect()))
        assert got == brute(rows, lambda i: i % 100 == 0)


def brute_whitening(rows):
    """Rows left, and from exact whole numbers: n, deviations and the covariance with its eigenvectors."""
    kept = [(i, whole(v)) for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) and abs(c * 256) < 2**40 for c in v)]
    dim = max(len(v) for _, v in kept)
    kept = [(i, v + [0] * (dim - len(v))) for i, v in kept]
    fit = sorted({tuple(v) for _, v in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = [[n * v - s for v, s in zip(x, sums, strict=True)] for x in fit]
    cov = np.array([[sum(r[i] * r[j] for r in centred) / n**3 for j in range(dim)] for i in range(dim)])
    values, axes = np.linalg.eigh(cov)
    away = {(i, tuple(v)): np.array([(n * c - s) / n for c, s in zip(v, sums, strict=True)]) for i, v in kept}
    deviation = sorted(((str(i), sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True))) for i, v in kept))
    return n, deviation, values[::-1], axes[:, ::-1], away, np.trace(cov), kept


def check_whitening(rows, got):
    n, deviation, values, axes, away, trace, kept = brute_whitening(rows)
    count = min(4, axes.shape[0])
    assert len(got) == count * len(kept) and {r.n for r in got} == {n}
    for k in range(count):
        mine = [r for r in got if r.component == k + 1]
        assert sorted((str(r.vec_id), r.deviation) for r in mine) == [(i, d if d < 2**63 else None) for i, d in deviation]
        assert all(abs(r.explained * trace - values[k]) <= 1e-9 * values[0] for r in mine)
        want = {}
        for (i, _), a in away.items():
            want.setdefault(str(i), []).append(abs(float(a @ axes[:, k])) / math.sqrt(values[k]))
        have = {}
        for r in mine:
            have.setdefault(str(r.vec_id), set()).add(round(abs(r.whitened), 6))
        for i, each in want.items():
            assert have[i] <= {round(v + e, 6) for v in each for e in (-1e-6, 0, 1e-6)}
    assert len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error <= 1e-4


def test_whitening_equals_brute_force(spark):
    rows = [r for r in rows_of(4, dim=7) if r[0] not in (5700, 5800)]
    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("clash") for c in ("x", "n", "component", "whitened")})
    check_whitening(rows, whitening.whiten(df).collect())


def test_whitening_far_from_zero(spark):
    """Entries about 2**22 with a spread of one: products of 2**60 whose differences count; outliers widen the planes."""
    rnd = random.Random(8)
    rows = [(i, f32(16384 + rnd.randrange(-200, 200) / 256 for _ in range(4)), 1) for i in range(300)]
    check_whitening(rows, whitening.whiten(spark.createDataFrame(rows, ROWS)).collect())
    rows += [(900, f32([2.0**31, -5.0, 3.0, 1.0]), 1)]
    out = whitening.whiten(spark.createDataFrame(rows, ROWS)).collect()
    n, deviation, values, *_ = brute_whitening(rows)
    assert sorted((str(r.vec_id), r.deviation) for r in out if r.component == 1) == [(i, d if d < 2**63 else None) for i, d in deviation]
    assert any(r.deviation is None for r in out) and {r.n for r in out} == {n}


def test_whitening_without_variance(spark):
    for rows in ([(1, [1.0, 2.0], 1)], [(1, [1.0, 2.0], 1)] * 3, [(1, [], 1), (None, [0.0], 2)]):
        out = whitening.whiten(spark.createDataFrame(rows, ROWS)).collect()
        assert len(out) == len(rows) * max(1, len(rows[0][1])) and all(r.whitened is None and r.n == 1 and r.deviation == 0 and r.explained == 0 and r.identity_error == 0 for r in out)
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 1.0], 1) for i in range(4)], ROWS)).collect()
    assert [r.whitened is None for r in sorted(line, key=lambda r: r.component)] == [False] * 4 + [True] * 4
    for rows in ([], [(1, None, 1), (2, [None], 1), (3, [float("inf")], 1)]):
        assert whitening.whiten(spark.createDataFrame(rows, ROWS)).collect() == []


def test_plane_counts_are_products():
    rnd = np.random.default_rng(2)
    for top in (1, 2, 300, 2**33):
        x = rnd.integers(0, top, (133, 5))
        x[:, 3] = 0
        bits = [int(x[:, d].max()).bit_length() for d in range(5)]
        sums = whitening.weighted(whitening.and_counts(whitening.planes(x, bits)), bits)
        assert sums == [[sum(int(p) * int(q) for p, q in zip(x[:, i], x[:, j], strict=True)) for j in range(i, 5)] for i in range(5)]


def test_whitening_of_the_whole_table(spark, small_sf):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{small_sf}/embeddings.parquet").collect()]
    got = op13_embedding_whitening(spark, small_sf).collect()
    assert len(got) == 4 * len(rows)
    check_whitening(rows[:], got)
