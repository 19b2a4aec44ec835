"""Embedding whitening: exact covariance from bit planes, then the leading components of every row.

Entries are whole numbers (``vectors.whole``).  The fit list is each distinct vector once.

* Scatter: a dimension's values less their minimum are bit planes; the planes of up to ``CHUNK`` rows are packed into
  64-bit words, and the number of rows in which bit a of dimension i and bit b of dimension j are both set is the popcount
  of two planes' AND.  Weighted by 2**(a + b) these counts are the exact sums of products of shifted values, whatever the
  order of rows; each task gives one number for each pair of dimensions, which are summed as decimals.
* Centring: with n rows, sums S and products P the covariance is (n * P - S * S') / n**2; numerator and shift are whole
  numbers of any size on the driver (dimension squared, not data), and are divided once, so nothing cancels before ``eigh``.
* Projection: n * x - S is exact, too, and divided by n before it meets the components.

Every partial result is bounded by the dimension: the driver gets a row for each dimension and pair of dimensions, and
tasks hold one chunk.  Distinct vectors combine in the map tasks before they are shuffled, so a vector that a third of all
rows repeat is one row a task.  The fit list is a table in the shared checkpoint folder.

Rows with a null vector or null or non-finite entries are dropped, and those with an entry of 2**40 or more in size (after
scaling), for which the sums may not fit a decimal.  Shorter vectors end in zeros.  Rows that repeat a vec_id stay rows of
their own; a null vec_id is passed on.  A component whose variance is nothing but rounding (below ``TINY`` of the
greatest) can't be whitened: ``whitened`` is null and it is no part of ``identity_error``.  ``deviation`` is null where it does not fit a long.  An empty table
gives an empty result.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.llm import common as C
from carepulse.llm import vectors

#: Rows whose planes are packed together.
CHUNK = 1 << 13
COMPONENTS = 4
LIMIT = 2.0**40
TINY = 1e-12
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _parts(batches, rows: int):
    """Arrow arrays of at most ``rows`` rows."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def _moments(fit: DataFrame) -> tuple[int, list[int], list[int], list[int]]:
    """Rows of the fit list, and the sum, minimum and maximum of each dimension."""
    def run(batches):
        for b in _parts(batches, CHUNK):
            x = b.column(0)
            dim = max(1, int(np.diff(x.offsets.to_numpy()).max(initial=0)))
            m = vectors.matrix(x, dim)  # 2**13 rows below 2**40 sum to less than 2**63
            # a dimension that only some vectors have is zero in the others: rows tells whether a batch had it at all
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(np.full(dim, len(x))), pa.array(m.sum(0)), pa.array(m.min(0)), pa.array(m.max(0))], names=["dim", "n", "s", "lo", "hi"])

    wide = F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    got = {r["dim"]: r for r in C.map_arrow(fit, run, "dim long, n long, s long, lo long, hi long").groupBy("dim").agg(F.sum("n").alias("n"), wide, F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()}
    if not got:
        return 0, [], [], []
    n = got[0]["n"]
    zero = [got[d]["n"] < n for d in range(len(got))]
    return n, [int(got[d]["s"]) for d in range(len(got))], [min(got[d]["lo"], 0) if zero[d] else got[d]["lo"] for d in range(len(got))], [max(got[d]["hi"], 0) if zero[d] else got[d]["hi"] for d in range(len(got))]


def planes(shifted: np.ndarray, bits: list[int]) -> np.ndarray:
    """Bit planes of each column, one after the other, packed along the rows into 64-bit words."""
    n = len(shifted)
    out = np.zeros((sum(bits), -(-n // 64) * 8), np.uint8)
    at = 0
    for d, k in enumerate(bits):
        column = shifted[:, d]
        for b in range(k):
            packed = np.packbits((column >> b & 1).astype(np.uint8))
            out[at, :len(packed)] = packed
            at += 1
    return out.view(np.uint64)


def and_counts(words: np.ndarray) -> np.ndarray:
    """Popcounts of the AND of each plane with itself and the ones after it (upper triangle)."""
    out = np.zeros((len(words), len(words)), np.int64)
    for i in range(len(words)):
        out[i, i:] = np.bitwise_count(words[i:] & words[i]).sum(1, dtype=np.int64)
    return out


def weighted(counts: np.ndarray, bits: list[int]) -> list[list[int]]:
    """Sums of products of shifted values, from the counts of their planes: for each dimension, those from it on."""
    both = counts + np.triu(counts, 1).T
    ends = np.concatenate([[0], np.cumsum(bits)]).astype(int)
    owner = np.repeat(np.arange(len(bits)), bits)
    power = np.array([1 << int(p - ends[d]) for p, d in enumerate(owner)], object)
    small = 2 * max(bits, default=0) + int(both.max(initial=1)).bit_length() + 2 < 62
    both, power = (both, power.astype(np.int64)) if small else (both.astype(object), power)
    rows = []
    for i in range(len(bits)):
        line = (power[ends[i]:ends[i + 1], None] * both[ends[i]:ends[i + 1]]).sum(0) * power if bits[i] else np.zeros(len(power), both.dtype)
        rows.append([int(line[ends[j]:ends[j + 1]].sum()) for j in range(i, len(bits))])
    return rows


def scatter(fit: DataFrame, low: list[int], high: list[int]) -> list[list[int]]:
    """Exact sums of products of ``x - low`` over the fit list, for each dimension with those from it on."""
    dim, bits = len(low), [int(h - b).bit_length() for b, h in zip(low, high, strict=True)]
    shift = np.array(low, np.int64)

    def run(batches):
        total = np.zeros((sum(bits), sum(bits)), np.int64)
        for b in _parts(batches, CHUNK):
            total += and_counts(planes(vectors.matrix(b.column(0), dim) - shift, bits))
        sums = weighted(total, bits)
        pairs = [(i, i + j, v) for i, line in enumerate(sums) for j, v in enumerate(line) if v]
        for at in range(0, len(pairs), 1 << 16):
            i, j, v = zip(*pairs[at:at + (1 << 16)], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array([Decimal(x) for x in v], pa.decimal128(38, 0))], names=["i", "j", "v"])

    out = [[0] * (dim - i) for i in range(dim)]
    got = C.map_arrow(fit, run, "i long, j long, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    for i, j, v in zip(*(c.to_pylist() for c in got.columns), strict=True):
        out[i][j - i] = int(v)
    return out


def covariance(n: int, sums: list[int], low: list[int], products: list[list[int]]) -> np.ndarray:
    """Covariance with divisor n: whole numbers are centred first, and divided once."""
    dim = len(sums)
    at_zero = [s - n * b for s, b in zip(sums, low, strict=True)]
    out = np.zeros((dim, dim))
    for i in range(dim):
        for j, p in enumerate(products[i], i):
            out[i, j] = out[j, i] = (n * p - at_zero[i] * at_zero[j]) / (n * n)
    return out


def fit_components(n: int, sums: list[int], low: list[int], products: list[list[int]], count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leading eigenvalues, unit eigenvectors (columns) and shares of the trace, by falling eigenvalue."""
    cov = covariance(n, sums, low, products)
    values, axes = np.linalg.eigh(cov)
    values, axes = np.maximum(values[::-1][:count], 0.0), axes[:, ::-1][:, :count]
    trace = np.trace(cov)
    return values, axes, values / trace if trace > 0 else np.zeros_like(values)


def project(x: np.ndarray, n: int, sums: list[int], values: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
    """Whitened components of each row (null-like NaN where there is no variance), and the exact squared distance from the mean times n."""
    most = n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in sums), default=0)
    if most < 2**62:
        centred = n * x - np.array(sums, np.int64)
        exact = centred if len(sums) * most * most < 2**62 else centred.astype(object)
    else:
        exact = n * x.astype(object) - np.array(sums, object)
        centred = exact
    deviation = [int(v) for v in (exact * exact).sum(1)] if len(x) else []
    real = values > TINY * max(values.max(initial=0.0), 1e-300)
    scale = np.where(real, 1 / np.sqrt(np.where(real, values, 1.0)), np.nan)
    away = (centred / n).astype(np.float64)
    return away @ axes * scale, [v if v < 2**63 else None for v in deviation]


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Each row's leading components, whitened: columns as in ``RESULT``, a row for each row of ``rows`` and component.

    ``rows`` has vec_id and embedding; a vector of d dimensions has min(d, components) components."""
    vec = F.col("embedding")
    kept = rows.where(vectors.usable(vec, LIMIT)).select(F.col("vec_id").cast("long").alias("vec_id"), vectors.whole(vec).alias("x"))
    # a vector and the same with zeros at its end are one
    last = F.coalesce(F.array_max(F.transform("x", lambda v, i: F.when(v != 0, i + 1).otherwise(0))), F.lit(0))
    fit = C.checkpoint_table(kept.select(F.slice("x", F.lit(1), last).alias("x")).distinct(), "fit-list")
    n, sums, low, high = _moments(fit)
    if not n:
        return rows.sparkSession.createDataFrame([], RESULT)
    dim = len(sums)
    values, axes, shares = fit_components(n, sums, low, scatter(fit, low, high), components)
    real = [k for k in range(len(values)) if values[k] > TINY * max(values.max(), 1e-300)]
    names = [f"c{k}" for k in real]

    def whitened(batches):
        for b in _parts(batches, CHUNK):
            w, _ = project(vectors.matrix(b.column(0), dim), n, sums, values, axes)
            yield pa.RecordBatch.from_arrays([pa.array(w[:, k]) for k in real], names=names)

    error = 0.0
    if real:
        fitted = C.map_arrow(fit, whitened, ", ".join(f"{c} double" for c in names))
        pairs = [(i, j) for i in range(len(real)) for j in range(i, len(real))]
        found = fitted.agg(*[F.covar_pop(names[i], names[j]).alias(f"v{p}") for p, (i, j) in enumerate(pairs)]).head()
        error = max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs, strict=True))
    schema = C.to_arrow(C.result_schema(rows, [], RESULT))
    count = len(values)

    def run(batches):
        for b in _parts(batches, CHUNK):
            m = b.num_rows
            w, deviation = project(vectors.matrix(b.column(1), dim), n, sums, values, axes)
            flat = w.reshape(-1)
            ids = b.column(0).take(pa.array(np.repeat(np.arange(m), count)))
            far = pa.array([v for v in deviation for _ in range(count)], pa.int64())
            columns = [ids, np.tile(np.arange(1, count + 1), m), np.full(m * count, n), far, pa.array(flat, mask=np.isnan(flat)), np.tile(shares, m), np.full(m * count, error)]
            yield pa.RecordBatch.from_arrays([(c if isinstance(c, pa.Array) else pa.array(c)).cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return C.map_arrow(kept, run, RESULT)
