"""Embedding rows as whole-number vectors, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 256


def usable(vector: Column, limit: float) -> Column:
    """Whether a vector is there and all its components are finite numbers that stay below ``limit`` in size after scaling."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < limit), F.lit(False))), F.lit(False))


def whole(vector: Column) -> Column:
    """floor(256 * x) of each component, as long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of an Arrow list array as an int64 matrix of ``dim`` columns; shorter rows end in zeros."""
    n = len(lists)
    off = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]].astype(np.int64, copy=False)
    size = np.diff(off)
    if n and (size == dim).all():
        return flat.reshape(n, dim)
    out = np.zeros((n, dim), np.int64)
    out[np.repeat(np.arange(n), size), np.arange(len(flat)) - np.repeat(off[:-1] - off[0], size)] = flat
    return out
