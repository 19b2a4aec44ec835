"""Places of points on a Hilbert curve in any number of dimensions."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """For rows of cell numbers below ``2**bits``: each row's place on the curve, as big-endian bytes (n x width).

    The transpose form of the curve: per bit from the top, each axis inverts or exchanges the lower bits of the first
    axis; a Gray code over the axes then gives the place, whose bits are dealt to the axes in turn.
    """
    x = cells.astype(np.uint32).T.copy()
    dims, n = x.shape
    q = 1 << (bits - 1)
    while q > 1:
        low = np.uint32(q - 1)
        for i in range(dims):
            on = (x[i] & np.uint32(q)) != 0
            swap = np.where(on, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(n, np.uint32)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & np.uint32(q)) != 0, np.uint32(q - 1), np.uint32(0))
        q >>= 1
    x ^= turn
    planes = (x[None, :, :] >> np.arange(bits - 1, -1, -1, dtype=np.uint32)[:, None, None]) & np.uint32(1)
    return np.packbits(planes.reshape(bits * dims, n).T.astype(np.uint8), axis=1)


def cells(points: np.ndarray, low: np.ndarray, high: np.ndarray, bits: int) -> np.ndarray:
    """Cell numbers of points on a grid of ``2**bits`` cells a side between ``low`` and ``high``; what is outside is in the outermost cells."""
    width = np.where(high > low, high - low, 1.0)
    return np.clip((points - low) / width * (1 << bits), 0, (1 << bits) - 1).astype(np.uint32)
