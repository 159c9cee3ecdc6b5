"""Positions of points on a Hilbert curve of any number of dimensions."""

from __future__ import annotations

import numpy as np


def curve_keys(points: np.ndarray, bits: int) -> list[bytes]:
    """Keys, in the order of the curve when compared as bytes, of points (rows) whose
    coordinates are whole numbers of ``bits`` bits.

    A step along the curve changes one coordinate by one, so points near on the curve are
    near in space. The coordinates are turned and mirrored from the highest bit down, as
    the curve is inside each half, then Gray-coded; their bits in turn are the key.
    """
    x = points.T.astype(np.int64).copy()
    if not len(x):
        return [b""] * points.shape[0]
    for bit in range(bits - 1, 0, -1):
        high, low = 1 << bit, (1 << bit) - 1
        for i in range(len(x)):
            mirrored = (x[i] & high) != 0
            swapped = np.where(mirrored, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(mirrored, low, swapped)
            x[i] ^= swapped
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], dtype=np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> bit) & 1, (1 << bit) - 1, 0)
    x ^= turn
    planes = [(x >> bit) & 1 for bit in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]
