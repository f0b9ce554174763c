"""Majority-bit fingerprints of many token lists at once, in numpy."""

from __future__ import annotations

import numpy as np

# Byte value -> eight 8-bit lanes, lane j holding bit j; 255 of these add up
# without overflow.
LANES = np.array([sum(((v >> j) & 1) << (8 * j) for j in range(8)) for v in range(256)], np.uint64)
_RUN = 255


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One uint64 per list: bit b is 1 if set in over half of the list's hashes.

    ``hashes`` (uint64) holds the lists one after the other, ``counts`` their
    lengths. An empty list gives zero.
    """
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    n = counts[full].astype(np.int64)
    begin = np.cumsum(n) - n
    runs = -(-n // _RUN)
    first = np.cumsum(runs) - runs
    step = np.arange(runs.sum()) - np.repeat(first, runs)
    starts = np.repeat(begin, runs) + step * _RUN
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for k in range(8):
        lanes = np.add.reduceat(LANES[octets[:, k]], starts)
        ones = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), first)
        bits = ones * 2 > n[:, None]
        for j in range(8):
            out[full] |= bits[:, j].astype(np.uint64) << np.uint64(8 * k + j)
    return out
