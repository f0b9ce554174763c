"""Hashes of all words of a byte buffer at once, in numpy."""

from __future__ import annotations

import numpy as np

_STEP = 0x100000001B3
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse modulo 2^64, at least ``n`` of each."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        both = []
        for base in (_STEP, pow(_STEP, -1, 1 << 64)):
            x = np.full(max(n, 1 << 18), base, np.uint64)
            x[0] = 1
            both.append(np.cumprod(x))
        _POWERS[:] = [tuple(both)]
    return _POWERS[0]


def hashed_words(data: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each run of ``data`` outside ``gap``.

    A word's hash is the sum of byte * step^position modulo 2^64: a prefix sum
    over the buffer, divided down to the word's start.
    """
    up, down = _powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * up[:len(data)], out=prefix[1:])
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[-1] = len(data) > 0 and not gap[0], len(data) > 0 and not gap[-1]
    np.not_equal(gap[1:], gap[:-1], out=edge[1:-1])
    turns = np.flatnonzero(edge)
    starts, ends = turns[::2], turns[1::2]
    return (prefix[ends] - prefix[starts]) * down[starts], starts


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of uint64 values (the splitmix64 finaliser's fixed constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
