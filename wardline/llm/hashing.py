"""Hashes of runs, many at once: of the bytes of words, of the words of lines and shingles."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 to the 64."""
    out = []
    for b in (_BASE, _BACK):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run values[start:end], the same wherever the run stands."""
    size = 1 << 16
    while size < len(values) + 1:
        size *= 2
    up, down = _powers(size)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * up[: len(values)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
