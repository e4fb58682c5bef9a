"""Hashes of many runs inside one long sequence, without a loop over the runs."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_tables = (np.ones(0, np.uint64), np.ones(0, np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64; the longest tables made so far serve all."""
    global _tables
    if len(_tables[0]) < n:
        size = max(1 << 20, 1 << int(n - 1).bit_length())
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _tables = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _tables


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers with their bits spread."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def run_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for every run; the place of a run does not matter."""
    up, down = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * down[start])
