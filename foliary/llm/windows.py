"""Hashes of all k-grams of a sequence and minima of sliding windows, in numpy."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
#: Positions that fit beside a hash in one word.
POSITION_BITS = 20


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of k codes (k a power of two): polynomials joined by doubling, then mixed."""
    h = codes.astype(np.uint64) + np.uint64(1)
    power, width = int(BASE), 1
    while width < k:
        h = h[:-width] * np.uint64(power) + h[width:]
        power = power * power % (1 << 64)
        width *= 2
    h ^= h >> np.uint64(32)
    h *= MIX
    h ^= h >> np.uint64(29)
    return h


def rightmost_minima(h: np.ndarray, w: int) -> np.ndarray:
    """For each window of w hashes the position of its least, of equals the rightmost; of fewer hashes one window.

    Hashes are compared by their upper 44 bits, positions ride in the lower 20;
    longer sequences carry positions in an array beside.
    """
    n = len(h)
    w = min(w, n)
    if n <= 1 << POSITION_BITS:
        low = np.uint64((1 << POSITION_BITS) - 1)
        best = (h & ~low) | (low - np.arange(n, dtype=np.uint64))
        width = 1
        while width * 2 <= w:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        if width < w:
            best = np.minimum(best[: n - w + 1], best[w - width :])
        return (low - (best & low)).astype(np.int64)
    value, at, width = h >> np.uint64(POSITION_BITS), np.arange(n), 1
    while width < w:
        step = min(width, w - width)
        take = value[step:] <= value[:-step]
        at = np.where(take, at[step:], at[:-step])
        value = np.where(take, value[step:], value[:-step])
        width += step
    return at
