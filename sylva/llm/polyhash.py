"""Polynomial prefix hashes modulo 2**64 over arrays of symbols."""

from __future__ import annotations

import numpy as np

_BASE = 0x5851F42D4C957F2D
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least ``n`` of each."""
    size = 1 << max(10, (n - 1).bit_length())
    size = max([size, *_POWERS])
    if size not in _POWERS:
        _POWERS.clear()
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[size] = np.cumprod(up), np.cumprod(down)
    return _POWERS[size]


def prefix(symbols: np.ndarray, place: np.ndarray | None = None) -> np.ndarray:
    """Running sums of symbol * base ** place: entry i covers the first i symbols.

    ``place`` counts up within each string of a concatenation; by default the
    symbols are one string.
    """
    up = powers(int(place.max(initial=0)) + 2 if place is not None else len(symbols) + 1)[0]
    out = np.zeros(len(symbols) + 1, np.uint64)
    # symbols count from 1, so that runs of zero differ by their length
    weight = up[: len(symbols)] if place is None else up[place]
    np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * weight, out=out[1:])
    return out


def piece(sums: np.ndarray, start: np.ndarray, end: np.ndarray, place: np.ndarray | None = None) -> np.ndarray:
    """Hashes of symbols[start:end] of one string, whatever the place they stand at (``place``: of each start)."""
    place = start if place is None else place
    down = powers(int(place.max(initial=0)) + 2)[1]
    return (sums[end] - sums[start]) * down[place]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a hash over all its bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))
