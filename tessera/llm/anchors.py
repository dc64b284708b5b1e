"""Content-chosen anchors of byte strings.

The anchor of a ``LENGTH``-byte window is the ``GRAM``-byte gram with the smallest
hash inside it, the first one if there are ties.  It depends on the window's bytes
alone, so equal windows have equal anchors at the same place."""

from __future__ import annotations

import numpy as np

from tessera.llm.common import mix64

LENGTH, GRAM = 100, 24
#: grams in a window, and windows of an anchor at most
WINDOWS = LENGTH - GRAM + 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(10).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        p = np.full(n + (n >> 1), base, np.uint64)
        p[0] = 1
        _powers[base] = np.multiply.accumulate(p)
    return _powers[base][:n]


class Prints:
    """Hashes of any substring of ``raw``: mix((S[end] - S[start]) / base ** start)."""

    def __init__(self, raw: np.ndarray):
        value = _BYTE[raw]
        value *= _power(_BASE, len(raw))
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(value, out=self.sums[1:])
        self.back = _power(_INVERSE, len(raw) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.back[start])

    def all(self, size: int) -> np.ndarray:
        """Of every substring of ``size`` bytes."""
        n = max(len(self.sums) - size, 0)
        return mix64((self.sums[size:] - self.sums[:n]) * self.back[:n]) if n else np.zeros(0, np.uint64)


def _window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for every i, by doubling."""
    span, low = 1, x
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def anchors(raw: np.ndarray, off: np.ndarray, prints: Prints | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, first window, windows, gram hash) of the anchors of the texts
    ``raw[off[i] : off[i + 1]]``, windows by their start in ``raw``.  Each window
    belongs to one anchor, so an anchor's windows are a run of starts, WINDOWS at
    most, and no two windows of a run are equal.  Texts under LENGTH bytes have
    none."""
    empty = np.zeros(0, np.int64)
    if len(raw) < LENGTH:
        return empty, empty, empty, empty.view(np.uint64)
    grams = (prints or Prints(raw)).all(GRAM)
    low = _window_minima(grams, WINDOWS)
    inside = np.ones(len(low) + 1, bool)  # windows that lie in one text
    for end in off[1:-1].tolist():
        inside[max(end - LENGTH + 1, 0) : end] = False
    inside[-1] = False
    # a run ends where the minimum changes, and after the window that begins with it
    cut = np.ones(len(low), bool)
    cut[1:] = (low[1:] != low[:-1]) | (grams[: len(low) - 1] == low[:-1]) | ~inside[: len(low) - 1]
    first = np.flatnonzero(cut & inside[:-1])
    stops = np.flatnonzero(np.r_[cut, True] | ~inside)
    count = stops[np.searchsorted(stops, first, side="right")] - first
    return np.searchsorted(off, first, side="right") - 1, first, count, low[first]
