"""Word shingles of whole texts as 64-bit hashes, vectorised over many texts.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased.  A text's set
is its distinct ``WORDS``-word shingles; with fewer words the whole sequence is
the one shingle; without words the set is empty."""

from __future__ import annotations

import numpy as np

from tessera.llm.common import SPACE_CHARS, mix64

WORDS = 5
_BLOCK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in SPACE_CHARS]] = True
_rng = np.random.default_rng(1)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _rng.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    if base not in _powers or len(_powers[base]) < n:
        p = np.full(max(n, _BLOCK + 1), base, np.uint64)
        p[0] = 1
        _powers[base] = np.multiply.accumulate(p)
    return _powers[base][:n]


def _word_hashes(raw: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Hashes of the words of one block; ``fresh``: where a text begins."""
    space = _SPACE[raw]
    before = np.r_[True, space[:-1]] | fresh
    start = np.flatnonzero(before & ~space)
    after = np.r_[space[1:] | fresh[1:], True]
    end = np.flatnonzero(after & ~space) + 1
    value = _BYTE[raw] * _power(_BASE, len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(value, out=sums[1:])
    return mix64((sums[end] - sums[start]) * _power(_INVERSE, len(raw) + 1)[start])


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, words before each text and in all).  Long input is
    taken in blocks that end between words."""
    fresh = np.zeros(len(raw) + 1, bool)
    fresh[off[:-1]] = True
    hashes, lo = [], 0
    while lo < len(raw):
        hi = min(lo + _BLOCK, len(raw))
        while hi < len(raw):
            cut = np.flatnonzero(_SPACE[raw[lo + 1 : hi]] | fresh[lo + 1 : hi])
            if len(cut):
                hi = lo + 1 + int(cut[-1])
                break
            hi = min(hi + _BLOCK, len(raw))  # one word longer than the block
        hashes.append(_word_hashes(raw[lo:hi], fresh[lo:hi]))
        lo = hi
    space = _SPACE[raw]
    begins = (np.r_[True, space][: len(raw)] | fresh[:-1]) & ~space
    count = np.r_[0, np.cumsum(begins)]
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), count[off]


def shingle_sets(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the sets one after another, each sorted; offsets)."""
    w, at = words(raw, off)
    n = len(w)
    h = np.zeros(max(n - WORDS + 1, 0), np.uint64)
    for k in range(WORDS):
        h += w[k : k + len(h)] * _PLACE[k]
    h = mix64(h)
    sets = []
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
        if hi - lo >= WORDS:
            s = np.sort(h[lo : hi - WORDS + 1])
            sets.append(s[np.r_[True, s[1:] != s[:-1]]])
        elif hi > lo:
            sets.append(mix64((w[lo:hi] * _PLACE[: hi - lo]).sum(dtype=np.uint64, keepdims=True) + np.uint64(hi - lo)))
        else:
            sets.append(np.zeros(0, np.uint64))
    size = np.array([len(s) for s in sets], np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.r_[0, np.cumsum(size)]
