"""CRC-32C (Castagnoli) in NumPy, lane-parallel, for TFRecord framing.

A byte-at-a-time table loop in Python costs ~0.3 s for one 602 KB tensor;
this takes ~4 ms.  Messages of one length class are left-padded with zeros
to a common length (leading zeros do not change a CRC computed from state
0) and cut into L equal lanes; a slicing-by-4 table step then advances all
(message, lane) pairs at once over a contiguous word array.  Lane results
are folded pairwise with the "append n zero bytes" operator, a GF(2)-linear
map applied through four 256-entry tables.  Finally the standard pre/post
conditioning (init and xor-out 0xFFFFFFFF) is applied through the same
operator for each message length.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

POLY = 0x82F63B78  # reflected Castagnoli polynomial


def _make_table() -> np.ndarray:
    t = np.zeros(256, dtype=np.uint32)
    for i in range(256):
        c = i
        for _ in range(8):
            c = (c >> 1) ^ POLY if c & 1 else c >> 1
        t[i] = c
    return t


TABLE = _make_table()


def _zero_byte_map() -> np.ndarray:
    """Images of the 32 unit states under one zero byte: state -> state'."""
    out = np.zeros(32, dtype=np.uint64)
    for bit in range(32):
        s = np.uint32(1 << bit)
        out[bit] = (s >> np.uint32(8)) ^ TABLE[int(s) & 0xFF]
    return out


def _compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix of (apply a, then b); each is 32 column images."""
    res = np.zeros(32, dtype=np.uint64)
    for bit in range(32):
        x = int(a[bit])
        acc = 0
        j = 0
        while x:
            if x & 1:
                acc ^= int(b[j])
            x >>= 1
            j += 1
        res[bit] = acc
    return res


@lru_cache(maxsize=64)
def _zeros_matrix_pow2(k: int) -> np.ndarray:
    """Operator for appending 2**k zero bytes."""
    if k == 0:
        return _zero_byte_map()
    m = _zeros_matrix_pow2(k - 1)
    return _compose(m, m)


@lru_cache(maxsize=256)
def _zeros_matrix(n: int) -> np.ndarray:
    res = None
    k = 0
    while n:
        if n & 1:
            m = _zeros_matrix_pow2(k)
            res = m if res is None else _compose(res, m)
        n >>= 1
        k += 1
    if res is None:
        res = np.array([1 << b for b in range(32)], dtype=np.uint64)
    return res


def _byte_tables(mat: np.ndarray) -> np.ndarray:
    """(4, 256) tables so that apply(mat, x) = xor of T[i][byte_i(x)]."""
    tabs = np.zeros((4, 256), dtype=np.uint32)
    for i in range(4):
        for v in range(256):
            acc = 0
            for j in range(8):
                if v >> j & 1:
                    acc ^= int(mat[8 * i + j])
            tabs[i, v] = acc
    return tabs


@lru_cache(maxsize=256)
def _zeros_tables(n: int) -> np.ndarray:
    return _byte_tables(_zeros_matrix(n))


def _apply_tables(tabs: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (
        tabs[0][x & 0xFF]
        ^ tabs[1][(x >> 8) & 0xFF]
        ^ tabs[2][(x >> 16) & 0xFF]
        ^ tabs[3][(x >> 24) & 0xFF]
    )


def _slice4_tables() -> np.ndarray:
    """T[k][b]: CRC of byte b followed by k zero bytes (slicing-by-4)."""
    t = np.zeros((4, 256), dtype=np.uint32)
    t[0] = TABLE
    for k in range(1, 4):
        t[k] = (t[k - 1] >> 8) ^ TABLE[t[k - 1] & 0xFF]
    return t


SLICE4 = _slice4_tables()


def _raw_crc_lanes(buf: np.ndarray) -> np.ndarray:
    """Raw CRC (state 0, no xor-out) of each row of a (R, M) uint8 array,
    M a multiple of 4: four bytes per step (slicing-by-4), rows advanced
    together over a contiguous (M/4, R) word array."""
    r, m = buf.shape
    words = np.ascontiguousarray(buf.view("<u4").T)  # (M/4, R)
    t0, t1, t2, t3 = SLICE4
    crc = np.zeros(r, dtype=np.uint32)
    for j in range(words.shape[0]):
        x = crc ^ words[j]
        crc = t3[x & 0xFF] ^ t2[(x >> 8) & 0xFF] ^ t1[(x >> 16) & 0xFF] ^ t0[x >> 24]
    return crc


def _crc_same_class(messages: list[bytes], lens: np.ndarray) -> np.ndarray:
    """Standard CRC-32C of messages of similar length (one padded block)."""
    n = len(messages)
    longest = int(lens.max())
    # about 128 table steps per lane, lanes a power of two
    lanes = 1
    while lanes < 8192 and longest // (lanes * 2) >= 128:
        lanes *= 2
    per = -(-max(longest, 1) // lanes)
    per = -(-per // 4) * 4  # whole 32-bit words per lane
    total = per * lanes
    buf = np.zeros((n, total), dtype=np.uint8)
    for i, msg in enumerate(messages):
        if msg:
            buf[i, total - len(msg) :] = np.frombuffer(msg, dtype=np.uint8)
    crc = _raw_crc_lanes(buf.reshape(n * lanes, per)).reshape(n, lanes)
    # fold neighbouring lanes pairwise: left block shifted by the right
    # block's length, xor right; log2(lanes) vectorised steps
    block = per
    while crc.shape[1] > 1:
        crc = _apply_tables(_zeros_tables(block), crc[:, 0::2]) ^ crc[:, 1::2]
        block *= 2
    raw = crc[:, 0]
    # conditioning: crc = raw ^ zeros(len)(0xFFFFFFFF) ^ 0xFFFFFFFF
    init = np.empty(n, dtype=np.uint32)
    for i, ln in enumerate(lens):
        init[i] = _apply_tables(_zeros_tables(int(ln)), np.array([0xFFFFFFFF], dtype=np.uint32))[0]
    return raw ^ init ^ np.uint32(0xFFFFFFFF)


def crc32c_many(messages: list[bytes]) -> np.ndarray:
    """Standard CRC-32C of each message.  Messages are grouped by length
    class (powers of two) so a short message is never padded to a long one."""
    n = len(messages)
    out = np.zeros(n, dtype=np.uint32)
    if n == 0:
        return out
    lens = np.array([len(m) for m in messages], dtype=np.int64)
    cls = np.ceil(np.log2(np.maximum(lens, 1))).astype(np.int64)
    for c in np.unique(cls):
        idx = np.nonzero(cls == c)[0]
        # bound the padded working set (~8 MB) so the table steps stay in cache
        step = max(1, (8 << 20) // max(1, int(lens[idx].max())))
        for k in range(0, len(idx), step):
            part = idx[k : k + step]
            out[part] = _crc_same_class([messages[i] for i in part], lens[part])
    return out


def crc32c(data: bytes) -> int:
    return int(crc32c_many([data])[0])


def masked(crc: np.ndarray | int):
    """TFRecord masking: rotate right 15 and add a constant."""
    c = np.asarray(crc, dtype=np.uint64)
    rot = ((c >> 15) | (c << 17)) & 0xFFFFFFFF
    return ((rot + 0xA282EAD8) & 0xFFFFFFFF).astype(np.uint32)
