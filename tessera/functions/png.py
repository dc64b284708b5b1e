"""Minimal 8-bit PNG encoder (gray or RGB), zlib + struct only.

Used to materialise tiles derived from the driver's tables as real image
files, so the file scan, the JVM decoder and streaming ingest are exercised
on data that grows with the tables.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np


def _chunk(kind: bytes, data: bytes) -> bytes:
    crc = zlib.crc32(kind + data) & 0xFFFFFFFF
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", crc)


def encode_png(pixels: np.ndarray) -> bytes:
    """pixels: (H, W) gray or (H, W, 3) RGB, values 0..255."""
    a = np.clip(np.asarray(pixels), 0, 255).astype(np.uint8)
    h, w = a.shape[:2]
    color_type, chans = (0, 1) if a.ndim == 2 or a.shape[2] == 1 else (2, 3)
    rows = a.reshape(h, w * chans)
    raw = b"".join(b"\x00" + rows[y].tobytes() for y in range(h))
    ihdr = struct.pack(">IIBBBBB", w, h, 8, color_type, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", ihdr) + _chunk(b"IDAT", zlib.compress(raw, 6)) + _chunk(b"IEND", b"")
