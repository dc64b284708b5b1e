"""Tiny image files for file-level tests: PNG written with zlib + struct,
JPEG written through the JVM's ImageIO on the driver."""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data) & 0xFFFFFFFF)


def png_bytes(pixels: np.ndarray, *, bit_depth: int = 8, palette: np.ndarray | None = None) -> bytes:
    """pixels: (H, W) gray, (H, W, 3) RGB, (H, W, 4) RGBA, or (H, W) palette
    indices when ``palette`` (N, 3) is given."""
    a = np.asarray(pixels)
    h, w = a.shape[:2]
    if palette is not None:
        color_type, chans = 3, 1
    elif a.ndim == 2:
        color_type, chans = 0, 1
    elif a.shape[2] == 3:
        color_type, chans = 2, 3
    else:
        color_type, chans = 6, 4
    dtype = ">u2" if bit_depth == 16 else "u1"
    rows = a.reshape(h, w * chans).astype(dtype)
    raw = b"".join(b"\x00" + rows[y].tobytes() for y in range(h))
    ihdr = struct.pack(">IIBBBBB", w, h, bit_depth, color_type, 0, 0, 0)
    out = b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", ihdr)
    if palette is not None:
        out += _chunk(b"PLTE", np.asarray(palette, dtype=np.uint8).tobytes())
    return out + _chunk(b"IDAT", zlib.compress(raw)) + _chunk(b"IEND", b"")


def write(path: str, data: bytes) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    return path


def write_jpeg(spark, path: str, rgb: np.ndarray) -> str:
    """Encode with the JVM's ImageIO (no Python codec is installed)."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    jvm = spark.sparkContext._jvm
    h, w = rgb.shape[:2]
    img = jvm.java.awt.image.BufferedImage(w, h, jvm.java.awt.image.BufferedImage.TYPE_INT_RGB)
    for y in range(h):
        for x in range(w):
            r, g, b = (int(v) for v in rgb[y, x])
            img.setRGB(x, y, (r << 16) | (g << 8) | b)
    jvm.javax.imageio.ImageIO.write(img, "jpeg", jvm.java.io.File(path))
    return path
