"""NumPy kernels for the per-image steps Catalyst cannot express efficiently.

Each kernel works on a stack of same-shape images ``(B, H, W, C)`` in
float64, so one Arrow batch becomes a handful of vectorised NumPy calls.
The formulas are fixed here (and mirrored by the SQL oracle):

* area resize n -> m, s = n/m, when both axes shrink (or stay):
  ``W[o, i] = max(0, min((o+1)s, i+1) - max(o s, i)) / s``.  Otherwise both
  axes take two taps, ``i0 = floor(o s)`` and the next one (the last at the
  edge), with ``f = (o+1) - (i0+1)/s``, 0 if negative, else its fraction.
* Gaussian k: fixed rows for k = 1, 3, 5, 7, else sigma =
  0.3((k-1)/2 - 1) + 0.8; border mirrored without repeating the edge pixel.
* median k x k, border replicated.
* rotation by ``a`` degrees about (w/2, h/2), inverse map
  ``sx = cos a (x-cx) - sin a (y-cy) + cx``, ``sy = sin a (x-cx) + cos a (y-cy) + cy``,
  bilinear, taps outside the image count as 0.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_MEDIAN_BYTES = 16 << 20
GRAY_WEIGHTS = np.array([0.299, 0.587, 0.114])


@lru_cache(maxsize=64)
def resize_weights(n: int, m: int, area: bool = True) -> np.ndarray:
    """(m, n) matrix mapping n input samples to m output samples; ``area``:
    both axes of the image shrink."""
    w = np.zeros((m, n), dtype=np.float64)
    s = n / m
    if area:
        for o in range(m):
            lo, hi = o * s, (o + 1) * s
            for i in range(int(np.floor(lo)), min(n, int(np.ceil(hi)))):
                ov = min(hi, i + 1) - max(lo, i)
                if ov > 0:
                    w[o, i] = ov / s
    else:
        for o in range(m):
            i0 = int(np.floor(o * s))
            f = (o + 1) - (i0 + 1) / s
            f = 0.0 if f <= 0 else f - np.floor(f)
            w[o, i0] += 1.0 - f
            w[o, min(i0 + 1, n - 1)] += f
    w.setflags(write=False)
    return w


@lru_cache(maxsize=64)
def resize_band(n: int, m: int, area: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The non-zero band of :func:`resize_weights`: for each output sample
    the K source indices and weights (K = widest band; padding weights 0)."""
    w = resize_weights(n, m, area)
    nz = w != 0
    start = nz.argmax(axis=1)
    stop = n - nz[:, ::-1].argmax(axis=1)
    k = int((stop - start).max())
    idx = np.minimum(start[:, None] + np.arange(k)[None, :], n - 1)
    wk = np.where(np.arange(k)[None, :] < (stop - start)[:, None], np.take_along_axis(w, idx, axis=1), 0.0)
    idx.setflags(write=False)
    wk.setflags(write=False)
    return idx, wk


def resize(imgs: np.ndarray, out_h: int, out_w: int) -> np.ndarray:
    """Separable resize of (B, H, W, C) to (B, out_h, out_w, C).

    Each axis gathers only the few source samples an output covers (the
    band of the weights), so the cost is taps x output size,
    not input x output size as a dense matrix product would be."""
    _, h, w, _ = imgs.shape
    if (h, w) == (out_h, out_w):
        return imgs
    area = out_h <= h and out_w <= w
    iy, wy = resize_band(h, out_h, area)
    tmp = wy[None, :, 0, None, None] * imgs[:, iy[:, 0], :, :]
    for k in range(1, iy.shape[1]):
        tmp += wy[None, :, k, None, None] * imgs[:, iy[:, k], :, :]
    ix, wx = resize_band(w, out_w, area)
    out = wx[None, None, :, 0, None] * tmp[:, :, ix[:, 0], :]
    for k in range(1, ix.shape[1]):
        out += wx[None, None, :, k, None] * tmp[:, :, ix[:, k], :]
    return out


@lru_cache(maxsize=16)
def gaussian_taps(k: int) -> np.ndarray:
    if k == 1:
        return np.array([1.0])
    if k == 3:
        return np.array([1.0, 2.0, 1.0]) / 4.0
    if k == 5:
        return np.array([1.0, 4.0, 6.0, 4.0, 1.0]) / 16.0
    if k == 7:  # fixed values
        return np.array([0.03125, 0.109375, 0.21875, 0.28125, 0.21875, 0.109375, 0.03125])
    sigma = 0.3 * ((k - 1) / 2 - 1) + 0.8
    x = np.arange(k) - (k - 1) / 2
    g = np.exp(-(x * x) / (2 * sigma * sigma))
    return g / g.sum()


def _reflect_index(n: int, r: int) -> np.ndarray:
    """Indices -r..n-1+r mirrored without repeating the edge (-1 -> 1)."""
    idx = np.arange(-r, n + r)
    if n == 1:
        return np.zeros_like(idx)
    period = 2 * (n - 1)
    idx = np.mod(idx, period)
    return np.where(idx >= n, period - idx, idx)


def gaussian_blur(imgs: np.ndarray, k: int) -> np.ndarray:
    taps = gaussian_taps(k)
    r = k // 2
    _, h, w, _ = imgs.shape
    ry = _reflect_index(h, r)
    rx = _reflect_index(w, r)
    p = imgs[:, ry, :, :]
    out = sum(taps[j] * p[:, j : j + h, :, :] for j in range(k))
    p = out[:, :, rx, :]
    return sum(taps[j] * p[:, :, j : j + w, :] for j in range(k))


def median_blur(imgs: np.ndarray, k: int) -> np.ndarray:
    """k x k median; the k * k shifted copies exist for a few images, or rows of
    one image, at a time (_MEDIAN_BYTES)."""
    r = k // 2
    b, h, w, c = imgs.shape
    out = np.empty_like(imgs)
    per_row = w * c * 8 * k * k
    n = max(1, _MEDIAN_BYTES // (per_row * h))
    rows = h if n > 1 else max(1, min(h, _MEDIAN_BYTES // per_row))
    for i in range(0, b, n):
        p = np.pad(imgs[i : i + n], ((0, 0), (r, r), (r, r), (0, 0)), mode="edge")
        for y in range(0, h, rows):
            m = min(rows, h - y)
            win = np.stack([p[:, y + dy : y + dy + m, dx : dx + w, :] for dy in range(k) for dx in range(k)], axis=0)
            out[i : i + n, y : y + m] = np.median(win, axis=0, overwrite_input=True)
    return out


def rotate(imgs: np.ndarray, angles_deg: np.ndarray) -> np.ndarray:
    """Rotate each image by its own angle; NaN angle leaves it unchanged.

    Bilinear sampling through a channel-major pixel table: every tap is one
    contiguous ``take`` per channel; taps outside the image weigh 0."""
    b, h, w, c = imgs.shape
    out = imgs.copy()
    todo = ~np.isnan(angles_deg)
    if not todo.any():
        return out
    a = np.deg2rad(angles_deg[todo])[:, None, None]
    cx, cy = w / 2.0, h / 2.0
    yy, xx = np.meshgrid(np.arange(h, dtype=np.float64), np.arange(w, dtype=np.float64), indexing="ij")
    dx, dy = xx[None] - cx, yy[None] - cy
    ca, sa = np.cos(a), np.sin(a)
    sx = ca * dx - sa * dy + cx
    sy = sa * dx + ca * dy + cy
    x0f = np.floor(sx)
    y0f = np.floor(sy)
    fx = sx - x0f
    fy = sy - y0f
    x0 = x0f.astype(np.int64)
    y0 = y0f.astype(np.int64)
    nb = int(todo.sum())
    src = np.ascontiguousarray(imgs[todo].transpose(3, 0, 1, 2)).reshape(c, -1)
    base = (np.arange(nb, dtype=np.int64) * (h * w))[:, None, None]
    acc = np.zeros((c, nb * h * w), dtype=np.float64)
    for oy, ox, wt in ((0, 0, (1 - fx) * (1 - fy)), (0, 1, fx * (1 - fy)), (1, 0, (1 - fx) * fy), (1, 1, fx * fy)):
        ty, tx = y0 + oy, x0 + ox
        inside = (ty >= 0) & (ty < h) & (tx >= 0) & (tx < w)
        idx = (base + np.clip(ty, 0, h - 1) * w + np.clip(tx, 0, w - 1)).reshape(-1)
        wv = np.where(inside, wt, 0.0).reshape(-1)
        for ch in range(c):
            acc[ch] += src[ch].take(idx) * wv
    out[todo] = acc.reshape(c, nb, h, w).transpose(1, 2, 3, 0)
    return out


def to_gray(imgs: np.ndarray, round_u8: bool) -> np.ndarray:
    g = np.tensordot(imgs[..., :3], GRAY_WEIGHTS, axes=([3], [0]))[..., None]
    return np.floor(g + 0.5) if round_u8 else g


def histogram(imgs: np.ndarray) -> np.ndarray:
    """(B, C, 256) counts of unit bins over [0, 256); other values ignored."""
    b, h, w, c = imgs.shape
    v = imgs.reshape(b, h * w, c)
    ok = (v >= 0) & (v < 256)
    bins = np.where(ok, np.floor(np.where(ok, v, 0)), 0).astype(np.int64)
    key = (np.arange(b)[:, None, None] * c + np.arange(c)[None, None, :]) * 256 + bins
    counts = np.bincount(key[ok], minlength=b * c * 256)
    return counts.reshape(b, c, 256)


def bgr_bytes_to_rgb(buf: bytes, h: int, w: int, n_channels: int) -> np.ndarray:
    """Image-source pixel bytes (B,G,R[,A] or gray) to (H, W, 3) float64 RGB."""
    a = np.frombuffer(buf, dtype=np.uint8, count=h * w * n_channels).reshape(h, w, n_channels)
    if n_channels == 1:
        rgb = np.repeat(a, 3, axis=2)
    else:
        rgb = a[:, :, 2::-1]
    return rgb.astype(np.float64)


def normalize(imgs: np.ndarray, method: str, lo: float, hi: float) -> np.ndarray:
    """Per-image (whole tensor) normalisation, same formulas as the
    Catalyst form: min-max to [lo, hi], z-score with population std."""
    b = imgs.shape[0]
    flat = imgs.reshape(b, -1)
    if method == "min_max":
        mn = flat.min(axis=1)[:, None]
        mx = flat.max(axis=1)[:, None]
        # same operations and order as the Catalyst form, in place
        out = flat - mn
        out /= mx - mn + 1e-8
        out *= hi - lo
        out += lo
    elif method == "z_score":
        mean = flat.sum(axis=1)[:, None] / flat.shape[1]
        out = flat - mean
        std = np.sqrt((out * out).sum(axis=1)[:, None] / flat.shape[1])
        out /= std + 1e-8
    else:
        out = flat
    return out.reshape(imgs.shape)


def brightness(imgs: np.ndarray, factors: np.ndarray, lo: float, hi: float, mode: str) -> np.ndarray:
    """Scale each image by its factor (NaN: unchanged), clip to [lo, hi]
    (default) or to [0, 255] and truncate (``u8_compat``)."""
    f = factors.reshape(-1, 1, 1, 1)
    ok = ~np.isnan(f)
    if mode == "u8_compat":
        scaled = np.floor(np.clip(imgs * np.where(ok, f, 1.0), 0.0, 255.0))
    else:
        scaled = np.minimum(np.maximum(imgs * np.where(ok, f, 1.0), lo), hi)
    return np.where(ok, scaled, imgs)
