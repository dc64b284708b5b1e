"""One fused ``mapInArrow`` stage that runs a chain of NumPy kernels.

The stage keeps every other column as it is (Arrow passes them through
untouched) and replaces ``height``/``width``/``channels``/``data``.  Rows
of one Arrow batch are grouped by shape, stacked, and each kernel runs
once per group, so the Python cost is per batch, not per pixel.

Input ``data`` may be ``array<double>`` (already a tensor) or ``binary``
(the pixel bytes of Spark's image source, B,G,R[,A] or gray), in which
case the first step turns it into RGB.

Nothing here draws random numbers: per-row parameters (rotation angle)
arrive as columns computed by Catalyst, so a retried task reproduces its
output exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from . import kernels as K


@dataclass(frozen=True)
class Step:
    op: str  # resize | gray | gaussian | median | rotate | round_u8 | histogram
    a: int = 0
    b: int = 0
    flag: bool = False
    param: str | None = None  # column holding a per-row parameter


def resize(h: int, w: int) -> Step:
    return Step("resize", h, w)


def gray(round_u8: bool) -> Step:
    return Step("gray", flag=round_u8)


def gaussian(k: int) -> Step:
    return Step("gaussian", k)


def median(k: int) -> Step:
    return Step("median", k)


def rotate(angle_col: str) -> Step:
    return Step("rotate", param=angle_col)


def round_u8() -> Step:
    return Step("round_u8")


def histogram() -> Step:
    return Step("histogram")


def prepare_steps(cfg, with_resize: bool = True) -> list[Step]:
    """The decode-side steps for a config: resize (+ u8 rounding), gray,
    denoise (+ rounding), histogram before normalisation."""
    steps: list[Step] = []
    if with_resize:
        steps.append(resize(cfg.target_height, cfg.target_width))
        if cfg.round_u8:
            steps.append(round_u8())
    if cfg.color_space == "GRAYSCALE":
        steps.append(gray(cfg.round_u8))
    if cfg.denoise and cfg.denoise_method in ("gaussian", "median"):
        steps.append(gaussian(cfg.kernel_size) if cfg.denoise_method == "gaussian" else median(cfg.kernel_size))
        if cfg.round_u8 and cfg.denoise_method == "gaussian":
            steps.append(round_u8())
    if wants_histogram(cfg) and cfg.histogram_stage == "pre":
        steps.append(histogram())
    return steps


def wants_histogram(cfg) -> bool:
    return cfg.features and "histogram" in cfg.feature_methods


# Images worked on at once, by the larger of their input and output tensors.
MAX_CHUNK_BYTES = 16 << 20


def chunk_rows(steps: tuple[Step, ...] | list[Step], h: int, w: int, c: int) -> int:
    """Images of h x w x c that a chunk takes through ``steps``."""
    values = h * w * c
    for s in steps:
        if s.op == "resize":
            values = max(values, s.a * s.b * c)
    return max(1, MAX_CHUNK_BYTES // max(1, values * 8))


def _apply(steps: tuple[Step, ...], imgs: np.ndarray, params: dict[str, np.ndarray]):
    hist = None
    for s in steps:
        if s.op == "resize":
            imgs = K.resize(imgs, s.a, s.b)
        elif s.op == "gray":
            imgs = K.to_gray(imgs, s.flag)
        elif s.op == "gaussian":
            imgs = K.gaussian_blur(imgs, s.a)
        elif s.op == "median":
            imgs = K.median_blur(imgs, s.a)
        elif s.op == "rotate":
            imgs = K.rotate(imgs, params[s.param])
        elif s.op == "round_u8":
            imgs = np.clip(np.floor(imgs + 0.5), 0, 255)
        elif s.op == "histogram":
            hist = K.histogram(imgs)
        else:  # pragma: no cover - guarded by the constructors above
            raise ValueError(s.op)
    return imgs, hist


def _list_array(flat: np.ndarray, rows: int, typ) -> pa.Array:
    per = flat.size // rows if rows else 0
    # a chunk is bounded, so its offsets fit
    offsets = np.arange(rows + 1, dtype=np.int32) * np.int32(per)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(flat.reshape(-1))))


def _emit(part: pa.RecordBatch, res: np.ndarray, hist, data_col: str, hist_col: str | None) -> pa.RecordBatch:
    b, h, w, c = res.shape
    cols, names = [], []
    for name in part.schema.names:
        if name == "height":
            cols.append(pa.array(np.full(b, h, dtype=np.int32)))
        elif name == "width":
            cols.append(pa.array(np.full(b, w, dtype=np.int32)))
        elif name == "channels":
            cols.append(pa.array(np.full(b, c, dtype=np.int32)))
        elif name == data_col:
            cols.append(_list_array(res.reshape(b, -1), b, pa.float64()))
        else:
            cols.append(part.column(name))
        names.append(name)
    if hist_col is not None:
        cols.append(_list_array(hist.reshape(b, -1).astype(np.int64), b, pa.int64()))
        names.append(hist_col)
    return pa.RecordBatch.from_arrays(cols, names=names)


def _stage_fn(
    steps: tuple[Step, ...], data_col: str, binary_input: bool, want_hist: bool, hist_col: str, depth_path_col: str | None
):
    param_cols = sorted({s.param for s in steps if s.param})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            hs = batch.column("height").to_numpy(zero_copy_only=False).astype(np.int64)
            ws = batch.column("width").to_numpy(zero_copy_only=False).astype(np.int64)
            cs = batch.column("channels").to_numpy(zero_copy_only=False).astype(np.int64)
            col = batch.column(data_col)
            if binary_input:
                get = lambda i: K.bgr_bytes_to_rgb(col[i].as_py(), int(hs[i]), int(ws[i]), int(cs[i]))
                in_c = np.full(n, 3, dtype=np.int64)
            else:
                offs = col.offsets.to_numpy()
                vals = col.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
                get = lambda i: vals[offs[i] : offs[i + 1]].reshape(int(hs[i]), int(ws[i]), int(cs[i]))
                in_c = cs
            params = {p: batch.column(p).to_numpy(zero_copy_only=False).astype(np.float64) for p in param_cols}
            skip = np.zeros(n, dtype=bool)
            if depth_path_col is not None:
                from ..sources.files import is_unsupported_depth

                paths = batch.column(depth_path_col).to_pylist()
                for i in range(n):
                    skip[i] = cs[i] == 1 and is_unsupported_depth(paths[i], 1)
            # rows whose pixel count does not match their shape are left out
            # (reported by the rejects anti-join), never fail the task
            lengths = pc.binary_length(col) if binary_input else pc.list_value_length(col)
            sizes = lengths.to_numpy(zero_copy_only=False)
            groups: dict[tuple[int, int, int], list[int]] = {}
            for i in range(n):
                if skip[i] or hs[i] <= 0 or not sizes[i] == hs[i] * ws[i] * cs[i]:
                    continue
                groups.setdefault((int(hs[i]), int(ws[i]), int(in_c[i])), []).append(i)
            # one output batch per same-shape slice: bounded size, no reordering needed
            for (h, w, c), idx in groups.items():
                per = chunk_rows(steps, h, w, c)
                for start in range(0, len(idx), per):
                    part = np.asarray(idx[start : start + per], dtype=np.int64)
                    imgs = np.stack([get(int(i)) for i in part])
                    res, hist = _apply(steps, imgs, {p: v[part] for p, v in params.items()})
                    yield _emit(batch.take(pa.array(part)), res, hist, data_col, hist_col if want_hist else None)

    return run


def malformed_rows(df: DataFrame, data_col: str = "data") -> DataFrame:
    """The rows of ``df`` that :func:`run_kernels` and the fused stage leave
    out, with a ``reason``: no pixels, or not as many as their shape says."""
    n = F.col("height") * F.col("width") * F.col("channels")
    size = F.octet_length(data_col) if isinstance(df.schema[data_col].dataType, T.BinaryType) else F.size(data_col)
    reason = F.when(F.col(data_col).isNull(), "no_pixels").when(
        F.coalesce((F.col("height") <= 0) | (size != n), F.lit(True)), "shape"
    )
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def run_kernels(
    df: DataFrame,
    steps: list[Step] | tuple[Step, ...],
    *,
    data_col: str = "data",
    hist_col: str = "hist",
    depth_check_path_col: str | None = None,
) -> DataFrame:
    """Run ``steps`` over the image columns of ``df`` in one Python stage.

    ``df`` must carry ``height``, ``width``, ``channels`` and ``data_col``.
    Rows whose pixels don't fit their shape are left out;
    :func:`malformed_rows` gives them.  A ``histogram`` step adds ``hist_col`` = flattened (C, 256) counts.
    ``depth_check_path_col`` drops gray PNG rows whose header says more than
    8 bits per sample (the image source keeps only the low byte of those);
    the rejects table reports them.
    """
    ship_package(df.sparkSession)
    steps = tuple(steps)
    src_type = df.schema[data_col].dataType
    binary_input = isinstance(src_type, T.BinaryType)
    want_hist = any(s.op == "histogram" for s in steps)
    fields = []
    for f in df.schema.fields:
        if f.name in ("height", "width", "channels"):
            fields.append(T.StructField(f.name, T.IntegerType(), True))
        elif f.name == data_col:
            fields.append(T.StructField(f.name, T.ArrayType(T.DoubleType(), True), True))
        else:
            fields.append(f)
    if want_hist:
        fields.append(T.StructField(hist_col, T.ArrayType(T.LongType(), True), True))
    schema = T.StructType(fields)
    # the stage reads these as int64 / float64 whatever the stored widths
    casts = [
        df[f.name].cast("int").alias(f.name) if f.name in ("height", "width", "channels") else df[f.name]
        for f in df.schema.fields
    ]
    fn = _stage_fn(steps, data_col, binary_input, want_hist, hist_col, depth_check_path_col)
    return df.select(*casts).mapInArrow(fn, schema)
