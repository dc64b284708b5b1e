"""The image chain as one Arrow-batched stage (the ``kernel`` engine).

Measured on 224x224x3 tensors (local[8]): Catalyst higher-order functions
run min-max at ~20 images/s and an index-gather flip at ~5 images/s,
because lambdas are interpreted per element; the same steps in NumPy over
an Arrow batch cost a few milliseconds per image.  So for real images the
per-pixel work runs here, once per image, while Spark keeps everything
else: the scan and JVM decode, labels, splits and the filter, the seeded
per-variant parameters (computed as Catalyst columns before this stage, so
retries reproduce them), the fan-out count, and all aggregates, joins and
writes.  One Python crossing per image: decoded pixels in, 1 + n float32
records out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PipelineConfig
from ..functions.random import md5_uniform
from ..session import ship_package
from . import kernels as K
from .imagestage import _apply as apply_steps
from .imagestage import chunk_rows, prepare_steps

def variant_params(cfg: PipelineConfig, path_col: str = "image_path") -> Column:
    """array<struct<angle, hflip, vflip, brightness>> for variants 1..n,
    the same draws as ``augment.with_params`` (md5 of seed|path|k|name)."""
    n = cfg.augmentation_factor if cfg.augmentation else 0
    if n == 0:
        return F.array().cast("array<struct<angle:double,hflip:boolean,vflip:boolean,brightness:double>>")
    p = F.col(path_col)
    r = float(cfg.rotation_range)

    def one(k):
        u = lambda name: md5_uniform(cfg.seed, p, k, F.lit(name))
        angle = F.lit(-r) + u("rotate") * F.lit(r - (-r)) if r > 0 else F.lit(None).cast("double")
        hf = u("hflip") > F.lit(0.5) if cfg.horizontal_flip else F.lit(None).cast("boolean")
        vf = u("vflip") > F.lit(0.5) if cfg.vertical_flip else F.lit(None).cast("boolean")
        if cfg.brightness_range is not None:
            lo, hi = cfg.brightness_range
            br = F.lit(float(lo)) + u("brightness") * F.lit(float(hi) - float(lo))
        else:
            br = F.lit(None).cast("double")
        return F.struct(angle.alias("angle"), hf.alias("hflip"), vf.alias("vflip"), br.alias("brightness"))

    return F.transform(F.sequence(F.lit(1), F.lit(n)), one)


def _clip_range(cfg: PipelineConfig) -> tuple[float, float]:
    if cfg.normalization == "min_max":
        return (cfg.norm_min, cfg.norm_max)
    if cfg.normalization == "z_score":
        return (float("-inf"), float("inf"))
    return (0.0, 255.0)


def _chain(cfg: PipelineConfig, resize: bool):
    want_hist = cfg.features and "histogram" in cfg.feature_methods
    lo, hi = _clip_range(cfg)

    steps = prepare_steps(cfg, resize)

    def prepare(imgs: np.ndarray):
        # decode-side steps shared with the step engine (resize, u8 rounding,
        # gray, denoise, histogram before normalisation)
        imgs, hist = apply_steps(steps, imgs, {})
        imgs = K.normalize(imgs, cfg.normalization, cfg.norm_min, cfg.norm_max)
        if want_hist and cfg.histogram_stage == "post":
            hist = K.histogram(imgs)
        return imgs, hist

    def variant(imgs: np.ndarray, angle, hflip, vflip, bright):
        if cfg.augmentation and cfg.rotation_range > 0:
            imgs = K.rotate(imgs, angle)
        if cfg.augmentation and cfg.horizontal_flip:
            imgs = np.where(hflip.reshape(-1, 1, 1, 1), imgs[:, :, ::-1, :], imgs)
        if cfg.augmentation and cfg.vertical_flip:
            imgs = np.where(vflip.reshape(-1, 1, 1, 1), imgs[:, ::-1, :, :], imgs)
        if cfg.augmentation and cfg.brightness_range is not None:
            imgs = K.brightness(imgs, bright, lo, hi, cfg.brightness_mode)
        return imgs

    return prepare, variant, want_hist


def _list(flat2d: np.ndarray, typ) -> pa.Array:
    b, per = flat2d.shape
    offs = (np.arange(b + 1, dtype=np.int64) * per).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(np.ascontiguousarray(flat2d.reshape(-1))))


def _stage(cfg: PipelineConfig, resize: bool, binary: bool, out_float32: bool, check_depth: bool):
    prepare, variant, want_hist = _chain(cfg, resize)
    steps = prepare_steps(cfg, resize)
    n_var = cfg.augmentation_factor if cfg.augmentation else 0
    vtype = pa.float32() if out_float32 else pa.float64()
    vdtype = np.float32 if out_float32 else np.float64

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            col = lambda c: batch.column(batch.schema.get_field_index(c))
            hs = col("height").to_numpy(zero_copy_only=False).astype(np.int64)
            ws = col("width").to_numpy(zero_copy_only=False).astype(np.int64)
            cs = col("channels").to_numpy(zero_copy_only=False).astype(np.int64)
            paths = col("image_path")
            data = col("data")
            if binary:
                get = lambda i: K.bgr_bytes_to_rgb(data[i].as_py(), int(hs[i]), int(ws[i]), int(cs[i]))
                in_c = np.full(n, 3, dtype=np.int64)
            else:
                offs = data.offsets.to_numpy()
                vals = data.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
                get = lambda i: vals[offs[i] : offs[i + 1]].reshape(int(hs[i]), int(ws[i]), int(cs[i]))
                in_c = cs
            params = col("variants").to_pylist()
            skip = np.zeros(n, dtype=bool)
            if check_depth:
                from ..sources.files import is_unsupported_depth

                pl = paths.to_pylist()
                for i in range(n):
                    skip[i] = cs[i] == 1 and is_unsupported_depth(pl[i], 1)
            # a malformed image (pixel bytes that do not match its declared
            # shape) must not fail the task: it is left out here and reported
            # by the rejects anti-join (decode_error); lengths come from the
            # Arrow offsets, nothing is decoded ahead of its chunk
            lengths = pc.binary_length(data) if binary else pc.list_value_length(data)
            sizes = lengths.to_numpy(zero_copy_only=False)  # NULL -> NaN: skipped too
            expected = hs * ws * cs
            groups: dict[tuple[int, int, int], list[int]] = {}
            for i in range(n):
                if skip[i] or hs[i] <= 0 or not sizes[i] == expected[i]:
                    continue
                groups.setdefault((int(hs[i]), int(ws[i]), int(in_c[i])), []).append(i)
            for (h, w, c), idx in groups.items():
                per = chunk_rows(steps, h, w, c)
                for start in range(0, len(idx), per):
                    part = np.asarray(idx[start : start + per], dtype=np.int64)
                    base, hist = prepare(np.stack([get(int(i)) for i in part]))
                    b = len(part)
                    take = pa.array(part)
                    keys = [x.take(take) for x in (paths, col("split"), col("label"))]

                    def emit(k: int, imgs: np.ndarray) -> pa.RecordBatch:
                        _, oh, ow, oc = imgs.shape
                        cols = dict(zip(("image_path", "split", "label"), keys))
                        for name, v in (("augmentation_index", k), ("height", oh), ("width", ow), ("channels", oc)):
                            cols[name] = pa.array(np.full(b, v, dtype=np.int32))
                        cols["data"] = _list(imgs.reshape(b, -1).astype(vdtype), vtype)
                        if want_hist:
                            cols["hist"] = _list(hist.reshape(b, -1).astype(np.int64), pa.int64())
                        return pa.RecordBatch.from_arrays(list(cols.values()), list(cols.keys()))

                    # one batch a variant: the worker never holds all of them
                    yield emit(0, base)
                    for k in range(n_var):
                        ps = [params[int(i)][k] for i in part]
                        ang = np.array([np.nan if p["angle"] is None else p["angle"] for p in ps])
                        hf = np.array([bool(p["hflip"]) for p in ps])
                        vf = np.array([bool(p["vflip"]) for p in ps])
                        br = np.array([np.nan if p["brightness"] is None else p["brightness"] for p in ps])
                        yield emit(k + 1, variant(base, ang, hf, vf, br))

    return run


def process_fused(
    images: DataFrame,
    cfg: PipelineConfig,
    *,
    at_target_size: bool = False,
    out_float32: bool = True,
    key_col: str = "image_path",
) -> DataFrame:
    """images (image_path, label, split, height, width, channels, data) ->
    one row per (image, variant) with ``data`` as float32 (default) or
    float64, plus ``features`` (map, NULL when off)."""
    ship_package(images.sparkSession)
    binary = isinstance(images.schema["data"].dataType, T.BinaryType)
    want_hist = cfg.features and "histogram" in cfg.feature_methods
    src = images.select(
        "image_path",
        "split",
        F.col("label").cast("int").alias("label"),
        F.col("height").cast("int").alias("height"),
        F.col("width").cast("int").alias("width"),
        F.col("channels").cast("int").alias("channels"),
        "data",
        variant_params(cfg, key_col).alias("variants"),
    )
    elem = T.FloatType() if out_float32 else T.DoubleType()
    fields = [
        T.StructField("image_path", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("augmentation_index", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("channels", T.IntegerType()),
        T.StructField("data", T.ArrayType(elem)),
    ]
    if want_hist:
        fields.append(T.StructField("hist", T.ArrayType(T.LongType())))
    fn = _stage(cfg, binary or not at_target_size, binary, out_float32, binary)
    out = src.mapInArrow(fn, T.StructType(fields))
    if want_hist:
        from ..plans.pipeline import features_map

        return out.withColumn("features", features_map(F.col("hist"), cfg.out_channels)).drop("hist")
    return out.withColumn("features", F.lit(None).cast("map<string,array<float>>"))
