"""Augmentation: fan-out to 1 + n rows, seeded parameters, variant ops.

Order inside one variant: rotate, horizontal flip, vertical flip,
brightness.  Row 0 is always the unaugmented image.  Every random choice is
``md5_uniform(seed, image_path, augmentation_index, name)``, a column, so
the variants are identical across retries, recomputation and engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions import tensor as TN
from ..functions.random import md5_uniform, uniform_between
from . import imagestage as S


def fan_out(df: DataFrame, cfg: PipelineConfig, index_col: str = "augmentation_index") -> DataFrame:
    """1 row per image (index 0), or 1 + augmentation_factor when enabled.

    A generator (``explode``) is a narrow operator: variants stay in the
    partition of their image, nothing is shuffled."""
    n = cfg.augmentation_factor if cfg.augmentation else 0
    cols = [c for c in df.columns]
    return df.select(*cols, F.explode(F.sequence(F.lit(0), F.lit(n))).alias(index_col))


def u(cfg: PipelineConfig, name: str, path_col: str = "image_path", index_col: str = "augmentation_index") -> Column:
    return md5_uniform(cfg.seed, F.col(path_col), F.col(index_col), F.lit(name))


def with_params(
    df: DataFrame, cfg: PipelineConfig, path_col: str = "image_path", index_col: str = "augmentation_index"
) -> DataFrame:
    """Add aug_angle / aug_hflip / aug_vflip / aug_brightness (NULL where the
    step does not apply: row 0, or the step is off)."""
    is_var = F.col(index_col) > 0
    r = float(cfg.rotation_range)
    nul_d = F.lit(None).cast("double")
    nul_b = F.lit(None).cast("boolean")
    angle = (
        F.when(is_var, uniform_between(u(cfg, "rotate", path_col, index_col), -r, r)).otherwise(nul_d)
        if cfg.augmentation and r > 0
        else nul_d
    )
    hf = (
        F.when(is_var, u(cfg, "hflip", path_col, index_col) > F.lit(0.5)).otherwise(nul_b)
        if cfg.augmentation and cfg.horizontal_flip
        else nul_b
    )
    vf = (
        F.when(is_var, u(cfg, "vflip", path_col, index_col) > F.lit(0.5)).otherwise(nul_b)
        if cfg.augmentation and cfg.vertical_flip
        else nul_b
    )
    if cfg.augmentation and cfg.brightness_range is not None:
        lo, hi = cfg.brightness_range
        br = F.when(is_var, uniform_between(u(cfg, "brightness", path_col, index_col), lo, hi)).otherwise(nul_d)
    else:
        br = nul_d
    return df.select(
        "*", angle.alias("aug_angle"), hf.alias("aug_hflip"), vf.alias("aug_vflip"), br.alias("aug_brightness")
    )


def apply_variants(df: DataFrame, cfg: PipelineConfig, data_col: str = "data") -> DataFrame:
    """Apply the per-variant ops given the parameter columns of
    :func:`with_params`.  Rotation is a NumPy kernel (bilinear sampling);
    flips and brightness are Catalyst array expressions."""
    if cfg.augmentation and cfg.rotation_range > 0:
        df = S.run_kernels(df, [S.rotate("aug_angle")], data_col=data_col)
    d = F.col(data_col)
    h, w, c = F.col("height"), F.col("width"), F.col("channels")
    if cfg.augmentation and cfg.horizontal_flip:
        df = df.withColumn(data_col, F.when(F.col("aug_hflip"), TN.hflip(d, h, w, c)).otherwise(d))
    if cfg.augmentation and cfg.vertical_flip:
        df = df.withColumn(data_col, F.when(F.col("aug_vflip"), TN.vflip(d, h, w, c)).otherwise(d))
    if cfg.augmentation and cfg.brightness_range is not None:
        lo, hi = _clip_range(cfg)
        df = df.withColumn(
            data_col,
            F.when(
                F.col("aug_brightness").isNotNull(),
                TN.brightness(d, F.col("aug_brightness"), lo, hi, cfg.brightness_mode),
            ).otherwise(d),
        )
    return df


def _clip_range(cfg: PipelineConfig) -> tuple[float, float]:
    """Brightness clip bounds: the normalised range for min-max, the u8
    range when the tensor is not normalised; z-scores are unbounded so the
    clip is skipped by using infinities."""
    if cfg.normalization == "min_max":
        return (cfg.norm_min, cfg.norm_max)
    if cfg.normalization == "z_score":
        return (float("-inf"), float("inf"))
    return (0.0, 255.0)


def augment(df: DataFrame, cfg: PipelineConfig, path_col: str = "image_path", data_col: str = "data") -> DataFrame:
    """Fan-out, parameters and variant ops in one call."""
    out = fan_out(df, cfg)
    out = with_params(out, cfg, path_col=path_col)
    return apply_variants(out, cfg, data_col=data_col)
