"""The image chain as one DataFrame plan.

decode -> resize -> colour -> denoise -> normalise -> features -> augment ->
record projection.  The plan has no shuffle: every step is narrow, so a
partition of input files becomes a partition of output records.  Two
Python crossings at most (the prepare kernels, and the rotation kernel when
rotation is on); everything else is Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PipelineConfig
from ..functions import labels as LB
from ..functions import tensor as TN
from ..operators import augment as AU
from ..operators import imagestage as S
from ..operators.imagestage import prepare_steps, wants_histogram  # noqa: F401  (re-exported)

RECORD_KEY = ("image_path", "augmentation_index")


def with_label_split(
    df: DataFrame, cfg: PipelineConfig, path_col: str = "image_path", key_col: str | None = None
) -> DataFrame:
    """Add ``label`` and ``split`` from the path (native expressions).  With
    ``split_assignment="ratio"`` the seeded ratio split decides images
    without a split folder (or every image, unless existing folders are
    preserved); it keys on the image path, so all variants of an image
    share a split."""
    split = LB.split_expr(F.col(path_col))
    if cfg.split_assignment == "ratio":
        split = LB.ratio_split_expr(F.col(key_col or path_col), cfg, existing=split)
    return df.withColumn("label", LB.label_expr(F.col(path_col), cfg)).withColumn("split", split)


def known_labels(df: DataFrame) -> DataFrame:
    return df.where(F.col("label") >= 0)


def features_map(hist: Column, channels: int) -> Column:
    """map<string, array<float>>: histogram_channel_{i} -> 256 counts."""
    keys = F.array(*[F.lit(f"histogram_channel_{i}") for i in range(channels)])
    vals = F.array(
        *[F.transform(F.slice(hist, i * 256 + 1, 256), lambda x: x.cast("float")) for i in range(channels)]
    )
    return F.map_from_arrays(keys, vals)


def process(
    images: DataFrame,
    cfg: PipelineConfig,
    *,
    data_col: str = "data",
    at_target_size: bool = False,
    engine: str | None = None,
    key_col: str | None = None,
) -> DataFrame:
    """images (image_path, label, split, height, width, channels, data) ->
    processed rows (same keys + augmentation_index, tensor, features).

    ``at_target_size``: the caller guarantees every tensor already has the
    target height and width (e.g. tiles), so the resize kernel, and the
    Python crossing it costs, is left out of the plan.

    ``engine="kernel"`` runs the per-pixel steps in one Arrow-batched NumPy
    stage (see ``operators.fused``; the fast path for real image sizes);
    ``"native"`` runs normalisation, flips and brightness as Catalyst
    array expressions and only resize / blur / rotate / histogram in NumPy.
    Both produce the same values (checked against the SQL oracle).

    ``key_col`` names the column the seeded draws key on (default
    ``image_path``; the file job passes the path relative to the raw root,
    so moving a dataset does not change its variants)."""
    key_col = key_col or "image_path"
    if (engine or cfg.engine) == "kernel":
        from ..operators.fused import process_fused

        return process_fused(images, cfg, at_target_size=at_target_size, out_float32=True, key_col=key_col)
    is_binary = isinstance(images.schema[data_col].dataType, T.BinaryType)
    steps = prepare_steps(cfg, with_resize=is_binary or not at_target_size)
    if steps or is_binary:
        depth_col = "image_path" if is_binary and "image_path" in images.columns else None
        df = S.run_kernels(images, steps, data_col=data_col, depth_check_path_col=depth_col)
    else:
        df = images
    df = df.withColumn(data_col, TN.normalize(F.col(data_col), cfg.normalization, cfg.norm_min, cfg.norm_max))
    if wants_histogram(cfg) and cfg.histogram_stage == "post":
        df = S.run_kernels(df, [S.histogram()], data_col=data_col)
    if wants_histogram(cfg):
        df = df.withColumn("features", features_map(F.col("hist"), cfg.out_channels)).drop("hist")
    else:
        df = df.withColumn("features", F.lit(None).cast("map<string,array<float>>"))
    df = AU.augment(df, cfg, path_col=key_col, data_col=data_col)
    return df.drop("aug_angle", "aug_hflip", "aug_vflip", "aug_brightness")


def to_records(df: DataFrame, cfg: PipelineConfig, *, data_col: str = "data", nested: bool | None = None) -> DataFrame:
    """The stored record layout: flat float32 tensor, shape, features JSON
    (NULL when empty), optional nested copy."""
    nested = cfg.keep_nested_array if nested is None else nested
    cols = [
        F.col("image_path"),
        F.col("split"),
        F.col("label").cast("int").alias("label"),
        F.col("augmentation_index").cast("int").alias("augmentation_index"),
        TN.shape("height", "width", "channels").alias("image_shape"),
        (
            F.col(data_col)
            if df.schema[data_col].dataType.elementType == T.FloatType()
            else TN.to_float_array(F.col(data_col))
        ).alias("image_flattened"),
        F.when(F.size("features") > 0, F.to_json("features")).alias("features"),
    ]
    if nested:
        cols.append(
            F.transform(
                TN.nest(F.col(data_col), "height", "width", "channels"),
                lambda row: F.transform(row, lambda px: TN.to_float_array(px)),
            ).alias("image_array")
        )
    return df.select(*cols)
