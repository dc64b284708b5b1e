"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Inputs are the driver's tables (tiles and paths derived from
``embeddings``, see ``tessera.sources.tiles``).  Tensor results are emitted
long, ``(key..., pos, value)``, values rounded to 6 decimals, so the DuckDB
oracle can check every pixel.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions import labels as LB
from ..functions import tensor as TN
from ..functions.random import md5_uniform
from ..operators import augment as AU
from ..operators import batching as BT
from ..operators import imagestage as S
from ..operators import stats as ST
from ..operators.splits import stratified_split
from ..sources import tiles as TL
from . import pipeline as PL

# The tile configuration: the shipped settings (min-max, 2 variants,
# rotation 15, horizontal flip, brightness 0.8..1.2, seed 42) on 8x8
# continuous tiles, so no resize and no u8 rounding.
TILE_CFG = PipelineConfig(
    target_width=8,
    target_height=8,
    normalization="min_max",
    augmentation=True,
    rotation_range=15.0,
    horizontal_flip=True,
    vertical_flip=False,
    brightness_range=(0.8, 1.2),
    augmentation_factor=2,
    round_u8=False,
    engine="native",
)
# every augmentation switch on, for the parameter and flip checks
ALL_AUG_CFG = TILE_CFG.with_(vertical_flip=True)


def long_form(df: DataFrame, keys: list[str], data_col: str = "data") -> DataFrame:
    ex = df.select(*keys, F.posexplode(data_col).alias("pos", "value"))
    return ex.select(*keys, F.col("pos").cast("bigint").alias("pos"), TN.round6("value").alias("value"))


def _i64(c: str):
    return F.col(c).cast("bigint").alias(c)


# -- paths, labels, splits ---------------------------------------------------------


def labelled(spark: SparkSession, sf: str, cfg: PipelineConfig = TILE_CFG) -> DataFrame:
    p = TL.paths(spark, sf)
    return p.select("vec_id", "path", LB.label_expr("path", cfg).alias("label"), LB.split_expr("path").alias("split"))


def q_label_encode(spark, sf):
    return labelled(spark, sf).select("vec_id", "path", "label")


def q_label_filter(spark, sf):
    return PL.known_labels(labelled(spark, sf)).select("vec_id", "path", "label")


def q_split_extract(spark, sf):
    return labelled(spark, sf).select("vec_id", "path", "split")


def q_split_select(spark, sf):
    return PL.known_labels(labelled(spark, sf)).where(F.col("split") == "train")


def q_ratio_split(spark, sf):
    cfg = TILE_CFG
    df = labelled(spark, sf)
    return df.select(
        "vec_id",
        "path",
        md5_uniform(cfg.seed, F.col("path")).alias("u"),
        LB.ratio_split_expr("path", cfg.with_(preserve_existing_splits=False)).alias("ratio_split"),
        LB.ratio_split_expr("path", cfg, existing=F.col("split")).alias("split"),
    )


def q_ratio_split_stratified(spark, sf):
    cfg = TILE_CFG
    df = PL.known_labels(labelled(spark, sf))
    out = stratified_split(df, "label", "path", cfg)
    return out.select("vec_id", "path", _i64("label"), "split_strat")


def q_scan_counts(spark, sf):
    return ST.scan_counts(TL.paths(spark, sf), "path")


def q_split_union(spark, sf):
    """Union by name of two input roots (two version tags of the same raw
    layout); duplicates are kept."""
    p = TL.paths(spark, sf)
    roots = [
        p.select(F.lit("v1.0").alias("root"), "vec_id", "path"),
        p.select(F.lit("v1.1").alias("root"), "vec_id", F.regexp_replace("path", "^raw/v1\\.0/", "raw/v1.1/").alias("path")),
    ]
    return reduce(lambda a, b: a.unionByName(b), roots)


def q_limit_images(spark, sf):
    return TL.paths(spark, sf).orderBy("path").limit(10)


def q_distinct_splits(spark, sf):
    return PL.known_labels(labelled(spark, sf)).select("split").distinct()


def q_reject_rows(spark, sf):
    cfg = TILE_CFG
    e = TL.read_table(spark, sf, "embeddings")
    path = TL.synthetic_path(F.col("vec_id"), F.col("label"))
    lab = LB.label_expr(path, cfg)
    bad_shape = F.coalesce(F.size("embedding") != 64, F.lit(True))
    non_finite = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    reason = (
        F.when(bad_shape, F.struct(F.lit("decode").alias("stage"), F.lit("shape").alias("reason")))
        .when(non_finite, F.struct(F.lit("decode").alias("stage"), F.lit("non_finite").alias("reason")))
        .when(lab < 0, F.struct(F.lit("label").alias("stage"), F.lit("unknown_class").alias("reason")))
    )
    r = e.select("vec_id", path.alias("path"), reason.alias("r")).where(F.col("r").isNotNull())
    return r.select("vec_id", "path", "r.stage", "r.reason")


# -- tensors ---------------------------------------------------------------------


def q_tensor_stats(spark, sf):
    t = TL.tiles(spark, sf, with_path=False)
    s = t.select("vec_id", TN.tensor_stats("data").alias("s"))
    return s.select("vec_id", *[TN.round6(f"s.{k}").alias(k) for k in ("t_min", "t_max", "t_mean", "t_std")])


def q_norm_min_max(spark, sf):
    t = TL.tiles(spark, sf, with_path=False)
    return long_form(t.select("vec_id", TN.normalize("data", "min_max", 0.0, 1.0).alias("data")), ["vec_id"])


def q_norm_z_score(spark, sf):
    t = TL.tiles(spark, sf, with_path=False)
    return long_form(t.select("vec_id", TN.normalize("data", "z_score").alias("data")), ["vec_id"])


def q_norm_none(spark, sf):
    t = TL.tiles(spark, sf, with_path=False)
    return long_form(t.select("vec_id", TN.normalize("data", "none").alias("data")), ["vec_id"])


def q_flatten_tensor(spark, sf):
    t = TL.tiles(spark, sf, with_path=False)
    nested = t.select("vec_id", TN.nest("data", "height", "width", "channels").alias("nested"))
    return long_form(nested.select("vec_id", TN.unnest("nested").alias("data")), ["vec_id"])


def q_nest_tensor(spark, sf):
    t = TL.tiles(spark, sf, with_path=False)
    n = t.select("vec_id", TN.nest("data", "height", "width", "channels").alias("nested"))
    n = n.select("vec_id", F.posexplode("nested").alias("y", "row"))
    n = n.select("vec_id", "y", F.posexplode("row").alias("x", "px"))
    n = n.select("vec_id", "y", "x", F.posexplode("px").alias("c", "v"))
    return n.select(_i64("vec_id"), _i64("y"), _i64("x"), _i64("c"), TN.round6("v").alias("value"))


def q_tensor_shape(spark, sf):
    t = TL.tiles(spark, sf, with_path=False)
    return t.select(
        "vec_id",
        F.array_join(TN.shape("height", "width", "channels"), ",").alias("image_shape"),
        F.size("data").cast("bigint").alias("n_values"),
    )


def q_to_rgb(spark, sf):
    g = TL.tiles_u8(spark, sf, with_path=False)
    c3 = TL.tiles_rgb(spark, sf, with_path=False)
    a = g.select("vec_id", F.lit("gray").alias("src"), TN.to_rgb("data", "height", "width", "channels").alias("data"))
    b = c3.select("vec_id", F.lit("bgr").alias("src"), TN.to_rgb("data", "height", "width", "channels").alias("data"))
    return long_form(a.unionByName(b), ["vec_id", "src"])


def q_grayscale(spark, sf):
    c3 = TL.tiles_rgb(spark, sf, with_path=False)
    return long_form(c3.select("vec_id", TN.rgb_to_gray("data", "height", "width", True).alias("data")), ["vec_id"])


def _kernel_long(spark, sf, steps):
    t = TL.tiles(spark, sf, with_path=False)
    return long_form(S.run_kernels(t, steps), ["vec_id"])


def q_resize_area(spark, sf):
    return _kernel_long(spark, sf, [S.resize(4, 4)])


def q_resize_area_frac(spark, sf):
    return _kernel_long(spark, sf, [S.resize(5, 5)])


def q_resize_up(spark, sf):
    return _kernel_long(spark, sf, [S.resize(13, 12)])


def q_resize_mixed(spark, sf):
    """Fewer rows, more columns."""
    return _kernel_long(spark, sf, [S.resize(5, 12)])


def q_gaussian_blur(spark, sf):
    return _kernel_long(spark, sf, [S.gaussian(3)])


def q_gaussian_blur_7(spark, sf):
    return _kernel_long(spark, sf, [S.gaussian(7)])


def q_median_blur(spark, sf):
    return _kernel_long(spark, sf, [S.median(3)])


def q_median_blur_5(spark, sf):
    return _kernel_long(spark, sf, [S.median(5)])


def q_kernel_rejects(spark, sf):
    """Every row of a stage with malformed inputs: processed, or rejected with
    its reason."""
    t = TL.tiles(spark, sf, with_path=False)
    bad = F.when(F.col("vec_id") % 7 == 0, F.slice("data", 1, 60)).when(F.col("vec_id") % 11 != 0, F.col("data"))
    t = t.withColumn("data", bad)
    done = S.run_kernels(t, [S.resize(4, 4)]).select("vec_id", F.lit("processed").alias("outcome"), _i64("height"))
    return done.unionByName(S.malformed_rows(t).select("vec_id", F.col("reason").alias("outcome"), _i64("height")))


def q_histogram(spark, sf):
    t = TL.tiles_u8(spark, sf, with_path=False)
    h = S.run_kernels(t, [S.histogram()]).select("vec_id", "channels", F.posexplode("hist").alias("i", "cnt"))
    h = h.where(F.col("cnt") > 0)
    return h.select(
        "vec_id",
        F.floor(F.col("i") / 256).cast("bigint").alias("channel"),
        (F.col("i") % 256).cast("bigint").alias("bin"),
        F.col("cnt").cast("bigint").alias("cnt"),
    )


def q_histogram_dataset(spark, sf):
    return ST.histogram_dataset(TL.tiles_u8(spark, sf, with_path=False), channels=1)


def q_histogram_dataset_kernel(spark, sf):
    return ST.histogram_dataset(TL.tiles_u8(spark, sf, with_path=False), channels=1, engine="kernel")


def q_features_json(spark, sf):
    t = TL.tiles_u8(spark, sf, with_path=False)
    h = S.run_kernels(t, [S.histogram()])
    f = h.select("vec_id", PL.features_map(F.col("hist"), 1).alias("features"))
    return f.select("vec_id", F.when(F.size("features") > 0, F.to_json("features")).alias("features"))


# -- augmentation -----------------------------------------------------------------


def _images(spark, sf, cfg=TILE_CFG) -> DataFrame:
    """Labelled tiles with known classes: (image_path, label, split, tensor)."""
    t = TL.tiles(spark, sf)
    t = t.withColumnRenamed("path", "image_path")
    t = PL.with_label_split(t, cfg)
    t = t.where(LB.extension_expr("image_path").isin([e.lower() for e in cfg.extensions]))
    return PL.known_labels(t)


def q_augment_fanout(spark, sf):
    df = AU.fan_out(_images(spark, sf).select("vec_id", "image_path"), TILE_CFG)
    return df.select("vec_id", "image_path", _i64("augmentation_index"))


def q_aug_params(spark, sf):
    cfg = ALL_AUG_CFG
    df = AU.with_params(AU.fan_out(_images(spark, sf).select("image_path"), cfg), cfg)
    return df.select(
        "image_path",
        _i64("augmentation_index"),
        TN.round6("aug_angle").alias("angle"),
        # the original row is never flipped: false rather than NULL
        F.coalesce(F.col("aug_hflip"), F.lit(False)).alias("hflip"),
        F.coalesce(F.col("aug_vflip"), F.lit(False)).alias("vflip"),
        TN.round6("aug_brightness").alias("brightness"),
    )


def _variants(spark, sf, cfg):
    df = _images(spark, sf, cfg).drop("vec_id", "label", "split")
    return AU.with_params(AU.fan_out(df, cfg), cfg)


def q_aug_rotate(spark, sf):
    cfg = ALL_AUG_CFG
    df = S.run_kernels(_variants(spark, sf, cfg), [S.rotate("aug_angle")])
    return long_form(df.withColumn("augmentation_index", F.col("augmentation_index").cast("bigint")),
                     ["image_path", "augmentation_index"])


def _flip_query(spark, sf, which):
    cfg = ALL_AUG_CFG
    df = _variants(spark, sf, cfg)
    d, h, w, c = F.col("data"), F.col("height"), F.col("width"), F.col("channels")
    flipped = TN.hflip(d, h, w, c) if which == "h" else TN.vflip(d, h, w, c)
    flag = F.col("aug_hflip") if which == "h" else F.col("aug_vflip")
    df = df.withColumn("data", F.when(flag, flipped).otherwise(d))
    return long_form(df.withColumn("augmentation_index", F.col("augmentation_index").cast("bigint")),
                     ["image_path", "augmentation_index"])


def q_aug_hflip(spark, sf):
    return _flip_query(spark, sf, "h")


def q_aug_vflip(spark, sf):
    return _flip_query(spark, sf, "v")


def q_aug_brightness(spark, sf):
    cfg = ALL_AUG_CFG
    df = _variants(spark, sf, cfg).withColumn("data", TN.normalize("data", "min_max", 0.0, 1.0))
    df = df.withColumn(
        "data",
        F.when(F.col("aug_brightness").isNotNull(), TN.brightness("data", F.col("aug_brightness"), 0.0, 1.0)).otherwise(
            F.col("data")
        ),
    )
    return long_form(df.withColumn("augmentation_index", F.col("augmentation_index").cast("bigint")),
                     ["image_path", "augmentation_index"])


# -- counts, metadata, statistics ---------------------------------------------------


def _record_keys(spark, sf, cfg=TILE_CFG) -> DataFrame:
    """(image_path, label, split, augmentation_index): the record key set
    without tensors (counts never need the pixels)."""
    df = _images(spark, sf, cfg).select("image_path", "label", "split")
    return AU.fan_out(df, cfg)


def q_split_counts(spark, sf):
    return ST.count_by(_record_keys(spark, sf), "split")


def q_label_counts(spark, sf):
    return ST.count_by(_record_keys(spark, sf), "label").select(_i64("label"), "n")


def q_metadata_counts(spark, sf):
    return ST.metadata_counts(_record_keys(spark, sf))


def q_metadata_summary(spark, sf):
    from ..operators.quality import summary_from_counts

    cfg = TILE_CFG
    p = labelled(spark, sf, cfg)
    files = p.select(F.col("path").alias("image_path"), "label", "split")
    return summary_from_counts(files, _record_keys(spark, sf, cfg), cfg)


def q_dataset_statistics(spark, sf):
    df = ST.dataset_statistics(_images(spark, sf), channels=1)
    return df.withColumn("label", F.col("label").cast("bigint"))


def q_dataset_statistics_kernel(spark, sf):
    df = ST.dataset_statistics(_images(spark, sf), channels=1, engine="kernel")
    return df.withColumn("label", F.col("label").cast("bigint"))


def q_batch_assign(spark, sf):
    """Seeded shuffle order (md5 key), bucketed global rank."""
    df = BT.assign_batches(_record_keys(spark, sf), TILE_CFG)
    return df.select("image_path", _i64("augmentation_index"), "split", "batch_id", "batch_pos")


def q_batch_assign_scaled(spark, sf):
    """Same ids with few, crowded buckets (16), so prefix offsets carry
    most of the rank: the form that matters when a split is huge."""
    df = BT.assign_batches(_record_keys(spark, sf), TILE_CFG, buckets=16)
    return df.select("image_path", _i64("augmentation_index"), "split", "batch_id", "batch_pos")


def q_batch_assign_ordered(spark, sf):
    """``shuffle: false``: path order, range-partitioned buckets."""
    df = BT.assign_batches(_record_keys(spark, sf), TILE_CFG.with_(shuffle=False), buckets=16)
    return df.select("image_path", _i64("augmentation_index"), _i64("label"), "split", "batch_id", "batch_pos")


def q_batch_collect(spark, sf):
    df = BT.assign_batches(_record_keys(spark, sf), TILE_CFG)
    b = BT.collect_batches(df, ["image_path", "augmentation_index"])
    members = F.transform("items", lambda s: F.concat_ws("#", s["image_path"], s["augmentation_index"].cast("string")))
    return b.select("split", "batch_id", F.col("batch_size").cast("bigint").alias("batch_size"),
                    F.array_join(members, ",").alias("members"))


# -- the whole chain ------------------------------------------------------------


def q_pipeline_records(spark, sf):
    df = PL.process(_images(spark, sf).drop("vec_id"), TILE_CFG, at_target_size=True)
    df = df.withColumn("augmentation_index", F.col("augmentation_index").cast("bigint")).withColumn(
        "label", F.col("label").cast("bigint")
    )
    return long_form(df, ["image_path", "augmentation_index", "split", "label"])


def q_pipeline_records_kernel(spark, sf):
    """The same chain on the fused NumPy engine (float32 records)."""
    df = PL.process(_images(spark, sf).drop("vec_id"), TILE_CFG, at_target_size=True, engine="kernel")
    ex = df.select(
        "image_path", _i64("augmentation_index"), "split", _i64("label"), F.posexplode("data").alias("pos", "value")
    )
    return ex.select(
        "image_path", "augmentation_index", "split", "label", _i64("pos"),
        TN.round6(F.col("value").cast("double")).alias("value"),
    )


QUERIES = {
    "label_encode": q_label_encode,
    "label_filter": q_label_filter,
    "split_extract": q_split_extract,
    "split_select": q_split_select,
    "ratio_split": q_ratio_split,
    "ratio_split_stratified": q_ratio_split_stratified,
    "scan_counts": q_scan_counts,
    "split_union": q_split_union,
    "limit_images": q_limit_images,
    "distinct_splits": q_distinct_splits,
    "reject_rows": q_reject_rows,
    "tensor_stats": q_tensor_stats,
    "norm_min_max": q_norm_min_max,
    "norm_z_score": q_norm_z_score,
    "norm_none": q_norm_none,
    "flatten_tensor": q_flatten_tensor,
    "nest_tensor": q_nest_tensor,
    "tensor_shape": q_tensor_shape,
    "to_rgb": q_to_rgb,
    "grayscale": q_grayscale,
    "resize_area": q_resize_area,
    "resize_area_frac": q_resize_area_frac,
    "resize_up": q_resize_up,
    "resize_mixed": q_resize_mixed,
    "gaussian_blur": q_gaussian_blur,
    "gaussian_blur_7": q_gaussian_blur_7,
    "median_blur_5": q_median_blur_5,
    "median_blur": q_median_blur,
    "kernel_rejects": q_kernel_rejects,
    "histogram": q_histogram,
    "histogram_dataset": q_histogram_dataset,
    "histogram_dataset_kernel": q_histogram_dataset_kernel,
    "features_json": q_features_json,
    "augment_fanout": q_augment_fanout,
    "aug_params": q_aug_params,
    "aug_rotate": q_aug_rotate,
    "aug_hflip": q_aug_hflip,
    "aug_vflip": q_aug_vflip,
    "aug_brightness": q_aug_brightness,
    "split_counts": q_split_counts,
    "label_counts": q_label_counts,
    "metadata_counts": q_metadata_counts,
    "metadata_summary": q_metadata_summary,
    "dataset_statistics": q_dataset_statistics,
    "dataset_statistics_kernel": q_dataset_statistics_kernel,
    "batch_assign": q_batch_assign,
    "batch_assign_scaled": q_batch_assign_scaled,
    "batch_assign_ordered": q_batch_assign_ordered,
    "batch_collect": q_batch_collect,
    "pipeline_records": q_pipeline_records,
    "pipeline_records_kernel": q_pipeline_records_kernel,
}
