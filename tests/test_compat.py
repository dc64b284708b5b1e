"""Compatibility switches and pipeline options."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.config import PipelineConfig, from_dict
from tessera.functions import labels as LB
from tessera.plans import catalog as C
from tessera.plans import pipeline as PL


def test_label_match_parent_dir(spark):
    df = spark.createDataFrame(
        [("a/ABNORMAL_CASES/NORMAL/x.png",), ("a/NORMAL/PNEUMONIA/y.png",), ("a/train/normal/z.png",)], "p string"
    )
    whole = [r[0] for r in df.select(LB.label_expr("p", PipelineConfig())).collect()]
    strict = [r[0] for r in df.select(LB.label_expr("p", PipelineConfig(label_match="parent_dir"))).collect()]
    assert whole == [0, 0, 0]  # first configured class found anywhere in the path wins
    assert strict == [0, 1, 0]


def test_split_with_backslashes(spark):
    df = spark.createDataFrame([("C:\\\\data\\\\val\\\\NORMAL\\\\a.png",), ("x/holdout/a.png",)], "p string")
    assert [r[0] for r in df.select(LB.split_expr("p")).collect()] == ["validation", "unknown"]


def _hist_rows(spark, cfg):
    imgs = C._images(spark, SF_SMALL).drop("vec_id").withColumn(
        "data", F.transform("data", lambda x: F.floor((x + 1.0) * 127.5).cast("double"))
    )
    return PL.process(imgs, cfg, at_target_size=True).where("augmentation_index = 0").select("features").limit(5).collect()


@pytest.mark.parametrize("engine", ["native", "kernel"])
def test_histogram_stage_pre_and_post(spark, engine):
    base = C.TILE_CFG.with_(features=True, feature_methods=("histogram",), engine=engine)
    pre = _hist_rows(spark, base)
    post = _hist_rows(spark, base.with_(histogram_stage="post"))
    for r in pre:
        h = r.features["histogram_channel_0"]
        assert len(h) == 256 and sum(h) == 64
    for r in post:  # min-max output lies in [0, 1]: bins 0 and 1 only
        h = r.features["histogram_channel_0"]
        assert sum(h) == 64 and sum(h[2:]) == 0


@pytest.mark.parametrize("engine", ["native", "kernel"])
def test_brightness_u8_compat_collapses_to_levels(spark, engine):
    cfg = C.TILE_CFG.with_(brightness_mode="u8_compat", engine=engine, rotation_range=0.0)
    out = PL.process(C._images(spark, SF_SMALL).drop("vec_id"), cfg, at_target_size=True)
    vals = out.where("augmentation_index > 0").select(F.explode("data").alias("v")).select("v").distinct().collect()
    assert {float(r.v) for r in vals} <= {0.0, 1.0}


def test_ratio_split_assignment_in_pipeline(spark):
    cfg = C.TILE_CFG.with_(split_assignment="ratio")
    imgs = C._images(spark, SF_SMALL, cfg)
    splits = {r.split for r in imgs.select("split").distinct().collect()}
    assert "unknown" not in splits and splits <= {"train", "validation", "test"}
    kept = imgs.where(~F.col("image_path").contains("/holdout/"))
    folder = kept.select(LB.split_expr("image_path").alias("f"), "split").where("f <> split").count()
    assert folder == 0  # existing folders preserved


def test_engines_agree_on_z_score_with_denoise(spark):
    cfg = C.TILE_CFG.with_(normalization="z_score", denoise=True, denoise_method="median", kernel_size=3)
    imgs = C._images(spark, SF_SMALL).drop("vec_id")
    a = PL.process(imgs, cfg.with_(engine="native"), at_target_size=True)
    b = PL.process(imgs, cfg.with_(engine="kernel"), at_target_size=True)
    ka = {(r.image_path, r.augmentation_index): np.array(r.data) for r in a.collect()}
    kb = {(r.image_path, r.augmentation_index): np.array(r.data) for r in b.collect()}
    assert ka.keys() == kb.keys()
    assert all(np.allclose(ka[k], kb[k], atol=1e-5) for k in ka)


def test_yaml_layout_all_sections():
    y = {
        "image_processing": {
            "target_width": 64, "target_height": 32, "color_space": "GRAYSCALE",
            "normalization": {"method": "z_score"},
            "augmentation": {"enabled": True, "rotation_range": 15, "horizontal_flip": True,
                             "vertical_flip": False, "brightness_range": [0.8, 1.2], "augmentation_factor": 3},
            "denoising": {"enabled": True, "method": "median", "kernel_size": 5},
            "feature_extraction": {"enabled": True, "methods": ["histogram", "edges"]},
            "batching": {"batch_size": 16, "shuffle": False, "seed": 7},
        },
        "data_splits": {"train": 0.8, "validation": 0.1, "test": 0.1, "preserve_existing_splits": False},
        "label_encoding": {"NORMAL": 0, "PNEUMONIA": 1, "COVID": 2},
        "output_formats": {"tfrecord": {"enabled": False}, "parquet": {"compression": "zstd", "row_group_size_mb": 64}},
        "versioning": {"version_tag": "v9", "metadata_file": "meta.json", "track_statistics": True},
        "processing": {"num_partitions": 50},
    }
    c = from_dict(y)
    assert (c.target_width, c.target_height, c.out_channels, c.fanout) == (64, 32, 1, 4)
    assert c.batch_size == 16 and not c.shuffle and c.seed == 7 and c.split_train == 0.8
    assert c.label_encoding[-1] == ("COVID", 2) and not c.tfrecord_enabled and c.parquet_compression == "zstd"
    assert c.metadata_file == "meta.json" and c.track_statistics and c.num_partitions == 50
    assert json.loads(json.dumps(c.as_dict()))["target_width"] == 64


def test_yaml_engine_section():
    c = from_dict({"tessera": {"engine": "native", "brightness_mode": "u8_compat", "histogram_stage": "post",
                               "label_match": "parent_dir", "keep_nested_array": True, "extensions": ["PNG"],
                               "split_folders": ["train"]},
                   "data_splits": {"assignment": "ratio"}})
    assert (c.engine, c.brightness_mode, c.histogram_stage, c.label_match) == ("native", "u8_compat", "post", "parent_dir")
    assert c.keep_nested_array and c.extensions == ("png",) and c.split_folders == ("train",)
    assert c.split_assignment == "ratio"
    with pytest.raises(ValueError):
        from_dict({"tessera": {"engine": "gpu"}})
