"""File-level behaviour on generated image trees (PNG via zlib, JPEG via
the JVM's ImageIO)."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from imagefiles import png_bytes, write, write_jpeg
from tessera.config import default_config
from tessera.plans.run import config_path, processed_path, raw_path, run_pipeline
from tessera.sources import files as FS


@pytest.fixture(scope="module")
def tree(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("raw"))
    raw = raw_path(d, "v1.0")
    rng = np.random.default_rng(0)
    px = {}
    px["a"] = rng.integers(0, 256, (4, 5)).astype(np.uint8)
    px["b"] = rng.integers(0, 256, (4, 5, 3)).astype(np.uint8)
    px["c"] = rng.integers(0, 256, (4, 5, 4)).astype(np.uint8)
    write(f"{raw}/train/NORMAL/a.png", png_bytes(px["a"]))
    write(f"{raw}/train/PNEUMONIA/b.png", png_bytes(px["b"]))
    write(f"{raw}/val/NORMAL/c.png", png_bytes(px["c"]))
    write(f"{raw}/test/OTHER/d.png", png_bytes(rng.integers(0, 256, (4, 5)).astype(np.uint8)))
    write(f"{raw}/train/NORMAL/gray16.png", png_bytes(np.array([[0x1234, 0xABCD]]), bit_depth=16))
    write(f"{raw}/train/NORMAL/sp ace.png", png_bytes(rng.integers(0, 256, (3, 3)).astype(np.uint8)))
    write(f"{raw}/test/PNEUMONIA/pal.png", png_bytes(np.array([[0, 1], [1, 0]]), palette=np.array([[10, 20, 30], [200, 100, 50]])))
    write(f"{raw}/test/PNEUMONIA/bad.png", b"junk")
    write(f"{raw}/validation/NORMAL/F.PNG", png_bytes(rng.integers(0, 256, (6, 6, 3)).astype(np.uint8)))
    write(f"{raw}/holdout/NORMAL/g.png", png_bytes(rng.integers(0, 256, (2, 2)).astype(np.uint8)))
    write_jpeg(spark, f"{raw}/train/NORMAL/e.jpeg", np.full((6, 6, 3), 128, dtype=np.uint8))
    return d, raw, px


def test_decode_channels_and_order(spark, tree):
    _, raw, px = tree
    imgs = FS.read_images(spark, raw, default_config())
    by = {os.path.basename(r.image_path): r for r in imgs.collect()}
    assert by["a.png"].channels == 1 and by["b.png"].channels == 3 and by["c.png"].channels == 4
    assert by["bad.png"].height == -1
    assert "sp ace.png" in by and by["sp ace.png"].image_path.startswith("file:/") and "%20" not in by["sp ace.png"].image_path
    assert "F.PNG" in by and "g.png" not in by  # holdout is not a split folder
    b = np.frombuffer(by["b.png"].data, dtype=np.uint8).reshape(4, 5, 3)
    assert np.array_equal(b[:, :, ::-1], px["b"])  # stored B,G,R
    pal = np.frombuffer(by["pal.png"].data, dtype=np.uint8).reshape(2, 2, 3)
    assert list(pal[0, 0]) == [30, 20, 10]


def test_listing_reads_no_content_and_counts(spark, tree):
    _, raw, _ = tree
    files = FS.list_files(spark, raw, default_config())
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1][:80]
    assert files.count() == 10  # holdout is not a split folder


def test_recursive_scan_finds_holdout(spark, tree):
    _, raw, _ = tree
    lab = FS.labelled_files(FS.list_files(spark, raw, default_config(), recursive=True), default_config())
    splits = {os.path.basename(r.image_path): r.split for r in lab.collect()}
    assert splits["g.png"] == "unknown" and splits["c.png"] == "validation" and splits["F.PNG"] == "validation"


def test_empty_input_raises(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing to read"):
        FS.list_files(spark, str(tmp_path / "nothing"), default_config())


def test_full_run(spark, tree, tmp_path):
    d, raw, px = tree
    cfg = default_config().with_(target_width=4, target_height=4, track_statistics=True, augmentation_factor=2,
                                 rotation_range=10.0, horizontal_flip=True, brightness_range=(0.8, 1.2))
    res = run_pipeline(spark, raw, processed_path(str(tmp_path), "v1.0"), cfg)
    doc = json.load(open(res.metadata))
    assert doc["total_files"] == 10 and doc["total_images"] == 9 and doc["processed_images"] == 21
    assert doc["splits"] == {"test": 3, "train": 12, "validation": 6} and doc["rejected_images"] == 2
    assert doc["image_shape"] == [4, 4] and "statistics" in doc
    # the original's document keys, with splits / labels as objects
    for k in ("version", "total_images", "processed_images", "splits", "labels", "config", "image_shape",
              "processing_parameters"):
        assert k in doc, k
    assert set(doc["processing_parameters"]) == {"normalization", "augmentation", "denoising"}
    assert doc["labels"] == {"0": 15, "1": 6} and doc["version"] == "v1.0"
    rec = spark.read.parquet(res.parquet)
    assert rec.where(F.size("image_flattened") != 48).count() == 0
    assert [r.image_shape for r in rec.select("image_shape").distinct().collect()] == [[4, 4, 3]]
    rj = {os.path.basename(r.image_path): r.reason for r in spark.read.parquet(res.rejects).collect()}
    assert rj == {"bad.png": "decode_error", "gray16.png": "bit_depth", "d.png": "unknown_class"}
    # min-max range on originals, seeded variants differ from originals
    orig = rec.where("augmentation_index = 0").select(F.array_min("image_flattened").alias("lo"), F.array_max("image_flattened").alias("hi")).collect()
    assert all(r.lo == 0.0 and abs(r.hi - 1.0) < 1e-6 for r in orig if r.hi > 0)
    ex = spark.read.format("tfrecord").load(res.tfrecords)
    assert ex.count() == 21
    bt = spark.read.parquet(res.batches)
    assert bt.count() == 21 and bt.groupBy("split", "batch_id").count().where("count > 32").count() == 0
    # gray input becomes three equal channels
    a = rec.where(F.col("image_path").endswith("/a.png") & (F.col("augmentation_index") == 0)).first()
    v = np.array(a.image_flattened).reshape(4, 4, 3)
    assert np.allclose(v[..., 0], v[..., 1]) and np.allclose(v[..., 1], v[..., 2])


def test_assembled_batches(spark, tree, tmp_path):
    _, raw, _ = tree
    cfg = default_config().with_(target_width=4, target_height=4, tfrecord_enabled=False, batch_size=4,
                                 assemble_batches=True)
    res = run_pipeline(spark, raw, str(tmp_path / "ab"), cfg)
    bt = spark.read.parquet(str(tmp_path / "ab" / "batch_tensors"))
    rows = bt.collect()
    assert sum(r.batch_size for r in rows) == 21 and max(r.batch_size for r in rows) <= 4
    for r in rows:
        assert [m.batch_pos for m in r["items"]] == list(range(r.batch_size))
        assert all(len(m.image_flattened) == 48 for m in r["items"])


def test_max_images_limit(spark, tree, tmp_path):
    _, raw, _ = tree
    cfg = default_config().with_(target_width=4, target_height=4, tfrecord_enabled=False)
    res = run_pipeline(spark, raw, str(tmp_path / "out"), cfg, max_images=3)
    assert res.document["total_files"] == 3


def test_cli_stream_and_refresh(spark, tree, tmp_path):
    from tessera.plans.cli import main

    _, raw, _ = tree
    out = str(tmp_path / "cli")
    assert main(["--raw-path", raw, "--output-path", out, "--stream", "--checkpoint", str(tmp_path / "ck")]) == 0
    doc = json.load(open(out + "/metadata.json"))
    assert doc["processed_images"] == 21 and doc["total_images"] == 9


def test_split_folders_narrow_the_scan(spark, tree):
    _, raw, _ = tree
    cfg = default_config().with_(split_folders=("train",))
    paths = [r.path for r in FS.list_files(spark, raw, cfg).collect()]
    assert paths and all("/train/" in p for p in paths)


def test_cli_batch_run_with_validation(spark, tree, tmp_path, capsys):
    from tessera.plans.cli import main

    _, raw, _ = tree
    out = str(tmp_path / "cli-batch")
    assert main(["--raw-path", raw, "--output-path", out, "--validate", "--no-tensor-check"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    checks = {d["check"]: d["ok"] for d in lines if "check" in d}
    assert checks and all(checks.values())


def test_paths():
    assert raw_path("gs://b/", "v2") == "gs://b/raw/v2"
    assert processed_path("/x", "v1.0") == "/x/processed/v1.0"
    assert config_path("/x") == "/x/config/pipeline_config.yaml"


def test_config_from_hadoop_path(spark, tmp_path):
    from tessera.config import load_config

    p = tmp_path / "c.yaml"
    p.write_text("image_processing:\n  target_width: 32\n  normalization:\n    method: z_score\n")
    c = load_config(spark, str(p))
    assert c.target_width == 32 and c.normalization == "z_score" and c.target_height == 224
