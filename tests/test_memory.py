"""Worker memory of the image stages is bounded by chunks, not by batches."""

import tracemalloc

import numpy as np
import pyarrow as pa

from tessera.config import PipelineConfig
from tessera.operators import kernels as K
from tessera.operators.fused import _stage


def _batch(n: int, size: int) -> pa.RecordBatch:
    values = np.random.default_rng(0).random(n * size * size * 3) * 255
    data = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * size * size * 3), pa.array(values))
    variant = [{"angle": 10.0, "hflip": True, "vflip": False, "brightness": 1.1}] * 2
    cols = {
        "image_path": pa.array([f"p{i}" for i in range(n)]), "split": pa.array(["train"] * n), "label": pa.array([0] * n, pa.int32()),
        "height": pa.array([size] * n, pa.int32()), "width": pa.array([size] * n, pa.int32()), "channels": pa.array([3] * n, pa.int32()),
        "data": data, "variants": pa.array([variant] * n),
    }
    return pa.RecordBatch.from_arrays(list(cols.values()), list(cols.keys()))


def test_fused_stage_stays_small_when_images_grow():
    cfg = PipelineConfig(augmentation=True, augmentation_factor=2, rotation_range=15.0, horizontal_flip=True, brightness_range=(0.8, 1.2))
    run, rows, largest = _stage(cfg, True, False, True, False), 0, 0
    batch = _batch(200, 32)
    tracemalloc.start()
    for out in run(iter([batch])):
        rows += out.num_rows
        largest = max(largest, out.nbytes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 600
    assert largest < 20 << 20 and peak < 500 << 20


def test_median_in_parts_equals_the_whole(monkeypatch):
    imgs = np.random.default_rng(1).random((3, 9, 7, 2))
    whole = K.median_blur(imgs, 5)
    for limit in (1, 20_000, 60_000):
        monkeypatch.setattr(K, "_MEDIAN_BYTES", limit)
        assert (K.median_blur(imgs, 5) == whole).all()


def test_seven_tap_row_and_two_tap_resize():
    assert K.gaussian_taps(7).sum() == 1
    w = K.resize_weights(4, 8, area=False)
    assert np.allclose(w.sum(1), 1) and w[0, 0] == 1 and w[7, 3] == 1
    assert np.allclose(K.resize(np.full((1, 5, 5, 1), 3.0), 9, 2), 3.0)
