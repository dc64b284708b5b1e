"""Driver-free units: CRC-32C, example messages, framing, kernels, config."""

import hashlib
import struct

import numpy as np
import pytest

from tessera.config import default_config, from_dict
from tessera.functions.crc32c import TABLE, crc32c, crc32c_many
from tessera.functions.example import decode_example, encode_example, frame_records, read_records
from tessera.operators import kernels as K


def slow_crc(b: bytes) -> int:
    c = 0xFFFFFFFF
    for x in b:
        c = int(TABLE[(c ^ x) & 0xFF]) ^ (c >> 8)
    return c ^ 0xFFFFFFFF


def test_crc32c_check_value():
    assert crc32c(b"123456789") == 0xE3069283


@pytest.mark.parametrize("n", [0, 1, 3, 63, 64, 65, 511, 4097])
def test_crc32c_matches_bytewise(n):
    rng = np.random.default_rng(n)
    msgs = [rng.integers(0, 256, size=n + k, dtype=np.uint8).tobytes() for k in range(3)]
    assert [int(x) for x in crc32c_many(msgs)] == [slow_crc(m) for m in msgs]


def test_example_roundtrip():
    img = np.arange(12, dtype=np.float32) / 7
    b = encode_example(img, 1, [2, 2, 3], "a/b c.png")
    d = decode_example(b)
    assert np.frombuffer(d["image"][0], dtype="<f4").tolist() == img.tolist()
    assert d["label"] == [1] and d["image_shape"] == [2, 2, 3] and d["image_path"] == [b"a/b c.png"]


def test_framing_roundtrip_and_corruption():
    payloads = [b"x" * 10, b"", b"hello world" * 50]
    data = frame_records(payloads)
    assert list(read_records(data)) == payloads
    bad = bytearray(data)
    bad[12 + 3] ^= 0xFF  # flip a payload byte of the first record
    with pytest.raises(ValueError, match="CRC"):
        list(read_records(bytes(bad)))
    # header layout: u64 length little-endian
    assert struct.unpack_from("<Q", data, 0)[0] == 10


def test_resize_weights_rows_sum_to_one():
    for n, m in [(8, 4), (8, 5), (224, 8), (5, 8), (3, 224)]:
        w = K.resize_weights(n, m)
        assert np.allclose(w.sum(axis=1), 1.0)


def test_resize_mean_of_blocks():
    img = np.arange(64, dtype=float).reshape(1, 8, 8, 1)
    out = K.resize(img, 4, 4)
    exp = img.reshape(4, 2, 4, 2).mean(axis=(1, 3))
    assert np.allclose(out[0, :, :, 0], exp)


def test_rotate_zero_is_identity_and_nan_skips():
    rng = np.random.default_rng(0)
    img = rng.random((3, 6, 7, 3))
    assert np.allclose(K.rotate(img, np.array([0.0, np.nan, 0.0])), img)


def test_rotate_180_about_centre():
    img = np.zeros((1, 8, 8, 1))
    img[0, 5, 5, 0] = 1.0  # (x=5, y=5) maps to (3, 3) around centre (4, 4)
    out = K.rotate(img, np.array([180.0]))
    assert np.isclose(out[0, 3, 3, 0], 1.0)


def test_gaussian_constant_and_median():
    img = np.full((2, 5, 5, 3), 7.0)
    assert np.allclose(K.gaussian_blur(img, 3), 7.0)
    assert np.allclose(K.gaussian_blur(img, 7), 7.0)
    x = np.zeros((1, 3, 3, 1))
    x[0, 1, 1, 0] = 9
    assert K.median_blur(x, 3)[0, 1, 1, 0] == 0


def test_histogram_sums_to_pixels():
    rng = np.random.default_rng(1)
    img = rng.integers(0, 256, (4, 5, 6, 3)).astype(float)
    img[0, 0, 0, 0] = 300  # out of range: ignored
    h = K.histogram(img)
    assert h.shape == (4, 3, 256)
    assert h[1].sum() == 5 * 6 * 3 and h[0].sum() == 5 * 6 * 3 - 1


def test_config_defaults_and_validation():
    c = default_config()
    assert c.augmentation and c.normalization == "min_max" and c.fanout == 3
    y = from_dict({"image_processing": {"denoising": {"enabled": True, "kernel_size": 3},
                                        "augmentation": {"enabled": True, "brightness_range": [0.8, 1.2]}},
                   "output_formats": {"tfrecord": {"compression": "GZIP", "shard_size_mb": 100}}})
    assert y.denoise and y.brightness_range == (0.8, 1.2) and y.tfrecord_compression == "gzip"
    with pytest.raises(ValueError):
        from_dict({"image_processing": {"denoising": {"enabled": True, "kernel_size": 4}}})


def test_md5_uniform_definition():
    from tessera.functions.random import TWO_32

    h = hashlib.md5(b"42|abc").hexdigest()
    assert int(h[:8], 16) / TWO_32 == pytest.approx(0.7727144553791732)


def test_fused_stage_skips_malformed_rows():
    import pyarrow as pa

    from tessera.config import default_config
    from tessera.operators.fused import _stage

    cfg = default_config().with_(target_width=4, target_height=4, augmentation=False)
    good = np.arange(6 * 6 * 3, dtype=np.uint8).tobytes()
    vt = pa.struct([("angle", pa.float64()), ("hflip", pa.bool_()), ("vflip", pa.bool_()), ("brightness", pa.float64())])
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["a.png", "bad.png", "c.png"]), pa.array(["train"] * 3), pa.array([0] * 3, type=pa.int32()),
         pa.array([6, 6, 6], type=pa.int32()), pa.array([6, 6, 6], type=pa.int32()), pa.array([3, 3, 3], type=pa.int32()),
         pa.array([good, good[:10], good], type=pa.binary()), pa.array([[], [], []], type=pa.list_(vt))],
        ["image_path", "split", "label", "height", "width", "channels", "data", "variants"],
    )
    out = list(_stage(cfg, True, True, True, False)([batch]))
    paths = [p for b in out for p in b.column(0).to_pylist()]
    assert sorted(paths) == ["a.png", "c.png"]
