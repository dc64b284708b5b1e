"""TFRecord sink / source round trips, sharding, gzip, corrupt CRC."""

import glob
import hashlib
import os
import struct

import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.plans import catalog as C
from tessera.plans import pipeline as PL
from tessera.plans import sinks
from tessera.sources import shardlog
from tessera.sources import tfrecord as TFR


def records(spark):
    imgs = C._images(spark, SF_SMALL).drop("vec_id")
    return PL.to_records(PL.process(imgs, C.TILE_CFG, at_target_size=True), C.TILE_CFG)


def test_roundtrip_sharded_gzip(spark, workdir):
    rec = records(spark)
    cfg = C.TILE_CFG.with_(tfrecord_compression="gzip", tfrecord_shard_size_mb=0.005)
    sinks.write_tfrecords(rec, workdir + "/tf", cfg)
    files = glob.glob(workdir + "/tf/*/*.tfrecord.gz")
    assert len(files) > len({os.path.dirname(f) for f in files})  # rolled shards
    assert not os.path.exists(workdir + "/tf/_temporary")
    back = sinks.read_tfrecords(spark, workdir + "/tf")
    assert back.count() == rec.count()
    a = rec.select("image_path", "split", F.col("label").cast("bigint"), "image_flattened")
    b = back.select("image_path", "split", "label", F.col("image").alias("image_flattened"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_overwrite_replaces(spark, workdir):
    rec = records(spark)
    root = workdir + "/tf"
    sinks.write_tfrecords(rec, root, C.TILE_CFG)
    sinks.write_tfrecords(rec.where("split = 'train'"), root, C.TILE_CFG)
    n = rec.where("split = 'train'").count()
    assert sinks.read_tfrecords(spark, root).count() == n
    assert TFR.vacuum(spark, root) > 0 and TFR.vacuum(spark, root) == 0
    assert {os.path.dirname(f) for f in glob.glob(root + "/*/*.tfrecord")} == {root + "/train"}
    assert sinks.read_tfrecords(spark, root).count() == n


def test_manifest_rows(spark, workdir):
    """Every shard with its split, records, bytes and digest; the reader takes
    one split, and notices records that are missing."""
    rec = records(spark)
    root = workdir + "/tf"
    sinks.write_tfrecords(rec, root, C.TILE_CFG.with_(tfrecord_shard_size_mb=0.005))
    rows = TFR.shards(spark, root).collect()
    assert sorted(r.path for r in rows) == sorted(os.path.relpath(f, root) for f in glob.glob(root + "/*/*.tfrecord"))
    for r in rows:
        data = open(f"{root}/{r.path}", "rb").read()
        assert len(data) == r.bytes and hashlib.blake2b(data, digest_size=16).hexdigest() == r.digest
    assert sum(r.records for r in rows) == rec.count()
    train = spark.read.format("tfrecord").option("split", "train").load(root)
    assert train.count() == rec.where("split = 'train'").count() and train.where("split <> 'train'").isEmpty()
    short = max(rows, key=lambda r: r.records)
    data = open(f"{root}/{short.path}", "rb").read()
    (size,) = struct.unpack("<Q", data[:8])
    open(f"{root}/{short.path}", "wb").write(data[: 16 + size])  # whole records, but fewer
    with pytest.raises(Exception, match="manifest"):
        sinks.read_tfrecords(spark, root).count()


def test_an_epoch_written_again_replaces_itself(spark, workdir):
    """Pending epochs are read by name only; shown, they are part of the version."""
    rec = records(spark)
    root = workdir + "/tf"

    def splits(**kw):
        return {r.split for r in sinks.read_tfrecords(spark, root, **kw).select("split").distinct().collect()}

    sinks.write_tfrecords(rec.where("split = 'train'"), root, C.TILE_CFG)
    for part in ("split = 'test'", "split = 'validation'"):
        sinks.write_tfrecords(rec.where(part), root, C.TILE_CFG, append=True, epoch="b")
    assert splits() == {"train"} and splits(epochs=["b"]) == {"validation"}
    for _ in range(2):
        sinks.show_examples(root, "b")
    assert splits() == {"train", "validation"}
    sinks.show_examples(root, "none")
    sinks.write_tfrecords(rec.where("split = 'test'"), root, C.TILE_CFG, append=True, epoch="c")
    sinks.show_examples(root, "c", replaces=True)
    assert splits() == {"test"}


def test_partitions_follow_the_sizes():
    parts = [shardlog.Part("j/t.json", (5, 5, 9, 30, 1), 5), shardlog.Part("j/u.json", (), 0)]
    assert [(p.first, p.stop) for p in TFR.planned(parts, 10)] == [(0, 2), (2, 3), (3, 4), (4, 5)]


def test_corrupt_crc_fails(spark, workdir):
    rec = records(spark).limit(5)
    sinks.write_tfrecords(rec, workdir + "/tf", C.TILE_CFG)
    f = sorted(glob.glob(workdir + "/tf/*/*.tfrecord"))[0]
    data = bytearray(open(f, "rb").read())
    data[20] ^= 0x55
    open(f, "wb").write(bytes(data))
    with pytest.raises(Exception, match="CRC"):
        sinks.read_tfrecords(spark, workdir + "/tf").count()


def test_examples_parquet(spark, workdir):
    rec = records(spark)
    sinks.write_examples_parquet(rec, workdir + "/ex")
    ex = spark.read.parquet(workdir + "/ex")
    assert ex.columns == ["tfrecord", "split"] and ex.count() == rec.count()


class Killed(Exception):
    pass


@pytest.mark.parametrize("step", ["create_dir", "open_output_stream", "move", None])
def test_a_killed_commit_leaves_one_version(tmp_path, step):
    """Killed at any step of the file system, the old version or the new one is
    what a reader plans, and never both."""
    root = str(tmp_path / "tf")

    def written(n: int) -> TFR.TFRecordWriter:
        w = TFR.TFRecordWriter({"path": root, "compression": "none"}, overwrite=True)
        batch = pa.RecordBatch.from_pydict({"example": [b"x%d" % k for k in range(n)], "split": ["train"] * n})
        w.messages = [w.write(iter([batch]))]
        return w

    def version() -> list[int]:
        reader = TFR.TFRecordReader({"path": root, "raw": "true"}, None)
        return [sum(b.num_rows for p in reader.partitions() for b in reader.read(p))]

    old = written(3)
    old.commit(old.messages)
    new = written(5)
    assert version() == [3]  # written, not committed

    class Failing:
        def __getattr__(self, name):
            if name == step:
                raise Killed(name)
            return getattr(pafs.LocalFileSystem(), name)

    real = TFR.fs_and_path
    if step:
        TFR.fs_and_path = lambda uri: (Failing(), real(uri)[1])
        try:
            with pytest.raises(Killed):
                new.commit(new.messages)
        finally:
            TFR.fs_and_path = real
        assert version() == [3]
        new.commit(new.messages)
    else:
        new.commit(new.messages)
    assert version() == [5]


def test_a_folder_without_a_manifest_is_listed(spark, workdir):
    import shutil

    rec = records(spark)
    sinks.write_tfrecords(rec, workdir + "/tf", C.TILE_CFG)
    shutil.copytree(workdir + "/tf", workdir + "/plain", ignore=shutil.ignore_patterns("_manifest"))
    assert sinks.read_tfrecords(spark, workdir + "/plain").count() == rec.count()
