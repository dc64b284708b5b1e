"""TFRecord files as a Spark Python Data Source (``format("tfrecord")``).

Write: the input has ``split string`` and either ``example binary`` (an
encoded message) or the record columns (``image_flattened``, ``label``,
``image_shape``, ``image_path``), which the writer encodes itself so the
tensors cross into Python once.  Each task frames its rows and appends them
to one file per split, ``{path}/{split}/part-{job}-{task}-{n}``, rolling to a
new shard when ``shardSizeMb`` is reached, optionally gzip-compressed, and
lists its shards in its own manifest part.  The job's commit publishes the
parts of the tasks that count (``sources.shardlog``); no file is moved.  Shards
of a task that died are named by no commit and so are never read; ``vacuum``
deletes them, and those of replaced versions.  Option ``epoch`` names the
commit: writing an epoch again replaces it; ``pending`` leaves it out of the
version until ``shardlog.show``.

Read: the manifest's shards in partitions of about ``PARTITION_BYTES``, planned
from the sizes in the commits; both CRCs and the number of records are checked,
messages decoded to columns.  ``raw=true`` returns the payload bytes instead,
``split`` reads one split, ``epochs`` (comma-separated) only those commits.  A
folder without a manifest is read by listing it.

Files are opened through ``pyarrow.fs`` so local paths, HDFS and object
stores share one code path.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from ..functions.example import decode_example, frame_records, read_records_stream
from . import shardlog

DECODED_SCHEMA = "image array<float>, label bigint, image_shape array<bigint>, image_path string, split string"
RAW_SCHEMA = "record binary, split string"


def fs_and_path(uri: str) -> tuple[pafs.FileSystem, str]:
    """Filesystem and path for a decoded (not percent-encoded) location."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    scheme, rest = uri.split("://", 1)
    netloc, _, path = rest.partition("/")
    fs, _ = pafs.FileSystem.from_uri(f"{scheme}://{netloc}/")
    return fs, f"{netloc}/{path}" if scheme in ("s3", "gs", "gcs") else "/" + path


#: bytes of shards that one read partition takes, if they are smaller than that
PARTITION_BYTES = 128 << 20


@dataclass
class ShardCommit(WriterCommitMessage):
    part: shardlog.Part | None


class TFRecordDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tfrecord"

    def schema(self) -> str:
        return RAW_SCHEMA if str(self.options.get("raw", "false")).lower() == "true" else DECODED_SCHEMA

    def reader(self, schema):
        return TFRecordReader(self.options, schema)

    def writer(self, schema, overwrite: bool):
        return TFRecordWriter(self.options, overwrite)


class ShardPartition(InputPartition):
    """Shards ``first`` to ``stop`` of a manifest part, or one file by its path."""

    def __init__(self, part: str | None, first: int, stop: int, path: str = "", split: str = ""):
        super().__init__((part, first, stop, path, split))
        self.part, self.first, self.stop, self.path, self.split = part, first, stop, path, split


def planned(parts: list[shardlog.Part], size: int = PARTITION_BYTES) -> list[ShardPartition]:
    """Consecutive shards of a part up to ``size`` bytes together, one at least."""
    out = []
    for p in parts:
        first, held = 0, 0
        for i, n in enumerate(p.sizes):
            if i > first and held + n > size:
                out.append(ShardPartition(p.name, first, i))
                first, held = i, 0
            held += n
        if p.sizes:
            out.append(ShardPartition(p.name, first, len(p.sizes)))
    return out


class TFRecordReader(DataSourceReader):
    def __init__(self, options, schema):
        self.root = options.get("path").rstrip("/")
        self.raw = str(options.get("raw", "false")).lower() == "true"
        self.verify = str(options.get("verifyCrc", "true")).lower() == "true"
        self.split = options.get("split")
        epochs = options.get("epochs")
        self.epochs = None if epochs is None else [e for e in epochs.split(",") if e]

    def partitions(self):
        fs, base = fs_and_path(self.root)
        info = fs.get_file_info(base)
        if info.type == pafs.FileType.File:
            return [self._whole(info.path)]
        version = shardlog.current(fs, base, self.epochs)
        if version is not None:
            return planned([p for c in version.values() for p in c.parts]) or [ShardPartition(None, 0, 0)]
        files = [
            f
            for f in fs.get_file_info(pafs.FileSelector(base, recursive=True))
            if f.type == pafs.FileType.File
            and "/_temporary" not in f.path
            and (f.path.endswith(".tfrecord") or f.path.endswith(".tfrecord.gz"))
        ]
        files.sort(key=lambda f: f.path)
        return [self._whole(f.path) for f in files]

    def _whole(self, path: str) -> ShardPartition:
        scheme = self.root.split("://", 1)[0] + "://" if "://" in self.root else ""
        return ShardPartition(None, 0, 0, scheme + path, path.rsplit("/", 2)[-2])

    def read(self, partition: ShardPartition):
        if partition.part is None:
            if partition.path and self.split in (None, partition.split):
                yield from self._read(partition.path, partition.split, None)
            return
        fs, base = fs_and_path(self.root)
        for s in shardlog.read_part(fs, base, partition.part)[partition.first : partition.stop]:
            if self.split in (None, s.split):
                yield from self._read(f"{self.root}/{s.path}", s.split, s.records)

    def _read(self, path: str, split: str, records: int | None):
        fs, p = fs_and_path(path)
        comp = "gzip" if p.endswith(".gz") else None
        n = 0
        with fs.open_input_stream(p, compression=comp) as f:
            batch = []
            for payload in read_records_stream(f, verify=self.verify):
                n += 1
                batch.append(payload)
                if len(batch) >= 64:
                    yield self._batch(batch, split)
                    batch = []
            if batch:
                yield self._batch(batch, split)
        if records is not None and n != records:
            raise ValueError(f"{path} holds {n} records, its manifest says {records}")

    def _batch(self, payloads: list[bytes], split: str) -> pa.RecordBatch:
        n = len(payloads)
        splits = pa.array([split] * n, type=pa.string())
        if self.raw:
            return pa.RecordBatch.from_arrays([pa.array(payloads, type=pa.binary()), splits], ["record", "split"])
        imgs, labels, shapes, paths = [], [], [], []
        for p in payloads:
            d = decode_example(p)
            raw = d.get("image", [b""])[0]
            imgs.append(np.frombuffer(raw, dtype="<f4"))
            labels.append(d.get("label", [None])[0])
            shapes.append(d.get("image_shape", []))
            paths.append(d.get("image_path", [b""])[0].decode("utf-8"))
        offs = np.zeros(n + 1, dtype=np.int32)
        np.cumsum([a.size for a in imgs], out=offs[1:])
        flat = np.concatenate(imgs) if imgs else np.zeros(0, dtype=np.float32)
        image = pa.ListArray.from_arrays(pa.array(offs), pa.array(np.ascontiguousarray(flat, dtype=np.float32)))
        return pa.RecordBatch.from_arrays(
            [image, pa.array(labels, type=pa.int64()), pa.array(shapes, type=pa.list_(pa.int64())),
             pa.array(paths, type=pa.string()), splits],
            ["image", "label", "image_shape", "image_path", "split"],
        )


class _OpenShard:
    def __init__(self, fs: pafs.FileSystem, root: str, path: str, split: str, gzip: bool):
        self.fs, self.path, self.split = fs, path, split
        self.size, self.records, self.digest = 0, 0, hashlib.blake2b(digest_size=16)
        self.full = fs_and_path(f"{root}/{path}")[1]
        fs.create_dir(self.full.rsplit("/", 1)[0], recursive=True)
        self.stream = fs.open_output_stream(self.full, compression="gzip" if gzip else None)

    def add(self, chunk: bytes, n: int) -> None:
        self.stream.write(chunk)
        self.digest.update(chunk)
        self.size += len(chunk)
        self.records += n

    def close(self) -> shardlog.Shard:
        self.stream.close()
        return shardlog.Shard(self.path, self.split, self.records, self.size, self.digest.hexdigest())


class TFRecordWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.root = options.get("path").rstrip("/")
        self.overwrite = overwrite
        comp = str(options.get("compression", "none")).lower()
        self.gzip = comp in ("gzip", "gz")
        self.shard_bytes = int(float(options.get("shardSizeMb", "100")) * (1 << 20))
        self.job = options.get("jobId") or uuid.uuid4().hex[:16]
        self.epoch = options.get("epoch") or self.job
        self.pending = str(options.get("pending", "false")).lower() == "true"

    def write(self, iterator) -> ShardCommit:
        fs, base = fs_and_path(self.root)
        task = uuid.uuid4().hex[:16]  # of this attempt
        ext = ".tfrecord.gz" if self.gzip else ".tfrecord"
        open_, done, made = {}, [], []

        def shard(split: str) -> _OpenShard:
            path = f"{split}/part-{self.job}-{task}-{len(made):05d}{ext}"
            made.append(fs_and_path(f"{self.root}/{path}")[1])
            return _OpenShard(fs, self.root, path, split, self.gzip)

        try:
            for batch in iterator:
                if batch.num_rows == 0:
                    continue
                if "example" in batch.schema.names:
                    ex = batch.column(batch.schema.get_field_index("example")).to_pylist()
                else:
                    from ..operators.encode import examples_from_batch

                    ex = examples_from_batch(batch)
                sp = batch.column(batch.schema.get_field_index("split")).to_pylist()
                by_split: dict[str, list[bytes]] = {}
                for e, s in zip(ex, sp):
                    by_split.setdefault(s if s is not None else "unknown", []).append(e)
                for s, payloads in by_split.items():
                    for i in range(0, len(payloads), 64):
                        some = payloads[i : i + 64]
                        chunk = frame_records(some)
                        if s in open_ and open_[s].size + len(chunk) > self.shard_bytes:
                            done.append(open_.pop(s).close())
                        if s not in open_:
                            open_[s] = shard(s)
                        open_[s].add(chunk, len(some))
            done += [o.close() for o in open_.values()]
            return ShardCommit(shardlog.write_part(fs, base, self.job, task, done) if done else None)
        except BaseException:  # a killed task leaves its shards to ``vacuum``
            for o in open_.values():
                o.stream.close()
            for path in made:
                if fs.get_file_info(path).type == pafs.FileType.File:
                    fs.delete_file(path)
            raise

    def commit(self, messages) -> None:
        """The parts of the tasks that count become the version, or part of it."""
        fs, base = fs_and_path(self.root)
        parts = [m.part for m in messages if m is not None and m.part is not None]
        shardlog.add(fs, base, self.epoch, self.overwrite, parts, self.pending)

    def abort(self, messages) -> None:
        """Nothing was published."""


def shards(spark, root: str, epochs: list[str] | None = None):
    """(path, split, records, bytes, digest) of the version's shards: the parts
    are read in tasks."""
    from ..session import ship_package

    ship_package(spark)
    fs, base = fs_and_path(root.rstrip("/"))
    version = shardlog.current(fs, base, epochs) or {}
    names = [(p.name,) for c in version.values() for p in c.parts]
    schema = "path string, split string, records bigint, bytes bigint, digest string"

    def run(batches):
        fs, base = fs_and_path(root.rstrip("/"))
        for b in batches:
            for name in b.column(0).to_pylist():
                rows = [s.__dict__ for s in shardlog.read_part(fs, base, name)]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("path", pa.string()), ("split", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("digest", pa.string())]))

    parts = spark.createDataFrame(names, "part string")
    return parts.repartition(max(1, min(len(names), 256))).mapInArrow(run, schema)


def vacuum(spark, root: str) -> int:
    """Delete the shards that the current version doesn't name: those of replaced
    versions and of tasks that died.  Folders are listed and files deleted in
    tasks; not while another job writes there.  Returns the number deleted."""
    from pyspark.sql import functions as F

    root = root.rstrip("/")
    fs, base = fs_and_path(root)
    if shardlog.current(fs, base) is None:
        return 0
    folders = [(f.base_name,) for f in fs.get_file_info(pafs.FileSelector(base)) if f.type == pafs.FileType.Directory and not f.base_name.startswith("_")]

    def listed(batches):
        fs, base = fs_and_path(root)
        for b in batches:
            for split in b.column(0).to_pylist():
                found = fs.get_file_info(pafs.FileSelector(f"{base}/{split}"))
                yield pa.RecordBatch.from_arrays([pa.array([f"{split}/{f.base_name}" for f in found if f.type == pafs.FileType.File], pa.string())], ["path"])

    def deleted(batches):
        fs, base = fs_and_path(root)
        for b in batches:
            for path in b.column(0).to_pylist():
                if fs.get_file_info(f"{base}/{path}").type == pafs.FileType.File:  # a retried task finds some gone
                    fs.delete_file(f"{base}/{path}")
            yield b

    keep = shards(spark, root).select("path").where(F.col("path").isNotNull())
    found = spark.createDataFrame(folders, "split string").repartition(max(1, len(folders))).mapInArrow(listed, "path string")
    return found.join(keep, "path", "left_anti").mapInArrow(deleted, "path string").count()


def register(spark) -> None:
    spark.dataSource.register(TFRecordDataSource)
