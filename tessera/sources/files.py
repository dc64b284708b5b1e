"""Image files: listing, decoding, header probes and rejects.

* Listing uses the ``binaryFile`` source with only ``path``/``length``
  selected, so no file content is read (column pruning).
* Decoding uses Spark's built-in ``image`` source (JVM codecs); invalid
  files come back with height -1 (``dropInvalid=false``) so they can be
  accounted for instead of vanishing.
* One brace glob covers every split folder and extension; a missing member
  of the brace does not fail the scan.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PipelineConfig
from ..functions import labels as LB
from ..session import ship_package
from .tfrecord import fs_and_path


def extension_glob(cfg: PipelineConfig) -> str:
    exts = []
    for e in cfg.extensions:
        for v in (e.lower(), e.upper()):
            if v not in exts:
                exts.append(v)
    return "*.{" + ",".join(exts) + "}"


def image_glob(root: str, cfg: PipelineConfig) -> str:
    """``{root}/{train,val,validation,test}/*``: the class folders.  The
    extension test is the reader's ``pathGlobFilter``; globbing down to the
    files would make every file a root path of the file index (and above
    32 roots Spark starts a listing job with one task per file)."""
    return f"{root.rstrip('/')}/{{{','.join(cfg.split_folders)}}}/*"


def _reader(spark: SparkSession, fmt: str, cfg: PipelineConfig, recursive: bool):
    r = spark.read.format(fmt).option("pathGlobFilter", extension_glob(cfg))
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r


def _nothing(root: str) -> str:
    return f"nothing to read: {root} has no file in the configured split folders with an accepted extension"


def escape_glob(path: str) -> str:
    """A literal path as a load path: the reader takes load paths as globs."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _load(reader, root: str, cfg: PipelineConfig, recursive: bool) -> DataFrame:
    target = root if recursive else image_glob(root, cfg)
    try:
        return reader.load(target)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise ValueError(_nothing(root)) from e
        raise


def list_files(spark: SparkSession, root: str, cfg: PipelineConfig, *, recursive: bool = False) -> DataFrame:
    """(path, length, modificationTime) of every image file; contents are
    not read.  ``path`` is normalised (single slash after ``file:``)."""
    df = _load(_reader(spark, "binaryFile", cfg, recursive), root, cfg, recursive)
    return df.select(
        LB.normalise_path(F.col("path"), percent_decode=False).alias("path"), "length", "modificationTime"
    )


def require_files(files: DataFrame, root: str) -> None:
    """The empty-input guard: one-row probe, not a count."""
    if files.limit(1).isEmpty():
        raise ValueError(_nothing(root))


def read_images(spark: SparkSession, root: str, cfg: PipelineConfig, *, recursive: bool = False) -> DataFrame:
    """Decoded images: (image_path, height, width, channels, mode, data
    binary).  Pixel bytes are B,G,R[,A] or gray as the image source stores
    them; invalid files have height -1 and empty data."""
    return _pixels(_load(_reader(spark, "image", cfg, recursive).option("dropInvalid", "false"), root, cfg, recursive))


def read_paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Decoded images of the given files, a bounded list."""
    with many_small_files(spark):
        return _pixels(spark.read.format("image").option("dropInvalid", "false").load([escape_glob(p) for p in paths]))


#: tasks that look up a list of files, and what opening a file counts beside its bytes
_LOOKUP_TASKS, _OPEN_COST = 64, 128 << 10


@contextmanager
def many_small_files(spark: SparkSession) -> Iterator[None]:
    """Within, lists of files are looked up by a bounded number of tasks, not by one
    for each file, and scans pack files into tasks by about the work that an image
    is: at Spark's 4 MB a file, a task gets a few images and, written by split, makes
    a file for each or two of them."""
    bounds = {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": _LOOKUP_TASKS,
        "spark.sql.files.openCostInBytes": _OPEN_COST,
    }
    before = {k: spark.conf.get(k) for k in bounds}
    for k, most in bounds.items():
        spark.conf.set(k, str(min(_bytes(spark, before[k]), most)))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _bytes(spark: SparkSession, text: str) -> int:
    """A number as Spark's settings spell it: 4194304, 4m, 4MB."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def _pixels(df: DataFrame) -> DataFrame:
    return df.select(
        LB.normalise_path(F.col("image.origin"), percent_decode=True).alias("image_path"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"),
        F.col("image.mode").alias("mode"),
        F.col("image.data").alias("data"),
    )


def qualified_root(spark: SparkSession, root: str) -> str:
    """The raw root as the file index spells paths (scheme, authority,
    single slash after ``file:``), without a trailing slash."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root.rstrip("/"))
    q = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return q.rstrip("/")


def root_tags(roots: list[str]) -> list[str]:
    """A name for each of several raw roots: the last folder of its path, with a
    number where that isn't unique."""
    names = [r.rstrip("/").rsplit("/", 1)[-1] for r in roots]
    return [n if names.count(n) == 1 else f"{n}#{i}" for i, n in enumerate(names)]


def relative_key(path_col, root_qualified: str | list[str] | None):
    """Path relative to the raw root: the key of every seeded draw and of
    the ratio split, so copying a dataset elsewhere keeps its variants.  With
    several roots, the root's name goes first: files of equal relative path are
    different images and get variants of their own."""
    p = F.col(path_col) if isinstance(path_col, str) else path_col
    if not root_qualified:
        return p
    roots = [root_qualified] if isinstance(root_qualified, str) else list(root_qualified)
    out = p
    # a root inside another one is tried first
    for tag, root in sorted(zip(root_tags(roots), roots), key=lambda x: len(x[1])):
        prefix = root + "/"
        rest = F.substring(p, len(prefix) + 1, 1 << 30)
        out = F.when(p.startswith(prefix), rest if len(roots) == 1 else F.concat(F.lit(tag + "/"), rest)).otherwise(out)
    return out


def labelled_files(
    files: DataFrame, cfg: PipelineConfig, path_col: str = "path", root_qualified: str | list[str] | None = None
) -> DataFrame:
    key = relative_key(path_col, root_qualified)
    split = LB.split_expr(F.col(path_col))
    if cfg.split_assignment == "ratio":
        split = LB.ratio_split_expr(key, cfg, existing=split)
    return files.select(
        F.col(path_col).alias("image_path"),
        LB.label_expr(F.col(path_col), cfg).alias("label"),
        split.alias("split"),
    )


# -- PNG header probe ------------------------------------------------------------

def png_bit_depth(path: str) -> int | None:
    """Bit depth from the IHDR chunk (byte 24 of a PNG), None if not a PNG."""
    fs, p = fs_and_path(path)
    with fs.open_input_stream(p) as f:
        head = f.read(26)
    if len(head) < 26 or head[:8] != b"\x89PNG\r\n\x1a\n":
        return None
    return head[24]


def _probe_batches(batches):
    for b in batches:
        paths = b.column(0).to_pylist()
        depth = []
        for p in paths:
            try:
                depth.append(png_bit_depth(p) if p.lower().endswith(".png") else None)
            except OSError:
                depth.append(None)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(depth, type=pa.int32())], ["image_path", "bit_depth"])


def probe_bit_depth(df: DataFrame, path_col: str = "image_path") -> DataFrame:
    """(image_path, bit_depth) for the given rows: a 26-byte read per PNG."""
    ship_package(df.sparkSession)
    schema = T.StructType([T.StructField("image_path", T.StringType()), T.StructField("bit_depth", T.IntegerType())])
    return df.select(F.col(path_col).alias("image_path")).mapInArrow(_probe_batches, schema)


def is_unsupported_depth(path: str, channels: int) -> bool:
    """Gray PNGs with 16-bit samples decode to their low byte in the image
    source: silently wrong pixels, so such files are rejected.  So is a file
    whose header can't be read after three tries: its depth is unknown."""
    if channels != 1 or not path.lower().endswith(".png"):
        return False
    for wait in (0.0, 0.5, 2.0):
        time.sleep(wait)
        try:
            d = png_bit_depth(path)
        except OSError:
            continue
        return d is not None and d > 8
    return True
