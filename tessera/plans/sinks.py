"""Writers: records as Parquet partitioned by split, examples as Parquet
or TFRecord files, the metadata document as one JSON file."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..operators.encode import encode_examples
from ..session import ship_package
from ..sources import shardlog
from ..sources import tfrecord as TFR
from .ledger import Ledger, has_ledger


def write_records(records: DataFrame, path: str, cfg: PipelineConfig, *, dynamic_overwrite: bool = False) -> str:
    """Parquet, ``partitionBy("split")``, overwrite.  Static overwrite
    replaces every split (a full run); ``dynamic_overwrite`` replaces only
    the splits present in ``records`` (a single-split rerun)."""
    w = records.write.mode("overwrite").partitionBy("split").option("compression", cfg.parquet_compression)
    # tensors are unique floats and paths are unique strings: a dictionary
    # page never pays off, and trying one costs ~2.5x the write time
    w = w.option("parquet.enable.dictionary", "false")
    if cfg.parquet_row_group_size_mb:
        w = w.option("parquet.block.size", int(cfg.parquet_row_group_size_mb) * 1024 * 1024)
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)
    return path


def read_records(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Read back: the published epochs of a table with a ledger, else the table; a
    split filter prunes to one partition directory of each."""
    df = Ledger(spark, path).read(path) if has_ledger(spark, path) else spark.read.parquet(path)
    if df is None:
        raise ValueError(f"{path} has no published records")
    return df.where(F.col("split") == split) if split is not None else df


def write_examples_parquet(records: DataFrame, path: str) -> str:
    """Serialized examples as Parquet (``tfrecord binary``) by split."""
    ex = encode_examples(records).select(F.col("example").alias("tfrecord"), "split")
    ex.write.mode("overwrite").partitionBy("split").option("parquet.enable.dictionary", "false").parquet(path)
    return path


def write_tfrecords(records: DataFrame, path: str, cfg: PipelineConfig, *, append: bool = False, epoch: str | None = None) -> str:
    """TFRecord shards under ``{path}/{split}/`` via the tfrecord source.  An
    ``epoch`` written again replaces itself, and stays pending until
    ``show_examples``."""
    spark = records.sparkSession
    ship_package(spark)
    TFR.register(spark)
    # the writer encodes the record columns itself: one Python crossing
    ex = records.select(
        "image_path",
        "split",
        F.col("label").cast("bigint").alias("label"),
        F.col("image_shape").cast("array<bigint>").alias("image_shape"),
        F.col("image_flattened").cast("array<float>").alias("image_flattened"),
    )
    w = ex.write.format("tfrecord").mode("append" if append else "overwrite").option("path", path)
    w = w.option("shardSizeMb", str(cfg.tfrecord_shard_size_mb))
    if cfg.tfrecord_compression:
        w = w.option("compression", cfg.tfrecord_compression)
    if epoch:
        w = w.option("epoch", epoch).option("pending", "true")
    w.save()
    return path


def show_examples(path: str, epoch: str, *, replaces: bool = False) -> None:
    """A pending epoch of shards becomes part of the version, or all of it."""
    shardlog.show(*TFR.fs_and_path(path), epoch, replaces)


def read_tfrecords(spark: SparkSession, path: str, raw: bool = False, epochs: list[str] | None = None) -> DataFrame:
    ship_package(spark)
    TFR.register(spark)
    r = spark.read.format("tfrecord").option("raw", "true" if raw else "false")
    if epochs is not None:
        r = r.option("epochs", ",".join(epochs))
    return r.load(path)


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """One small file through the Hadoop FileSystem API (any scheme the
    cluster can write), so it stays a single file, not a folder."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    fs.setWriteChecksum(False)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_metadata(spark: SparkSession, path: str, doc: dict) -> str:
    write_text_file(spark, path, json.dumps(doc, indent=2, sort_keys=False, default=str))
    return path


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)
