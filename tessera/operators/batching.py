"""Batch ids for training (batch_size, shuffle, seed).

Within each split, rows are ordered by ``md5(seed|image_path|index)`` when
shuffling (else by path, index); ``batch_id = (rn - 1) div batch_size`` and
``batch_pos = (rn - 1) mod batch_size``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.random import row_hash_key
from ..session import scratch_path
from .ranking import global_rank, hex_bucket

def _order(cfg: PipelineConfig, path_col: str, index_col: str):
    if cfg.shuffle:
        return [row_hash_key(cfg.seed, F.col(path_col), F.col(index_col)), F.col(path_col), F.col(index_col)]
    return [F.col(path_col), F.col(index_col)]


def _finish(df: DataFrame, cfg: PipelineConfig, split_col: str = "split", before: dict[str, int] | None = None) -> DataFrame:
    bs = int(cfg.batch_size)
    if before:
        earlier = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])[F.col(split_col)]
        df = df.withColumn("rn", F.col("rn") + F.coalesce(earlier, F.lit(0)))
    return df.withColumn("batch_id", F.floor((F.col("rn") - 1) / bs).cast("bigint")).withColumn(
        "batch_pos", ((F.col("rn") - 1) % bs).cast("bigint")
    ).drop("rn")


def assign_batches_window(
    df: DataFrame, cfg: PipelineConfig, *, split_col: str = "split", path_col: str = "image_path",
    index_col: str = "augmentation_index",
) -> DataFrame:
    """The direct form: one window per split (one task per split)."""
    w = Window.partitionBy(split_col).orderBy(*_order(cfg, path_col, index_col))
    return _finish(df.withColumn("rn", F.row_number().over(w)), cfg)


def assign_batches(
    df: DataFrame, cfg: PipelineConfig, *, split_col: str = "split", path_col: str = "image_path",
    index_col: str = "augmentation_index", buckets: int = 1024, before: dict[str, int] | None = None,
) -> DataFrame:
    """Same ids as :func:`assign_batches_window`, without a per-split sort;
    ``before``: rows by split that are numbered already, whose numbers go on."""
    order = _order(cfg, path_col, index_col)
    if cfg.shuffle:
        bucket = hex_bucket(row_hash_key(cfg.seed, F.col(path_col), F.col(index_col)), buckets)
    else:
        # path order: range-partition the rows; the partition id is then a
        # monotone bucket of (split, path, index).  Range bounds are sampled
        # anew by every exchange, so the rows are written once with their bucket
        # and both the counts and the ranks read that table
        df = df.repartitionByRange(buckets, F.col(split_col), F.col(path_col), F.col(index_col))
        path = scratch_path(df.sparkSession, "batch-order")
        df.withColumn("_range_b", F.spark_partition_id().cast("bigint")).write.parquet(path)
        df = df.sparkSession.read.parquet(path)
        bucket = F.col("_range_b")
    ranked = global_rank(df, [split_col], order, bucket)
    return _finish(ranked.drop("_range_b"), cfg, split_col, before)


def collect_batches(df: DataFrame, members: list[str], *, split_col: str = "split") -> DataFrame:
    """One row per (split, batch_id): members ordered by batch_pos.  A group
    holds at most batch_size rows, so no group is unbounded."""
    return df.groupBy(split_col, "batch_id").agg(
        F.count(F.lit(1)).alias("batch_size"),
        F.sort_array(F.collect_list(F.struct("batch_pos", *members))).alias("items"),
    )
