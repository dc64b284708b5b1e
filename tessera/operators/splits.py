"""Seeded ratio splits.

``ratio_split_expr`` (tessera.functions.labels) is the per-row form: the
md5 uniform of the image path against the cumulative ratios.  The
stratified form ranks images by that uniform inside each stratum (label)
and cuts at the ratios, so every class gets the configured proportions.
It uses the bucketed global rank, never one task per class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.random import md5_uniform
from .ranking import global_rank, unit_bucket


def stratified_split(
    df: DataFrame,
    strata_col: str,
    path_col: str,
    cfg: PipelineConfig,
    *,
    out_col: str = "split_strat",
    buckets: int = 1024,
) -> DataFrame:
    u = md5_uniform(cfg.seed, F.col(path_col))
    df = df.withColumn("_u", u)
    ranked = global_rank(
        df,
        [strata_col],
        [F.col("_u")],
        unit_bucket(F.col("_u"), buckets),
        method="rank",
        out_col="_rk",
        with_group_size=True,
    )
    pr = F.when(F.col("group_n") <= 1, F.lit(0.0)).otherwise(
        (F.col("_rk") - 1).cast("double") / (F.col("group_n") - 1).cast("double")
    )
    t1 = cfg.split_train
    t2 = cfg.split_train + cfg.split_validation
    split = F.when(pr < F.lit(t1), "train").when(pr < F.lit(t2), "validation").otherwise("test")
    return ranked.withColumn(out_col, split).drop("_u", "_rk", "group_n")
