"""Scalable global ranks equal the single-window form, also under skew."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.config import PipelineConfig
from tessera.operators.batching import assign_batches, assign_batches_window, collect_batches
from tessera.operators.splits import stratified_split


def skewed(spark, n=5000):
    # one split holds ~90% of the rows
    return spark.range(n).select(
        F.concat(F.lit("img"), F.col("id").cast("string")).alias("image_path"),
        F.when(F.col("id") % 10 == 0, "test").otherwise("train").alias("split"),
        (F.col("id") % 3).cast("int").alias("augmentation_index"),
        (F.col("id") % 2).cast("int").alias("label"),
    )


def test_scaled_equals_window(spark):
    cfg = PipelineConfig(batch_size=7)
    df = skewed(spark)
    a = assign_batches_window(df, cfg).select("image_path", "augmentation_index", "batch_id", "batch_pos")
    b = assign_batches(df, cfg, buckets=16).select("image_path", "augmentation_index", "batch_id", "batch_pos")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    sizes = collect_batches(b.join(df, ["image_path", "augmentation_index"]), ["image_path"]).select("batch_size")
    assert sizes.agg(F.max("batch_size")).first()[0] == 7


def test_scaled_equals_window_path_order(spark):
    cfg = PipelineConfig(batch_size=5, shuffle=False)
    df = skewed(spark, 3000)
    a = assign_batches_window(df, cfg).select("image_path", "augmentation_index", "batch_id", "batch_pos")
    b = assign_batches(df, cfg, buckets=16).select("image_path", "augmentation_index", "batch_id", "batch_pos")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ordered_ids_with_more_columns_and_many_rows(spark):
    """Every kept column, several input partitions: the ids stay those of the
    single window."""
    cfg = PipelineConfig(batch_size=64, shuffle=False)
    df = skewed(spark, 300_000).withColumn("note", F.md5("image_path")).repartition(8)
    cols = ["image_path", "augmentation_index", "label", "note", "batch_id", "batch_pos"]
    a = assign_batches_window(df, cfg).select(*cols)
    b = assign_batches(df, cfg, buckets=16).select(*cols)
    assert b.count() == 300_000 and a.exceptAll(b).count() == 0


def test_stratified_matches_percent_rank(spark):
    cfg = PipelineConfig()
    df = skewed(spark, 3000).select("image_path", "label")
    got = stratified_split(df, "label", "image_path", cfg, buckets=8)
    from tessera.functions.random import md5_uniform

    w = Window.partitionBy("label").orderBy("u")
    ref = df.withColumn("u", md5_uniform(cfg.seed, F.col("image_path"))).withColumn("pr", F.percent_rank().over(w))
    ref = ref.select("image_path", F.when(F.col("pr") < 0.7, "train").when(F.col("pr") < 0.85, "validation").otherwise("test").alias("split_strat"))
    assert got.select("image_path", "split_strat").exceptAll(ref).count() == 0
    frac = got.groupBy("label", "split_strat").count().collect()
    assert {r.split_strat for r in frac} == {"train", "validation", "test"}
