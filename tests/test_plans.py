"""Plan checks: native labels, pruning, no pixel shuffles."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.plans import catalog as C
from tessera.plans import pipeline as PL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_label_and_split_have_no_python(spark):
    p = plan(C.q_label_filter(spark, SF_SMALL)) + plan(C.q_split_extract(spark, SF_SMALL))
    assert "Python" not in p and "ArrowEval" not in p and "BatchEval" not in p


def test_pipeline_has_no_exchange(spark):
    imgs = C._images(spark, SF_SMALL).drop("vec_id")
    p = plan(PL.to_records(PL.process(imgs, C.TILE_CFG, at_target_size=True), C.TILE_CFG))
    assert "Exchange" not in p
    assert p.count("MapInArrow") == 1  # rotation only: the tiles need no resize


def test_kernel_engine_is_one_python_stage(spark):
    imgs = C._images(spark, SF_SMALL).drop("vec_id")
    cfg = C.TILE_CFG.with_(engine="kernel")
    p = plan(PL.to_records(PL.process(imgs, cfg, at_target_size=True), cfg))
    assert "Exchange" not in p and p.count("MapInArrow") == 1


def test_scan_prunes_columns(spark):
    p = plan(C.q_label_encode(spark, SF_SMALL))
    assert "ReadSchema: struct<vec_id:bigint,label:int>" in p


def test_split_filter_is_a_partition_filter(spark, workdir):
    from tessera.plans import sinks

    imgs = C._images(spark, SF_SMALL).drop("vec_id")
    sinks.write_records(PL.to_records(PL.process(imgs, C.TILE_CFG, at_target_size=True), C.TILE_CFG), workdir + "/pq", C.TILE_CFG)
    df = sinks.read_records(spark, workdir + "/pq", split="train")
    assert "PartitionFilters: [isnotnull(split" in plan(df)
    assert df.select("split").distinct().collect()[0].split == "train"


@pytest.mark.parametrize("key", ["batch_assign", "batch_assign_scaled", "batch_assign_ordered"])
def test_batching_ranks_without_single_split_task(spark, key):
    p = plan(C.QUERIES[key](spark, SF_SMALL))
    # the per-(split, bucket) window partitions by the bucket too
    assert "hashpartitioning(split" in p and "_b" in p
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
