"""Derived tables go under the session's shared checkpoint folder."""

from types import SimpleNamespace

import pytest

from tessera.session import checkpoint_root, scratch_path


def test_scratch_under_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert root == configured.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root + "/tessera/") and b.startswith(root + "/tessera/")


def test_a_cluster_without_a_shared_folder_is_an_error():
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(fake)
