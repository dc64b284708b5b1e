"""Task failures: the first attempt of a task dies mid-write, the retry must
give exactly the output of a clean run (no duplicate, no missing record,
no temporary files, the same seeded variants).

Runs in a subprocess because it needs its own SparkContext with task
retries enabled (``local[4,2]``), which the shared test session has not.
"""

import json
import os
import subprocess
import sys
import tempfile
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(
    """
    import json, os, sys
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    from tessera.plans import catalog as C, pipeline as PL, sinks as SK
    from tessera.session import ship_package

    work = {work!r}
    spark = (SparkSession.builder.master("local[4,2]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", work + "/ckpt")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    ship_package(spark)

    def fail_first_attempt(batches):
        ctx = TaskContext.get()
        for i, b in enumerate(batches):
            yield b
            if ctx.attemptNumber() == 0 and ctx.partitionId() == 0 and i == 0:
                raise RuntimeError("injected executor loss")

    sf = "/root/testdata/sf0.001"
    imgs = C._images(spark, sf).drop("vec_id").repartition(4)
    cfg = C.TILE_CFG.with_(engine="kernel")
    rec = PL.to_records(PL.process(imgs, cfg, at_target_size=True), cfg)
    flaky = rec.mapInArrow(fail_first_attempt, rec.schema)

    SK.write_records(rec, work + "/clean", cfg)
    SK.write_records(flaky, work + "/flaky", cfg)
    clean = spark.read.parquet(work + "/clean")
    again = spark.read.parquet(work + "/flaky")
    parquet_equal = clean.exceptAll(again).count() == 0 and again.exceptAll(clean).count() == 0

    SK.write_tfrecords(flaky.select("image_path", "split", "label", "image_shape", "image_flattened"), work + "/tf", cfg)
    tf = SK.read_tfrecords(spark, work + "/tf")
    tf_keys = tf.select("image_path", "split", "label", F.col("image").alias("image_flattened"))
    ref = clean.select("image_path", "split", F.col("label").cast("bigint"), "image_flattened")
    tf_equal = tf_keys.exceptAll(ref).count() == 0 and ref.exceptAll(tf_keys).count() == 0
    leftovers = [d for d, _, _ in os.walk(work + "/tf") if "_temporary" in d]
    print(json.dumps({{"rows": clean.count(), "tf_rows": tf.count(), "parquet_equal": parquet_equal,
                       "tf_equal": tf_equal, "leftovers": leftovers}}))
    """
)


def test_retried_tasks_reproduce_clean_output():
    work = tempfile.mkdtemp(prefix="run-retry-", dir="/tmp")
    code = SCRIPT.format(root=ROOT, work=work)
    res = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=900)
    lines = [ln for ln in res.stdout.splitlines() if ln.startswith("{")]
    assert lines, res.stderr[-3000:]
    out = json.loads(lines[-1])
    assert out["rows"] > 0 and out["tf_rows"] == out["rows"]
    assert out["parquet_equal"] and out["tf_equal"]
    assert out["leftovers"] == []
