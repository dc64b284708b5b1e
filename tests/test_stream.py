"""Incremental ingest: a second run processes only files that arrived."""

import numpy as np

import pytest

from imagefiles import png_bytes, write
from tessera.plans import catalog as C
from tessera.plans import sinks as SK
from tessera.plans.ledger import Ledger
from tessera.plans.run import LISTING_SCHEMA, REJECT_SCHEMA, run_pipeline
from tessera.sources import files as FS
from tessera.streaming.ingest import ingest


def test_second_run_only_new_files(spark, workdir):
    raw = workdir + "/raw"
    rng = np.random.default_rng(3)
    for i in range(4):
        write(f"{raw}/train/NORMAL/a{i}.png", png_bytes(rng.integers(0, 256, (5, 5)).astype(np.uint8)))
    cfg = C.TILE_CFG.with_(round_u8=True)
    out, ckpt = workdir + "/records", workdir + "/ckpt"
    ingest(spark, raw, out, ckpt, cfg)
    assert spark.read.parquet(out).count() == 4 * cfg.fanout
    for i in range(2):
        write(f"{raw}/test/PNEUMONIA/b{i}.png", png_bytes(rng.integers(0, 256, (5, 5, 3)).astype(np.uint8)))
    ingest(spark, raw, out, ckpt, cfg)
    df = spark.read.parquet(out)
    assert df.count() == 6 * cfg.fanout
    assert df.groupBy("image_path").count().where("count <> 3").count() == 0
    ingest(spark, raw, out, ckpt, cfg)  # nothing new
    assert spark.read.parquet(out).count() == 6 * cfg.fanout


def test_small_files_share_tasks(spark, workdir):
    """Neither a task for each file in the listing of a micro-batch, nor a few images
    a task in the scan: each task writes files of its own."""
    raw, cfg = workdir + "/raw", C.TILE_CFG.with_(round_u8=True, tfrecord_enabled=False)
    keys = ["spark.sql.files.openCostInBytes", "spark.sql.sources.parallelPartitionDiscovery.parallelism"]
    before = [spark.conf.get(k) for k in keys]
    picture = png_bytes(np.full((5, 5), 7, np.uint8))
    for i in range(320):
        write(f"{raw}/train/NORMAL/a{i}.png", picture)
    status = spark.sparkContext._jsc.sc().statusStore()
    jobs = {status.jobsList(None).apply(i).jobId() for i in range(status.jobsList(None).size())}
    ingest(spark, raw, workdir + "/streamed", workdir + "/ckpt", cfg)
    known = status.jobsList(None)
    largest = max(j.numTasks() for j in (known.apply(i) for i in range(known.size())) if j.jobId() not in jobs)
    assert largest <= 64  # a task for each of the 320 files before
    run_pipeline(spark, raw, workdir + "/out", cfg)
    for path in (workdir + "/streamed", workdir + "/out/parquet"):
        records = SK.read_records(spark, path)
        assert records.count() == 320 * cfg.fanout
        assert len(records.inputFiles()) <= 6  # 10 and more with 32 files a task
    assert [spark.conf.get(k) for k in keys] == before


def test_ingest_after_a_batch_run(spark, workdir):
    """One version fed by a batch run and then by ingest: all records are read
    back, rejects and shards follow, and a corrupt upload is reported."""
    from tessera.plans import sinks as SK
    from tessera.plans.run import refresh_metadata, run_pipeline

    raw, out, ckpt = workdir + "/raw", workdir + "/out", workdir + "/ckpt"
    rng = np.random.default_rng(4)
    picture = lambda: png_bytes(rng.integers(0, 256, (6, 6, 3)).astype(np.uint8))
    for i in range(3):
        write(f"{raw}/train/NORMAL/a{i}.png", picture())
    cfg = C.TILE_CFG.with_(round_u8=True, tfrecord_enabled=True)
    run_pipeline(spark, raw, out, cfg)
    write(f"{raw}/test/PNEUMONIA/b.png", picture())
    write(f"{raw}/test/PNEUMONIA/bad.png", b"no picture")
    write(f"{raw}/test/other/c.png", picture())
    for _ in range(2):  # the second run finds nothing new
        ingest(spark, raw, out + "/parquet", ckpt, cfg, out_root=out)
        doc = refresh_metadata(spark, out, cfg)
        assert spark.read.parquet(out + "/parquet").count() == 4 * cfg.fanout
        assert SK.read_tfrecords(spark, out + "/tfrecords").count() == 4 * cfg.fanout
        assert spark.read.parquet(out + "/batches").count() == 4 * cfg.fanout
        rejects = {(r.image_path.rsplit("/", 1)[1], r.reason) for r in spark.read.parquet(out + "/rejects").collect()}
        assert rejects == {("bad.png", "decode_error"), ("c.png", "unknown_class")}
        assert doc["processed_images"] == 4 * cfg.fanout and doc["rejected_images"] == 1


def test_max_images_takes_paths_as_they_are(spark, workdir):
    from tessera.plans.run import run_pipeline

    raw = workdir + "/raw"
    for name in ("x[1].png", "{a,b}.png", "a.png"):
        write(f"{raw}/train/NORMAL/{name}", png_bytes(np.zeros((4, 4, 3), np.uint8)))
    cfg = C.TILE_CFG.with_(round_u8=True, tfrecord_enabled=False, parquet_enabled=False)
    res = run_pipeline(spark, raw, workdir + "/out", cfg, max_images=3)
    assert res.document["processed_images"] == 3 * cfg.fanout and res.parquet is None


CFG = C.TILE_CFG.with_(round_u8=True, tfrecord_enabled=True)


def uploads(raw, folder, names, seed):
    rng = np.random.default_rng(seed)
    for name in names:
        write(f"{raw}/{folder}/{name}", png_bytes(rng.integers(0, 256, (6, 6, 3)).astype(np.uint8)))


def version(spark, out):
    """What readers find: (records, examples, batch ids, rejects), sorted."""
    ledger = Ledger(spark, out + "/parquet")
    name = lambda r: r.image_path.rsplit("/", 1)[1]
    records = SK.read_records(spark, out + "/parquet").select("image_path", "augmentation_index").collect()
    examples = SK.read_tfrecords(spark, out + "/tfrecords", epochs=ledger.published()).select("image_path").collect()
    batches = ledger.read(out + "/batches").collect()
    rejects = ledger.read(out + "/rejects", REJECT_SCHEMA).collect()
    return (
        sorted((name(r), r.augmentation_index) for r in records),
        sorted(name(r) for r in examples),
        {(r.split, name(r), r.augmentation_index): (r.batch_id, r.batch_pos) for r in batches},
        sorted((name(r), r.reason) for r in rejects),
    )


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["listing", "records", "tfrecords", "batches", "rejects", "published"])
def test_a_failure_after_any_output_is_made_good(spark, workdir, step):
    """The epoch isn't seen before all of it is there, and the restart completes
    it without anything twice."""
    raw, out, ckpt = workdir + "/raw", workdir + "/out", workdir + "/ckpt"
    uploads(raw, "train/NORMAL", ["a.png", "b.png"], 1)
    run_pipeline(spark, raw, out, CFG)
    before = version(spark, out)
    uploads(raw, "train/PNEUMONIA", ["c.png"], 2)
    write(f"{raw}/train/NORMAL/bad.png", b"no picture")
    write(f"{raw}/train/other/d.png", b"unknown class")

    def stop(name):
        if name == step:
            raise Stopped(name)

    with pytest.raises(Exception, match="Stopped"):
        ingest(spark, raw, out + "/parquet", ckpt, CFG, out_root=out, on_output=stop)
    if step != "published":
        assert version(spark, out) == before
    ingest(spark, raw, out + "/parquet", ckpt, CFG, out_root=out)
    records, examples, batches, rejects = version(spark, out)
    assert records == [(f"{n}.png", k) for n in "abc" for k in range(CFG.fanout)]
    assert examples == sorted(n for n, _ in records)
    assert rejects == [("bad.png", "decode_error"), ("d.png", "unknown_class")]
    # the batch run's ids are as they were, the new ones go on from them
    assert {k: v for k, v in batches.items() if k in before[2]} == before[2]
    assert sorted(p for _, p in batches.values()) == list(range(len(records)))


def test_a_full_run_replaces_what_ingest_added(spark, workdir):
    raw, out, ckpt = workdir + "/raw", workdir + "/out", workdir + "/ckpt"
    uploads(raw, "train/NORMAL", ["a.png"], 1)
    run_pipeline(spark, raw, out, CFG)
    uploads(raw, "test/NORMAL", ["b.png"], 2)
    ingest(spark, raw, out + "/parquet", ckpt, CFG, out_root=out)
    ledger = Ledger(spark, out + "/parquet")
    assert len(ledger.published()) == 2 and ledger.counts() == {"train": CFG.fanout, "test": CFG.fanout}
    grown = version(spark, out)
    run_pipeline(spark, raw, out, CFG)
    again = version(spark, out)
    assert len(ledger.published()) == 1 and again[0] == grown[0] and again[1] == grown[1]
    # nothing of the replaced epochs is left, also for a plain reader
    assert spark.read.parquet(out + "/parquet").count() == len(again[0])
    assert ledger.read(out + "/parquet/_listing", LISTING_SCHEMA).count() == 2


def test_an_interrupted_full_run_leaves_the_version_before(spark, workdir, monkeypatch):
    from tessera.plans import run as R

    raw, out = workdir + "/raw", workdir + "/out"
    uploads(raw, "train/NORMAL", ["a.png"], 1)
    run_pipeline(spark, raw, out, CFG)
    before = version(spark, out)
    uploads(raw, "train/NORMAL", ["b.png"], 2)

    def broken(*a, **kw):
        raise Stopped("rejects")

    monkeypatch.setattr(R, "rejects", broken)
    with pytest.raises(Stopped):
        run_pipeline(spark, raw, out, CFG)
    monkeypatch.undo()
    assert version(spark, out) == before
    run_pipeline(spark, raw, out, CFG)
    assert len(version(spark, out)[0]) == 2 * CFG.fanout


def test_the_ingest_plan_moves_no_pixels(spark, workdir, monkeypatch):
    """What decodes the images has no exchange: known paths are dropped before."""
    from tessera.plans import pipeline as PL

    plans = []
    real = PL.to_records
    monkeypatch.setattr(PL, "to_records", lambda df, cfg, **kw: plans.append(df) or real(df, cfg, **kw))
    raw, out = workdir + "/raw", workdir + "/out"
    uploads(raw, "train/NORMAL", ["a.png"], 1)
    run_pipeline(spark, raw, out, CFG)
    uploads(raw, "train/NORMAL", ["b.png"], 2)
    ingest(spark, raw, out + "/parquet", workdir + "/ckpt", CFG, out_root=out)
    assert len(plans) == 2 and all("Exchange" not in p._jdf.queryExecution().executedPlan().toString() for p in plans)


def test_two_roots_with_equal_paths(spark, workdir):
    """Files of equal relative path in two roots are two images with variants of
    their own; one root alone keeps its variants wherever it lies."""
    for root in ("one", "two", "moved/one"):
        uploads(f"{workdir}/{root}", "train/NORMAL", ["a.png"], 5)
    cfg = CFG.with_(tfrecord_enabled=False)

    def tensors(roots, name):
        res = run_pipeline(spark, roots, f"{workdir}/{name}", cfg)
        return {(r.image_path.split("/train/")[0].rsplit("/", 1)[1], r.augmentation_index): r.image_flattened for r in SK.read_records(spark, res.parquet).collect()}

    both = tensors([f"{workdir}/one", f"{workdir}/two"], "both")
    assert len(both) == 2 * cfg.fanout and both["one", 0] == both["two", 0]
    assert any(both["one", k] != both["two", k] for k in range(1, cfg.fanout))
    assert tensors(f"{workdir}/one", "alone") == tensors(f"{workdir}/moved/one", "elsewhere")
    assert FS.root_tags(["/x/v1", "/y/v1", "/y/v2"]) == ["v1#0", "v1#1", "v2"]


def test_validation_without_parquet_output(spark, workdir):
    from tessera.operators.quality import validate_output

    raw, out = workdir + "/raw", workdir + "/out"
    uploads(raw, "train/NORMAL", ["a.png", "b.png"], 5)
    cfg = CFG.with_(parquet_enabled=False)
    run_pipeline(spark, raw, out, cfg)
    got = {r.check: (r.ok, r.n) for r in validate_output(spark, out, cfg).collect()}
    n = 2 * cfg.fanout
    assert got == {"metadata_present": (True, n), "examples_match_metadata": (True, n)}
    assert not any(r.ok for r in validate_output(spark, workdir + "/nowhere", cfg).collect())
