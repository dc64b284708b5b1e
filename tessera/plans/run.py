"""The end-to-end job: raw image folders -> versioned, training-ready output.

    {raw_root}/{split}/{class}/{file}.{ext}
 -> {out}/parquet/epoch=*/split=*/    records (one row per image x variant)
 -> {out}/tfrecords/{split}/*.tfrecord
 -> {out}/rejects/epoch=*/           files that produced no record, with a reason
 -> {out}/batches/epoch=*/split=*/    batch ids
 -> {out}/metadata.json

The images are decoded and transformed exactly once (the Parquet write);
examples, rejects and metadata are derived from the written Parquet, so
every output describes the same variants.  A run is one epoch of the ledger
(``plans.ledger``): its outputs become the version together, when all are
complete; until then the version before is what readers see.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..operators import quality as Q
from ..operators import stats as ST
from ..session import scratch_path, ship_package
from ..sources import files as FS
from . import pipeline as PL
from . import sinks as SK
from .ledger import LISTING, Ledger, split_counts

LISTING_SCHEMA = "image_path string, label int, split string"
REJECT_SCHEMA = "image_path string, stage string, reason string"


def raw_path(root: str, tag: str) -> str:
    return f"{root.rstrip('/')}/raw/{tag}"


def processed_path(root: str, tag: str) -> str:
    return f"{root.rstrip('/')}/processed/{tag}"


# Fixed value: the config file name of the version-tagged storage layout.
CONFIG_FILE_NAME = "pipeline_config.yaml"


def config_path(root: str) -> str:
    return f"{root.rstrip('/')}/config/{CONFIG_FILE_NAME}"


@dataclass
class RunResult:
    parquet: str | None
    tfrecords: str | None
    rejects: str
    metadata: str
    document: dict
    batches: str | None = None
    timings: dict | None = None


def roots_of(raw_root: str | list[str]) -> list[str]:
    return [raw_root] if isinstance(raw_root, str) else list(dict.fromkeys(raw_root))


def decoded_images(
    spark: SparkSession, raw_root: str | list[str], cfg: PipelineConfig, *, recursive: bool = False, max_images: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(labelled file listing, decoded images with known labels) of one raw root,
    or of several by name."""
    roots = roots_of(raw_root)
    files = reduce(DataFrame.unionByName, [FS.list_files(spark, r, cfg, recursive=recursive) for r in roots])
    FS.require_files(files, ", ".join(roots))
    root_q = [FS.qualified_root(spark, r) for r in roots]
    listing = FS.labelled_files(files, cfg, root_qualified=root_q)
    if max_images is not None:
        # first N of the listing by path; N is small by purpose (quick runs)
        keep = [r.image_path for r in listing.orderBy("image_path").limit(int(max_images)).collect()]
        listing = listing.where(F.col("image_path").isin(keep))
        imgs = FS.read_paths(spark, keep)
    else:
        imgs = reduce(DataFrame.unionByName, [FS.read_images(spark, r, cfg, recursive=recursive) for r in roots])
    imgs = imgs.withColumn("seed_key", FS.relative_key("image_path", root_q))
    imgs = PL.known_labels(PL.with_label_split(imgs, cfg, key_col="seed_key")).where(F.col("height") > 0).drop("mode")
    return listing, imgs


def rejects(listing: DataFrame, stored: DataFrame) -> DataFrame:
    """Every listed file without a record: unknown class, unsupported bit
    depth, or a decode failure.  Keys only: the listing anti-joined with
    the variant-0 rows of the written records."""
    unknown = listing.where(F.col("label") < 0).select(
        "image_path", F.lit("label").alias("stage"), F.lit("unknown_class").alias("reason")
    )
    kept = stored.where(F.col("augmentation_index") == 0).select("image_path")
    missing = listing.where(F.col("label") >= 0).join(kept, "image_path", "left_anti")
    probed = FS.probe_bit_depth(missing)
    failed = probed.select(
        "image_path",
        F.lit("decode").alias("stage"),
        F.when(F.col("bit_depth") > 8, F.lit("bit_depth")).otherwise(F.lit("decode_error")).alias("reason"),
    )
    return unknown.unionByName(failed)


def write_epoch(
    ledger: Ledger,
    epoch: str,
    out: str | None,
    cfg: PipelineConfig,
    listing: DataFrame,
    images: DataFrame | None,
    *,
    replaces: bool = False,
    repartition: int | None = None,
    on_output: Callable[[str], None] = lambda name: None,
) -> None:
    """Every output of one epoch, then its publication.  ``images``: the decoded
    images of ``listing`` with known labels, None if there are none.  Each step
    replaces what an earlier try of the epoch left; ``on_output`` is called after
    each one's completion.  Without ``out`` only the listing and the records are
    written."""
    spark, records_path = ledger.spark, ledger.root
    seen = ledger.folder(f"{records_path}/{LISTING}", epoch)
    listing.select("image_path", F.col("label").cast("int").alias("label"), "split").write.mode("overwrite").parquet(seen)
    listing = spark.read.schema(LISTING_SCHEMA).parquet(seen)
    on_output("listing")

    own, stored = ledger.folder(records_path, epoch), None
    if images is not None:
        records = PL.to_records(PL.process(images, cfg, key_col="seed_key"), cfg)
        SK.write_records(records.repartition(repartition) if repartition else records, own, cfg)
        stored = spark.read.schema(records.schema).parquet(own)
    on_output("records")
    counts = split_counts(stored) if stored is not None else {}

    if out is not None:
        if cfg.tfrecord_enabled and (counts or replaces):
            SK.write_tfrecords(stored, f"{out}/tfrecords", cfg, append=True, epoch=epoch)
        on_output("tfrecords")
        if cfg.examples_parquet and counts:
            SK.write_examples_parquet(stored, ledger.folder(f"{out}/examples", epoch))
        on_output("examples")
        if counts:
            write_batches(ledger, stored, out, cfg, epoch, {} if replaces else ledger.counts())
        on_output("batches")
        kept = stored if stored is not None else spark.createDataFrame([], "image_path string, augmentation_index int")
        rejects(listing, kept).write.mode("overwrite").parquet(ledger.folder(f"{out}/rejects", epoch))
        on_output("rejects")
    ledger.publish(epoch, counts, replaces=replaces)
    on_output("published")
    show_epoch(out, cfg, epoch, replaces)


def show_epoch(out: str | None, cfg: PipelineConfig, epoch: str, replaces: bool) -> None:
    """What readers of a single output see follows the ledger; may be repeated."""
    if out is not None and cfg.tfrecord_enabled:
        SK.show_examples(f"{out}/tfrecords", epoch, replaces=replaces)


def run_pipeline(
    spark: SparkSession,
    raw_root: str | list[str],
    out_root: str,
    cfg: PipelineConfig,
    *,
    recursive: bool = False,
    max_images: int | None = None,
) -> RunResult:
    import time

    ship_package(spark)
    out = out_root.rstrip("/")
    timings: dict[str, float] = {}
    t0 = time.time()

    def lap(name: str) -> None:
        nonlocal t0
        timings[name] = timings.get(name, 0) + round(time.time() - t0, 3)
        t0 = time.time()

    with FS.many_small_files(spark):
        return _run(spark, raw_root, out, cfg, lap, timings, recursive=recursive, max_images=max_images)


def _run(spark, raw_root, out: str, cfg: PipelineConfig, lap: Callable[[str], None], timings: dict[str, float], *, recursive: bool, max_images: int | None) -> RunResult:
    listing, imgs = decoded_images(spark, raw_root, cfg, recursive=recursive, max_images=max_images)
    lap("list")
    repartition = None
    if cfg.num_partitions and cfg.repartition_records:
        repartition = int(cfg.num_partitions)
    elif cfg.num_partitions:
        warnings.warn(
            "processing.num_partitions is not used: it would shuffle every tensor; "
            "tessera.repartition_records: true asks for that",
            stacklevel=2,
        )
    # the other outputs read the records back; without the Parquet output they
    # lie in the shared scratch folder
    pq_path = f"{out}/parquet" if cfg.parquet_enabled else scratch_path(spark, "records")
    ledger, epoch = Ledger(spark, pq_path), f"run-{uuid.uuid4().hex[:12]}"
    laps = {"listing": "list", "records": "decode_transform_write", "examples": "tfrecords"}
    write_epoch(ledger, epoch, out, cfg, listing, imgs, replaces=True, repartition=repartition, on_output=lambda name: lap(laps.get(name, name)))

    tables = [f"{out}/{t}" for t in ("rejects", "batches", "batch_tensors", "examples")]
    ledger.drop_unpublished(pq_path, f"{pq_path}/{LISTING}", *tables)
    if cfg.tfrecord_enabled:
        SK.TFR.vacuum(spark, f"{out}/tfrecords")
    lap("vacuum")
    doc, meta = write_document(ledger, out, cfg)
    lap("metadata")
    tf_path = f"{out}/tfrecords" if cfg.tfrecord_enabled else None
    return RunResult(pq_path if cfg.parquet_enabled else None, tf_path, f"{out}/rejects", meta, doc, f"{out}/batches", timings)


def write_batches(ledger: Ledger, stored: DataFrame, out: str, cfg: PipelineConfig, epoch: str, before: dict[str, int]) -> None:
    """Training batches: keys only (path, variant, split) -> batch id and
    position, ranked without a per-split single task.  Numbers go on from the
    records published ``before``, so an epoch changes no earlier one's ids; a batch
    that it left unfilled is filled."""
    from ..operators.batching import assign_batches, collect_batches

    spark = stored.sparkSession
    own = ledger.folder(f"{out}/batches", epoch)
    keys = stored.select("image_path", "augmentation_index", "split")
    assign_batches(keys, cfg, before=before).write.mode("overwrite").partitionBy("split").parquet(own)
    if cfg.assemble_batches:
        rows = stored.join(spark.read.parquet(own), ["image_path", "augmentation_index", "split"])
        members = ["image_path", "augmentation_index", "label", "image_shape", "image_flattened"]
        tensors = ledger.folder(f"{out}/batch_tensors", epoch)
        collect_batches(rows, members).write.mode("overwrite").partitionBy("split").parquet(tensors)


def write_document(ledger: Ledger, out: str, cfg: PipelineConfig) -> tuple[dict, str]:
    """The metadata document of the published tables, and its path."""
    spark = ledger.spark
    listing = ledger.read(f"{ledger.root}/{LISTING}", LISTING_SCHEMA)
    stored = ledger.read(ledger.root)
    if stored is None:  # no epoch has a record
        stored = spark.createDataFrame([], "image_path string, augmentation_index int, split string, label int")
    refused = ledger.read(f"{out}/rejects", REJECT_SCHEMA)
    rejected = refused.where("stage = 'decode'").count() if refused is not None else 0
    summary = Q.summary_from_counts(listing, stored, cfg).first().asDict()
    stats = None
    if cfg.track_statistics and "image_flattened" in stored.columns:
        st = ST.dataset_statistics(
            stored.select("split", "label", F.col("image_flattened").alias("data"),
                          F.col("image_shape")[0].alias("height"), F.col("image_shape")[1].alias("width"),
                          F.col("image_shape")[2].alias("channels")),
            channels=cfg.out_channels,
            engine=cfg.engine,
        )
        stats = [r.asDict() for r in st.collect()]  # one row per (split, label, channel)
    doc = Q.metadata_document(summary, cfg, rejected=rejected, statistics=stats)
    # files per (split folder, extension): the scan probe counts, one pass
    scan = ST.scan_counts(listing.select(F.col("image_path").alias("path")), "path")
    doc["scan_counts"] = {f"{r.split}/{r.extension}": r.n for r in scan.collect()}
    return doc, SK.write_metadata(spark, f"{out}/{cfg.metadata_file}", doc)


def refresh_metadata(spark: SparkSession, out_root: str, cfg: PipelineConfig) -> dict:
    """Recompute the metadata document from the published tables (after a
    streaming ingest run): never incremented."""
    out = out_root.rstrip("/")
    return write_document(Ledger(spark, f"{out}/parquet"), out, cfg)[0]
