"""Incremental ingest of newly arrived images (Structured Streaming).

The weekly batch becomes a file stream: the checkpoint remembers which
files were processed, so each run (``trigger(availableNow=True)``) picks up
only new uploads and applies the same transforms.

The stream carries the file listing only, no content.  A micro-batch's paths
are compared, keys against keys, with those of the published epochs (a batch run
may have taken some), the new ones are decoded, and all outputs are written as one
epoch of the record table's ledger: listing, records, shards, batch ids, rejects,
and at last the publication.  The epoch is named after the stream and the
micro-batch, so a micro-batch that failed between any two outputs is written again
in place, and one that was published before Spark noted its end is left alone:
every output holds each image once, whenever the run was interrupted.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions import labels as LB
from ..plans import pipeline as PL
from ..plans.ledger import LISTING, Ledger
from ..session import ship_package
from ..sources import files as FS

#: files of a micro-batch unless told: their paths are on the driver, as they
#: are in the file stream itself
MAX_FILES = 50_000

LISTED = "path string, modificationTime timestamp, length bigint, content binary"


def listing_stream(spark: SparkSession, raw_root: str, cfg: PipelineConfig, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """(path, length) of new files; contents aren't read."""
    r = spark.readStream.format("binaryFile").schema(LISTED).option("pathGlobFilter", FS.extension_glob(cfg))
    r = r.option("maxFilesPerTrigger", int(max_files_per_trigger or MAX_FILES))
    return r.load(FS.image_glob(raw_root, cfg)).select(LB.normalise_path(F.col("path"), percent_decode=False).alias("path"), "length")


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The id that the stream's checkpoint keeps over restarts."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    f = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        return json.loads(bytes(f.readAllBytes()).decode())["id"].replace("-", "")[:16]
    finally:
        f.close()


def ingest(
    spark: SparkSession,
    raw_root: str,
    records_path: str,
    checkpoint: str,
    cfg: PipelineConfig,
    *,
    out_root: str | None = None,
    max_files_per_trigger: int | None = None,
    on_output: Callable[[str], None] = lambda name: None,
):
    """Process every image not seen before into epochs of ``records_path``; with
    ``out_root`` also its rejects, batch ids and, if configured, TFRecord shards.
    ``on_output`` is called with each output's name when it is complete.  Returns
    the finished StreamingQuery."""
    ship_package(spark)
    from ..plans import run as R

    root = FS.qualified_root(spark, raw_root)
    ledger, out = Ledger(spark, records_path), out_root.rstrip("/") if out_root else None

    def write(batch: DataFrame, number: int) -> None:
        epoch = f"s{stream_name(spark, checkpoint)}-{number:08d}"
        if epoch in ledger.published():
            R.show_epoch(out, cfg, epoch, False)
            return
        # the stream lists a file twice if its name looks like a pattern
        listing = FS.labelled_files(batch.dropDuplicates(["path"]), cfg, root_qualified=root)
        before = ledger.read(f"{ledger.root}/{LISTING}", R.LISTING_SCHEMA)
        if before is not None:
            listing = listing.join(before.select("image_path"), "image_path", "left_anti")
        paths = [r.image_path for r in PL.known_labels(listing).select("image_path").collect()]  # of one micro-batch
        images = None
        if paths:
            images = FS.read_paths(spark, paths).withColumn("seed_key", FS.relative_key("image_path", root))
            images = PL.with_label_split(images, cfg, key_col="seed_key").where(F.col("height") > 0).drop("mode")
        R.write_epoch(ledger, epoch, out, cfg, listing, images, on_output=on_output)

    # the stream's session is a copy, made at its start, of this one
    with FS.many_small_files(spark):
        new = listing_stream(spark, raw_root, cfg, max_files_per_trigger=max_files_per_trigger)
        q = new.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
    return q
