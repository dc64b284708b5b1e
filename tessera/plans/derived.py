"""Queries over data Spark derives from the driver's tables and writes to
the shared scratch folder (``spark.checkpoint.dir``): real PNG files made
from the tiles, written record tables, TFRecord shards, metadata
documents and version folders.  Each call writes a fresh folder, so
results never depend on a previous run.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tensor as TN
from ..operators import encode as EN
from ..operators import imagestage as S
from ..operators import quality as Q
from ..session import scratch_path, ship_package
from ..sources import files as FS
from ..sources import tiles as TL
from ..streaming import ingest as ING
from . import catalog as C
from . import pipeline as PL
from . import sinks as SK
from .ledger import Ledger
from .run import REJECT_SCHEMA

# tile file trees already written in this SparkContext: (sf, scratch root) -> path
_TILE_FILES: dict[tuple[str, str], str] = {}

# The second version used by the catalog and diff checks: an extra class,
# one more variant, a narrower brightness range, PNG files left out.
V2_CFG = C.TILE_CFG.with_(
    version_tag="v1.1",
    label_encoding=(("NORMAL", 0), ("PNEUMONIA", 1), ("OTHER", 2)),
    augmentation_factor=3,
    brightness_range=(0.9, 1.1),
    extensions=("jpeg", "jpg"),
)


# The file job on tile PNGs: production engine, u8 rounding of decoded pixels.
FILE_CFG = C.TILE_CFG.with_(engine="kernel", round_u8=True)


def tile_files(spark: SparkSession, sf: str) -> str:
    """Write every u8 tile as ``{root}/{split}/{class}/img{id}.png`` once."""
    ship_package(spark)
    key = (sf, spark.sparkContext.getCheckpointDir() or "")
    if key not in _TILE_FILES:
        root = scratch_path(spark, "tile-images")
        TL.write_tile_images(TL.tile_image_layout(spark, sf), root).write.format("noop").mode("overwrite").save()
        _TILE_FILES[key] = root
    return _TILE_FILES[key]


def _rel(col: str, root: str):
    """Path relative to the tile root folder, whatever the URI spelling."""
    base = root.rstrip("/").rsplit("/", 1)[-1]
    return F.regexp_replace(F.col(col), "^.*/" + re.escape(base) + "/", "")


def q_image_scan(spark, sf):
    """S1 + S4: brace-glob scan, JVM decode, pixels to RGB."""
    root = tile_files(spark, sf)
    imgs = FS.read_images(spark, root, C.TILE_CFG).where(F.col("height") > 0).drop("mode")
    rgb = S.run_kernels(imgs, [])
    out = rgb.select(_rel("image_path", root).alias("rel_path"), "height", "width", "channels", "data")
    ex = out.select("rel_path", C._i64("height"), C._i64("width"), C._i64("channels"),
                    F.posexplode("data").alias("pos", "value"))
    return ex.select("rel_path", "height", "width", "channels", C._i64("pos"), TN.round6("value").alias("value"))


def q_scan_recursive(spark, sf):
    """S3: every sub-folder, extension filter only; files outside a split
    folder get split 'unknown'."""
    root = tile_files(spark, sf)
    files = FS.list_files(spark, root, C.TILE_CFG, recursive=True)
    lab = FS.labelled_files(files, C.TILE_CFG)
    return lab.select(_rel("image_path", root).alias("rel_path"), C._i64("label"), "split")


def q_stream_ingest(spark, sf):
    """R1: availableNow file stream -> same transforms -> exactly-once
    Parquet sink; the result is the ingested record keys."""
    root = tile_files(spark, sf)
    out = scratch_path(spark, "stream-records")
    ckpt = scratch_path(spark, "stream-checkpoint")
    ING.ingest(spark, root, out, ckpt, FILE_CFG)
    rec = SK.read_records(spark, out)
    return rec.select(
        _rel("image_path", root).alias("rel_path"),
        C._i64("augmentation_index"),
        "split",
        C._i64("label"),
        F.size("image_flattened").cast("bigint").alias("n_values"),
    )


def q_batch_then_ingest(spark, sf):
    """A batch run over half of the files, then ingest of the others into the
    same version: every record of both is read back."""
    from .run import run_pipeline

    root, out = scratch_path(spark, "grown-raw"), scratch_path(spark, "grown")
    tiles = TL.tile_image_layout(spark, sf)
    TL.write_tile_images(tiles.where("vec_id % 2 = 0"), root).count()
    cfg = FILE_CFG.with_(tfrecord_enabled=False)
    run_pipeline(spark, root, out, cfg)
    TL.write_tile_images(tiles.where("vec_id % 2 = 1"), root).count()
    ING.ingest(spark, root, f"{out}/parquet", scratch_path(spark, "grown-checkpoint"), cfg, out_root=out)
    return SK.read_records(spark, f"{out}/parquet").select(
        _rel("image_path", root).alias("rel_path"),
        C._i64("augmentation_index"),
        "split",
        C._i64("label"),
        F.size("image_flattened").cast("bigint").alias("n_values"),
    )


class _Lost(Exception):
    """The injected failure of ``ingest_after_failure``."""


def q_ingest_after_failure(spark, sf):
    """R1: a batch run over half of the files; the ingest of
    the others fails after each of its outputs in turn and is started again.  The
    records, examples, batch ids and rejects that a reader then finds, each row once."""
    from .run import run_pipeline

    root, out = scratch_path(spark, "failing-raw"), scratch_path(spark, "failing")
    checkpoint = scratch_path(spark, "failing-checkpoint")
    tiles = TL.tile_image_layout(spark, sf)
    TL.write_tile_images(tiles.where("vec_id % 2 = 0"), root).count()
    cfg = FILE_CFG.with_(tfrecord_enabled=True)
    run_pipeline(spark, root, out, cfg)
    TL.write_tile_images(tiles.where("vec_id % 2 = 1"), root).count()
    for step in ("listing", "records", "tfrecords", "batches", "rejects", "published"):

        def fail(name: str, step: str = step) -> None:
            if name == step:
                raise _Lost(name)

        try:
            ING.ingest(spark, root, f"{out}/parquet", checkpoint, cfg, out_root=out, on_output=fail)
        except Exception as e:  # Spark wraps the callback's error
            if "_Lost" not in str(e):
                raise
    ING.ingest(spark, root, f"{out}/parquet", checkpoint, cfg, out_root=out)
    ledger = Ledger(spark, f"{out}/parquet")
    records = SK.read_records(spark, f"{out}/parquet")
    keys = [_rel("image_path", root).alias("rel_path"), "split"]
    number = C._i64("augmentation_index").alias("n")
    examples = SK.read_tfrecords(spark, f"{out}/tfrecords", epochs=ledger.published())
    batches = ledger.read(f"{out}/batches")
    rejects = ledger.read(f"{out}/rejects", REJECT_SCHEMA).withColumn("split", FS.LB.split_expr(F.col("image_path")))
    parts = {
        "record": records.select(*keys, number),
        "example": examples.select(*keys, F.size("image").cast("bigint").alias("n")),
        "batch": batches.groupBy("split", "batch_id").count().select(F.lit("").alias("rel_path"), "split", C._i64("count").alias("n")),
        "reject": rejects.select(*keys, F.lit(-1).cast("bigint").alias("n")),
    }
    return reduce(DataFrame.unionByName, [d.select(F.lit(k).alias("kind"), "rel_path", "split", "n") for k, d in parts.items()])


def _damage(spark, root: str, rel_paths: DataFrame) -> None:
    """Overwrite image files with bytes that are no picture."""
    import pyarrow as pa

    from ..sources.tfrecord import fs_and_path

    def run(batches):
        for b in batches:
            for rel in b.column(0).to_pylist():
                fs, p = fs_and_path(f"{root}/{rel}")
                with fs.open_output_stream(p) as f:
                    f.write(b"no picture")
            yield pa.RecordBatch.from_arrays([b.column(0)], ["file"])

    TL.dealt(rel_paths, "rel_path").mapInArrow(run, "file string").count()


def q_reject_files(spark, sf):
    """P6: the job over image files of which some are damaged and some lie in
    folders of unknown classes; its rejects table."""
    from .run import run_pipeline

    root, out = scratch_path(spark, "damaged-raw"), scratch_path(spark, "damaged")
    tiles = TL.tile_image_layout(spark, sf)
    TL.write_tile_images(tiles, root).count()
    _damage(spark, root, tiles.where("vec_id % 7 = 3").select("rel_path"))
    res = run_pipeline(spark, root, out, FILE_CFG.with_(tfrecord_enabled=False))
    rejects = Ledger(spark, res.parquet).read(res.rejects, REJECT_SCHEMA)
    return rejects.select(_rel("image_path", root).alias("rel_path"), "stage", "reason")


def _record_keys(spark, path: str, root: str) -> DataFrame:
    return SK.read_records(spark, path).select(_rel("image_path", root).alias("rel_path"), "split", C._i64("label"), C._i64("augmentation_index"))


def q_limited_run(spark, sf):
    """L1: the job's quick mode on the first ten files by path."""
    from .run import run_pipeline

    root = tile_files(spark, sf)
    res = run_pipeline(spark, root, scratch_path(spark, "limited"), FILE_CFG.with_(tfrecord_enabled=False), max_images=10)
    return _record_keys(spark, res.parquet, root)


def q_multi_root_run(spark, sf):
    """U1: two raw roots as one dataset; files of equal relative path in both are
    two images."""
    from .run import run_pipeline

    base = scratch_path(spark, "several-roots")
    tiles = TL.tile_image_layout(spark, sf)
    TL.write_tile_images(tiles, f"{base}/v1.0").count()
    TL.write_tile_images(tiles.where("vec_id % 3 = 0"), f"{base}/v1.1").count()
    res = run_pipeline(spark, [f"{base}/v1.0", f"{base}/v1.1"], scratch_path(spark, "merged"), FILE_CFG.with_(tfrecord_enabled=False))
    keys = _record_keys(spark, res.parquet, base)
    return keys.withColumns({"root": F.split_part("rel_path", F.lit("/"), F.lit(1)), "rel_path": F.regexp_replace("rel_path", "^[^/]*/", "")})


def q_pipeline_files(spark, sf):
    """The whole file job (``run_pipeline``): PNG files -> JVM decode ->
    fused chain -> Parquet by split (+ TFRecord, rejects, metadata); the
    result is every stored value of every record."""
    from .run import run_pipeline

    root = tile_files(spark, sf)
    res = run_pipeline(spark, root, scratch_path(spark, "file-version"), FILE_CFG)
    rec = SK.read_records(spark, res.parquet).select(
        _rel("image_path", root).alias("rel_path"), C._i64("augmentation_index"), "split", C._i64("label"),
        "image_flattened",
    )
    return _float_long(rec, ["rel_path", "augmentation_index", "split", "label"], "image_flattened")


def _tile_records(spark, sf, cfg=C.TILE_CFG) -> DataFrame:
    """Stored-record form of the tiles, on the production (kernel) engine."""
    imgs = C._images(spark, sf, cfg).drop("vec_id")
    return PL.to_records(PL.process(imgs, cfg, at_target_size=True, engine="kernel"), cfg)


def _float_long(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    ex = df.select(*keys, F.posexplode(col).alias("pos", "value"))
    return ex.select(*keys, C._i64("pos"), TN.round6(F.col("value").cast("double")).alias("value"))


def q_parquet_roundtrip(spark, sf):
    """K1 + S5: write partitioned by split, read every split back."""
    path = scratch_path(spark, "records")
    SK.write_records(_tile_records(spark, sf), path, C.TILE_CFG.with_(parquet_row_group_size_mb=1))
    back = SK.read_records(spark, path)
    back = back.withColumn("augmentation_index", C._i64("augmentation_index")).withColumn("label", C._i64("label"))
    return _float_long(back, ["image_path", "augmentation_index", "split", "label"], "image_flattened")


def q_tfrecord_encode(spark, sf):
    """E1 + E2 + K2: records -> example bytes (written as Parquet by
    split) -> decoded fields."""
    path = scratch_path(spark, "examples-parquet")
    rec = _tile_records(spark, sf)
    ex = EN.encode_examples(rec)
    ex.write.mode("overwrite").partitionBy("split").parquet(path)
    dec = EN.decode_examples(spark.read.parquet(path))
    dec = dec.select(
        "image_path", C._i64("augmentation_index"), "split", "label",
        F.array_join("image_shape", ",").alias("image_shape"), "image",
    )
    return _float_long(dec, ["image_path", "augmentation_index", "split", "label", "image_shape"], "image")


def q_tfrecord_roundtrip(spark, sf):
    """K3 + K5 + E3 + S6: gzip TFRecord shards (small shard size, so tasks
    roll files) read back with CRC checks."""
    path = scratch_path(spark, "tfrecords")
    cfg = C.TILE_CFG.with_(tfrecord_compression="gzip", tfrecord_shard_size_mb=0.02)
    SK.write_tfrecords(_tile_records(spark, sf), path, cfg)
    back = SK.read_tfrecords(spark, path)
    back = back.select("image_path", "split", "label", F.array_join("image_shape", ",").alias("image_shape"), "image")
    return _float_long(back, ["image_path", "split", "label", "image_shape"], "image")


def q_validate_input(spark, sf):
    listing = C.labelled(spark, sf).select(F.col("path").alias("image_path"), "label", "split")
    return Q.validate_input(listing, C.TILE_CFG)


def write_version(spark, sf, cfg, out: str) -> str:
    """A whole tile version: records, TFRecord shards, metadata.json."""
    pq = f"{out}/parquet"
    SK.write_records(_tile_records(spark, sf, cfg), pq, cfg)
    stored = spark.read.parquet(pq)
    if cfg.tfrecord_enabled:
        SK.write_tfrecords(stored, f"{out}/tfrecords", cfg)
    listing = C.labelled(spark, sf, cfg).select(F.col("path").alias("image_path"), "label", "split")
    listing = listing.where(FS.LB.extension_expr("image_path").isin([e.lower() for e in cfg.extensions]))
    summary = Q.summary_from_counts(listing, stored, cfg).first().asDict()
    SK.write_metadata(spark, f"{out}/{cfg.metadata_file}", Q.metadata_document(summary, cfg))
    return out


def q_validate_output(spark, sf):
    out = write_version(spark, sf, C.TILE_CFG, scratch_path(spark, "version"))
    return Q.validate_output(spark, out, C.TILE_CFG)


def q_validate_output_faults(spark, sf):
    """V2: a version that lacks variants, has wrong shapes, lacks examples and
    claims more records than it has; and a version that isn't there."""
    out = scratch_path(spark, "damaged-version")
    cfg = C.TILE_CFG
    records = _tile_records(spark, sf)
    number = F.regexp_extract("image_path", r"img(\d+)\.", 1).cast("bigint")
    SK.write_metadata(spark, f"{out}/{cfg.metadata_file}", {"processed_images": records.count()})
    wrong = F.transform("image_shape", lambda n: n + 1)
    records = records.withColumn("image_shape", F.when(number % 4 == 0, wrong).otherwise(F.col("image_shape")))
    records = records.where((number % 5 != 0) | (F.col("augmentation_index") < 2))
    SK.write_records(records, f"{out}/parquet", cfg)
    SK.write_tfrecords(SK.read_records(spark, f"{out}/parquet", "train"), f"{out}/tfrecords", cfg)
    parts = {"damaged": out, "absent": scratch_path(spark, "no-version")}
    return reduce(DataFrame.unionByName, [Q.validate_output(spark, p, cfg).select(F.lit(k).alias("version"), "check", "ok", "n") for k, p in parts.items()])


def q_version_catalog(spark, sf):
    root = scratch_path(spark, "processed")
    for cfg in (C.TILE_CFG, V2_CFG):
        write_version(spark, sf, cfg.with_(tfrecord_enabled=False), f"{root}/{cfg.version_tag}")
    return Q.version_catalog(spark, root)


def q_version_diff(spark, sf):
    root = scratch_path(spark, "processed")
    paths = []
    for cfg in (C.TILE_CFG, V2_CFG):
        p = f"{root}/{cfg.version_tag}/parquet"
        SK.write_records(_tile_records(spark, sf, cfg), p, cfg)
        paths.append(p)
    old, new = (spark.read.parquet(p) for p in paths)
    d = Q.version_diff(old, new)
    return d.select("image_path", C._i64("augmentation_index"), "status")


QUERIES = {
    "pipeline_files": q_pipeline_files,
    "image_scan": q_image_scan,
    "scan_recursive": q_scan_recursive,
    "stream_ingest": q_stream_ingest,
    "batch_then_ingest": q_batch_then_ingest,
    "ingest_after_failure": q_ingest_after_failure,
    "parquet_roundtrip": q_parquet_roundtrip,
    "tfrecord_encode": q_tfrecord_encode,
    "tfrecord_roundtrip": q_tfrecord_roundtrip,
    "validate_input": q_validate_input,
    "validate_output": q_validate_output,
    "validate_output_faults": q_validate_output_faults,
    "reject_files": q_reject_files,
    "limited_run": q_limited_run,
    "multi_root_run": q_multi_root_run,
    "version_catalog": q_version_catalog,
    "version_diff": q_version_diff,
}
