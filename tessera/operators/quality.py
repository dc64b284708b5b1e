"""Run metadata, input / output validation and version comparison.

Every check is a DataFrame aggregate; the driver only sees the final,
fixed-size rows (a handful of counts), never the data.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig


def _json_object(entries) -> F.Column:
    """to_json of a small map built from (key, value) structs, keys sorted."""
    return F.to_json(F.map_from_entries(F.sort_array(F.filter(entries, lambda e: e.isNotNull()))))


def summary_from_counts(files: DataFrame, records: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """One-row run summary.

    ``files``: one row per scanned file with ``label`` (-1 unknown);
    ``records``: one row per output record with ``split`` and ``label``.
    Both are counted by split and label, one grouping-sets aggregate sums the
    union of the counts, and the few resulting rows are folded into JSON objects.
    """
    label = F.col("label").cast("int").alias("label")
    f = files.groupBy(label).agg(F.count(F.lit(1)).alias("c"))
    f = f.select(F.lit("file").alias("kind"), F.lit(None).cast("string").alias("split"), "label", "c")
    r = records.groupBy("split", label).agg(F.count(F.lit(1)).alias("c"))
    r = r.select(F.lit("record").alias("kind"), "split", "label", "c")
    counts = (
        f.unionByName(r)
        .groupingSets([["kind"], ["kind", "split"], ["kind", "label"]], "kind", "split", "label")
        .agg(
            F.sum("c").alias("n"),
            F.coalesce(F.sum(F.when(F.col("label") >= 0, F.col("c"))), F.lit(0)).alias("n_known"),
            F.grouping("split").alias("gs"),
            F.grouping("label").alias("gl"),
        )
    )
    is_total = (F.col("gs") == 1) & (F.col("gl") == 1)
    rec = F.col("kind") == "record"
    row = counts.agg(
        F.sum(F.when((F.col("kind") == "file") & is_total, F.col("n"))).alias("total_files"),
        F.sum(F.when((F.col("kind") == "file") & is_total, F.col("n_known"))).alias("total_images"),
        F.sum(F.when(rec & is_total, F.col("n"))).alias("processed_images"),
        _json_object(
            F.collect_list(F.when(rec & (F.col("gs") == 0), F.struct(F.col("split"), F.col("n"))))
        ).alias("splits"),
        _json_object(
            F.collect_list(
                F.when(rec & (F.col("gl") == 0), F.struct(F.col("label").cast("string").alias("label"), F.col("n")))
            )
        ).alias("labels"),
    )
    return row.select(
        F.lit(cfg.version_tag).alias("version"),
        F.coalesce(F.col("total_files"), F.lit(0)).cast("bigint").alias("total_files"),
        F.coalesce(F.col("total_images"), F.lit(0)).cast("bigint").alias("total_images"),
        F.coalesce(F.col("processed_images"), F.lit(0)).cast("bigint").alias("processed_images"),
        (F.coalesce(F.col("total_files"), F.lit(0)) - F.coalesce(F.col("total_images"), F.lit(0)))
        .cast("bigint")
        .alias("unknown_label_files"),
        "splits",
        "labels",
        F.lit(json.dumps([cfg.target_width, cfg.target_height], separators=(",", ":"))).alias("image_shape"),
        F.lit(cfg.normalization).alias("normalization"),
    )


def metadata_document(summary_row: dict, cfg: PipelineConfig, rejected: int | None = None, statistics=None) -> dict:
    """The metadata JSON document from the one-row summary (driver side;
    the row is a fixed handful of numbers)."""
    doc = {
        "version": summary_row["version"],
        "total_files": summary_row["total_files"],
        "total_images": summary_row["total_images"],
        "processed_images": summary_row["processed_images"],
        "splits": json.loads(summary_row["splits"] or "{}"),
        "labels": json.loads(summary_row["labels"] or "{}"),
        "image_shape": [cfg.target_width, cfg.target_height],
    }
    if rejected is not None:
        doc["rejected_images"] = rejected
    if cfg.track_parameters:
        doc["config"] = cfg.raw_config or cfg.as_dict()
        doc["processing_parameters"] = {
            "normalization": cfg.normalization_params(),
            "augmentation": cfg.augmentation_params(),
            "denoising": cfg.denoising_params(),
        }
    if statistics is not None:
        doc["statistics"] = statistics
    return doc


def _checks(row_df: DataFrame, specs: list[tuple[str, str, str]]) -> DataFrame:
    """Unpivot a one-row DataFrame of numbers into (check, ok, n) rows.
    specs: (check name, ok expression, n expression) in SQL over the row."""
    parts = []
    for name, ok_sql, n_sql in specs:
        parts.append(
            row_df.select(
                F.lit(name).alias("check"), F.expr(ok_sql).cast("boolean").alias("ok"), F.expr(n_sql).cast("bigint").alias("n")
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate_input(listing: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Checks on a labelled file listing (image_path, label, split): files
    present, known classes, known split folders, accepted extensions."""
    from ..functions.labels import extension_expr

    exts = [e.lower() for e in cfg.extensions]
    row = listing.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("label") >= 0).alias("known_labels"),
        F.count_if(F.col("split") != "unknown").alias("known_splits"),
        F.count_if(extension_expr("image_path").isin(exts)).alias("accepted_ext"),
    )
    return _checks(
        row,
        [
            ("files_present", "files > 0", "files"),
            ("known_labels", "known_labels > 0", "known_labels"),
            ("known_splits", "known_splits > 0", "known_splits"),
            ("accepted_extensions", "accepted_ext = files", "accepted_ext"),
        ],
    )


def _metadata_count(spark, path: str) -> DataFrame:
    """meta_n: the metadata document's record count, null if there is no
    readable document."""
    from ..plans.sinks import read_metadata

    try:
        doc = read_metadata(spark, path)
    except AnalysisException:
        doc = None
    if doc is None or "processed_images" not in doc.columns:
        return spark.range(1).select(F.lit(None).cast("bigint").alias("meta_n"))
    return doc.select(F.col("processed_images").cast("bigint").alias("meta_n"))


def _stored_records(spark, path: str) -> DataFrame | None:
    from ..plans.sinks import read_records

    try:
        return read_records(spark, path)
    except (AnalysisException, ValueError):
        return None


def example_count(spark, path: str, epochs: list[str] | None = None) -> DataFrame:
    """ex_n: the examples of a TFRecord folder, or of its published epochs, by its
    manifest, which the reader holds each shard against; without a manifest by reading them.  No row if the
    folder is missing."""
    from ..plans.sinks import read_tfrecords
    from ..sources import shardlog
    from ..sources.tfrecord import fs_and_path, shards

    fs, base = fs_and_path(path.rstrip("/"))
    if fs.get_file_info(base).type.name == "NotFound":
        return spark.createDataFrame([], "ex_n bigint")
    if shardlog.current(fs, base) is not None:
        return shards(spark, path, epochs).agg(F.coalesce(F.sum("records"), F.lit(0)).alias("ex_n"))
    return read_tfrecords(spark, path, raw=True).agg(F.count(F.lit(1)).alias("ex_n"))


def validate_output(spark, out_root: str, cfg: PipelineConfig, *, check_tensors: bool = True) -> DataFrame:
    """Checks on a written version: metadata readable, record count equals
    the metadata count, example count equals the record count, every image
    has 1 + n variants, every tensor's size equals the product of its
    shape.  An output that is missing fails its checks.  Without the Parquet
    output (``parquet.enabled``) the examples are held against the metadata.  All
    counts are Spark aggregates over the written files."""
    from ..plans.ledger import Ledger, has_ledger

    out = out_root.rstrip("/")
    parts = [_metadata_count(spark, f"{out}/{cfg.metadata_file}")]
    specs = [("metadata_present", "meta_n is not null", "coalesce(meta_n, 0)")]
    if cfg.parquet_enabled:
        specs += [
            ("records_match_metadata", "coalesce(rec_n = meta_n, false)", "coalesce(rec_n, 0)"),
            ("variants_per_image", "coalesce(bad_variants = 0, false)", "coalesce(bad_variants, 0)"),
            ("tensor_size_matches_shape", "coalesce(bad_size = 0, false)", "coalesce(bad_size, 0)"),
        ]
        stored = _stored_records(spark, f"{out}/parquet")
        if stored is not None:
            shape_prod = F.aggregate("image_shape", F.lit(1).cast("bigint"), lambda acc, x: acc * x)
            bad_size = F.count_if(F.size("image_flattened") != shape_prod) if check_tensors else F.lit(0).cast("bigint")
            parts.append(stored.agg(F.count(F.lit(1)).alias("rec_n"), bad_size.alias("bad_size")))
            per_img = stored.groupBy("image_path").agg(F.count(F.lit(1)).alias("k"))
            parts.append(per_img.agg(F.count_if(F.col("k") != cfg.fanout).alias("bad_variants")))
    if cfg.tfrecord_enabled:
        epochs = Ledger(spark, f"{out}/parquet").published() if has_ledger(spark, f"{out}/parquet") else None
        parts.append(example_count(spark, f"{out}/tfrecords", epochs))
        held = "rec_n" if cfg.parquet_enabled else "meta_n"
        name = "examples_match_records" if cfg.parquet_enabled else "examples_match_metadata"
        specs.append((name, f"coalesce(ex_n = {held}, false)", "coalesce(ex_n, 0)"))
    columns = ("meta_n", "rec_n", "bad_size", "bad_variants", "ex_n")
    none = spark.createDataFrame([], ", ".join(f"{c} bigint" for c in columns))
    allrow = none
    for p in parts:
        allrow = allrow.unionByName(p, allowMissingColumns=True)
    return _checks(allrow.agg(*[F.max(c).alias(c) for c in columns]), specs)


def version_catalog(spark, processed_root: str, metadata_file: str = "metadata.json") -> DataFrame:
    """One row per version folder ``{root}/{tag}/{metadata_file}``."""
    docs = spark.read.option("multiLine", True).json(f"{processed_root.rstrip('/')}/*/{metadata_file}")
    tag = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return docs.select(
        tag.alias("version_tag"),
        F.col("version"),
        F.col("total_files").cast("bigint").alias("total_files"),
        F.col("total_images").cast("bigint").alias("total_images"),
        F.col("processed_images").cast("bigint").alias("processed_images"),
    )


def version_diff(old: DataFrame, new: DataFrame, key=("image_path", "augmentation_index")) -> DataFrame:
    """added / removed / changed / unchanged per record key.  Each side is
    reduced to (key, 64-bit tensor hash, label) before the full outer join,
    so the shuffle carries a few bytes per record, not the tensors."""

    def side(df, sfx):
        return df.select(
            *key,
            F.xxhash64("image_flattened", "image_shape").alias(f"h{sfx}"),
            F.col("label").alias(f"l{sfx}"),
        )

    j = side(old, "_old").join(side(new, "_new"), list(key), "full_outer")
    status = (
        F.when(F.col("h_old").isNull(), F.lit("added"))
        .when(F.col("h_new").isNull(), F.lit("removed"))
        .when((F.col("h_old") != F.col("h_new")) | ~F.col("l_old").eqNullSafe(F.col("l_new")), F.lit("changed"))
        .otherwise(F.lit("unchanged"))
    )
    return j.select(*key, status.alias("status"))
