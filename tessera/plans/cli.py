"""Command line: ``spark-submit -m tessera.plans.cli`` or ``python -m tessera.plans.cli``.

    --raw-path P            raw image root ({split}/{class}/{file}); repeat it for several roots as one dataset
    --output-path P         output root (parquet/, tfrecords/, rejects/, metadata.json)
    --bucket-root R --tag T raw = R/raw/T, output = R/processed/T (version-tagged layout)
    --config-path P         YAML config on any Hadoop-readable path (else the built-in default)
    --recursive             scan every sub-folder (split from the path, 'unknown' otherwise)
    --max-images N          first N files by path (quick runs)
    --splits a,b            scan only these split folders (a narrower glob, nothing else is listed)
    --stream --checkpoint C incremental ingest of new files only (availableNow)
    --max-files-per-trigger N  bound each streaming micro-batch
    --validate              print input checks before and output checks after the run
    --no-tensor-check       with --validate: skip the size check that re-reads every tensor
"""

from __future__ import annotations

import argparse
import json
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..config import load_config
from ..operators import quality as Q
from ..session import ship_package
from ..sources import files as FS
from . import run as R


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tessera")
    ap.add_argument("--raw-path", action="append")
    ap.add_argument("--output-path")
    ap.add_argument("--bucket-root")
    ap.add_argument("--tag")
    ap.add_argument("--config-path")
    ap.add_argument("--recursive", action="store_true")
    ap.add_argument("--max-images", type=int)
    ap.add_argument("--stream", action="store_true")
    ap.add_argument("--checkpoint")
    ap.add_argument("--splits")
    ap.add_argument("--max-files-per-trigger", type=int)
    ap.add_argument("--validate", action="store_true")
    ap.add_argument("--no-tensor-check", action="store_true")
    a = ap.parse_args(argv)
    raw, out = a.raw_path, a.output_path
    if a.bucket_root and a.tag:
        raw = raw or [R.raw_path(a.bucket_root, a.tag)]
        out = out or R.processed_path(a.bucket_root, a.tag)
    if not raw or not out:
        ap.error("give --raw-path and --output-path, or --bucket-root and --tag")
    spark = SparkSession.builder.appName("tessera").getOrCreate()
    ship_package(spark)
    cfg = load_config(spark, a.config_path)
    if a.splits:
        cfg = cfg.with_(split_folders=tuple(x.strip() for x in a.splits.split(",") if x.strip()))
    if a.validate:
        files = reduce(DataFrame.unionByName, [FS.list_files(spark, r, cfg, recursive=a.recursive) for r in R.roots_of(raw)])
        listing = FS.labelled_files(files, cfg)
        for r in Q.validate_input(listing, cfg).collect():
            print(json.dumps(r.asDict()))
    if a.stream:
        if not a.checkpoint:
            ap.error("--stream needs --checkpoint")
        if len(raw) > 1:
            ap.error("--stream takes one --raw-path; run one stream for each root")
        from ..streaming.ingest import ingest

        ingest(spark, raw[0], f"{out.rstrip('/')}/parquet", a.checkpoint, cfg, out_root=out,
               max_files_per_trigger=a.max_files_per_trigger)
        doc = R.refresh_metadata(spark, out, cfg)
        print(json.dumps({k: v for k, v in doc.items() if k != "config"}, default=str))
        return 0
    res = R.run_pipeline(spark, raw, out, cfg, recursive=a.recursive, max_images=a.max_images)
    print(json.dumps({k: v for k, v in res.document.items() if k != "config"}, default=str))
    if a.validate:
        for r in Q.validate_output(spark, out, cfg, check_tensors=not a.no_tensor_check).collect():
            print(json.dumps(r.asDict()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
