"""Pipeline configuration: one frozen dataclass built on the driver.

Every value here ends up as a literal in a Spark plan (or as a constant
inside a batch kernel), so Catalyst can fold it.  The YAML layout is the
one the original job reads; keys it never read are honoured here too
(batching, data splits, TFRecord compression / shard size, Parquet row
group size, metadata file name, statistics tracking).
"""

from __future__ import annotations

import copy
import json
from dataclasses import asdict, dataclass, field, replace
from typing import Any

import yaml

NORMALIZATION_METHODS = ("min_max", "z_score", "none")
DENOISE_METHODS = ("gaussian", "median", "none")
COLOR_SPACES = ("RGB", "GRAYSCALE")
FEATURE_METHODS = ("histogram", "edges", "texture")

# The default class names and codes, and the file extensions
# the scan accepts (both cases, see the README).
DEFAULT_LABEL_ENCODING = (("NORMAL", 0), ("PNEUMONIA", 1))
DEFAULT_EXTENSIONS = ("jpeg", "jpg", "png")
DEFAULT_SPLIT_FOLDERS = ("train", "val", "validation", "test")


@dataclass(frozen=True)
class PipelineConfig:
    # image_processing
    target_width: int = 224
    target_height: int = 224
    color_space: str = "RGB"
    normalization: str = "min_max"
    norm_min: float = 0.0
    norm_max: float = 1.0
    # augmentation
    augmentation: bool = False
    rotation_range: float = 0.0
    horizontal_flip: bool = False
    vertical_flip: bool = False
    brightness_range: tuple[float, float] | None = None
    augmentation_factor: int = 2
    # denoising
    denoise: bool = False
    denoise_method: str = "gaussian"
    kernel_size: int = 3
    # features
    features: bool = False
    feature_methods: tuple[str, ...] = ()
    # batching
    batch_size: int = 32
    shuffle: bool = True
    seed: int = 42
    # data splits (ratio split, used for images without a split folder)
    split_train: float = 0.70
    split_validation: float = 0.15
    split_test: float = 0.15
    preserve_existing_splits: bool = True
    # "folder": split from the path only (unknown stays unknown, as the
    # original); "ratio": seeded ratio split for unknown (or all) images
    split_assignment: str = "folder"
    # labels, in match order
    label_encoding: tuple[tuple[str, int], ...] = DEFAULT_LABEL_ENCODING
    label_match: str = "path"  # "path" (whole path, as the original) | "parent_dir"
    # outputs
    tfrecord_enabled: bool = True
    tfrecord_compression: str | None = None  # None | "gzip"
    tfrecord_shard_size_mb: float = 100
    parquet_enabled: bool = True
    parquet_compression: str = "snappy"
    parquet_row_group_size_mb: int | None = None
    keep_nested_array: bool = False
    # W2, opt-in: also write assembled batches (one row per batch of up to
    # batch_size tensors); costs two shuffles of the tensors
    assemble_batches: bool = False
    examples_parquet: bool = False  # serialized examples as Parquet, too
    repartition_records: bool = False  # num_partitions shuffles the tensors
    # versioning
    version_tag: str = "v1.0"
    metadata_file: str = "metadata.json"
    track_parameters: bool = True
    track_statistics: bool = False
    # processing
    num_partitions: int | None = None  # optional repartition before the write
    extensions: tuple[str, ...] = DEFAULT_EXTENSIONS
    split_folders: tuple[str, ...] = DEFAULT_SPLIT_FOLDERS
    # per-pixel engine: "kernel" (one Arrow-batched NumPy stage) or "native"
    # (Catalyst array expressions; measured ~100x slower on 224x224x3)
    engine: str = "kernel"
    # numeric model
    round_u8: bool = True  # round to 0..255 after resize / gray / denoise (u8 input)
    # compatibility switches for the original's quirks
    brightness_mode: str = "clip_range"  # or "u8_compat"
    histogram_stage: str = "pre"  # "pre" normalisation, or "post" as the original
    raw_config: dict = field(default_factory=dict, compare=False, repr=False)

    # -- derived -----------------------------------------------------------
    @property
    def target_size(self) -> tuple[int, int]:
        """(width, height), the order the original metadata stores."""
        return (self.target_width, self.target_height)

    @property
    def out_channels(self) -> int:
        return 1 if self.color_space == "GRAYSCALE" else 3

    @property
    def fanout(self) -> int:
        """Rows per image: 1, or 1 + augmentation_factor."""
        return 1 + self.augmentation_factor if self.augmentation else 1

    def validate(self) -> "PipelineConfig":
        errors = []
        if self.target_width <= 0 or self.target_height <= 0:
            errors.append("target size must be positive")
        if self.color_space not in COLOR_SPACES:
            errors.append(f"color_space must be one of {COLOR_SPACES}")
        if self.denoise and (self.kernel_size < 1 or self.kernel_size % 2 == 0):
            errors.append("denoising.kernel_size must be odd and positive")
        if self.augmentation and self.augmentation_factor < 0:
            errors.append("augmentation_factor must be >= 0")
        if self.brightness_range is not None and len(self.brightness_range) != 2:
            errors.append("brightness_range must have two values")
        if self.rotation_range < 0:
            errors.append("rotation_range must be >= 0")
        if abs(self.split_train + self.split_validation + self.split_test - 1.0) > 1e-6:
            errors.append("data_splits must sum to 1")
        if self.batch_size <= 0:
            errors.append("batch_size must be positive")
        if self.brightness_mode not in ("clip_range", "u8_compat"):
            errors.append("brightness_mode must be clip_range or u8_compat")
        if self.histogram_stage not in ("pre", "post"):
            errors.append("histogram_stage must be pre or post")
        if self.label_match not in ("path", "parent_dir"):
            errors.append("label_match must be path or parent_dir")
        if self.split_assignment not in ("folder", "ratio"):
            errors.append("split_assignment must be folder or ratio")
        if self.engine not in ("kernel", "native"):
            errors.append("engine must be kernel or native")
        if self.tfrecord_compression not in (None, "gzip"):
            errors.append("tfrecord compression must be none or gzip")
        if errors:
            raise ValueError("invalid pipeline config: " + "; ".join(errors))
        return self

    def with_(self, **kw: Any) -> "PipelineConfig":
        return replace(self, **kw).validate()

    # -- parameters echoed into the metadata document ----------------------
    def normalization_params(self) -> dict:
        return {"method": self.normalization, "min_value": self.norm_min, "max_value": self.norm_max}

    def augmentation_params(self) -> dict:
        d = {
            "enabled": self.augmentation,
            "rotation_range": self.rotation_range,
            "horizontal_flip": self.horizontal_flip,
            "vertical_flip": self.vertical_flip,
            "augmentation_factor": self.augmentation_factor,
        }
        if self.brightness_range is not None:
            d["brightness_range"] = list(self.brightness_range)
        return d

    def denoising_params(self) -> dict:
        return {"enabled": self.denoise, "method": self.denoise_method, "kernel_size": self.kernel_size}

    def as_dict(self) -> dict:
        d = asdict(self)
        d.pop("raw_config", None)
        return json.loads(json.dumps(d, default=list))


def from_dict(cfg: dict | None) -> PipelineConfig:
    """Build a config from the YAML layout; missing keys take defaults."""
    cfg = copy.deepcopy(cfg or {})
    ip = cfg.get("image_processing", {}) or {}
    norm = ip.get("normalization", {}) or {}
    aug = ip.get("augmentation", {}) or {}
    den = ip.get("denoising", {}) or {}
    feat = ip.get("feature_extraction", {}) or {}
    bat = ip.get("batching", {}) or cfg.get("batching", {}) or {}
    splits = cfg.get("data_splits", {}) or {}
    outs = cfg.get("output_formats", {}) or {}
    tfr = outs.get("tfrecord", {}) or {}
    pq = outs.get("parquet", {}) or {}
    ver = cfg.get("versioning", {}) or {}
    proc = cfg.get("processing", {}) or {}
    labels = cfg.get("label_encoding") or dict(DEFAULT_LABEL_ENCODING)
    own = cfg.get("tessera", {}) or {}  # options of this engine (not in the original layout)
    br = aug.get("brightness_range")
    comp = tfr.get("compression")
    comp = None if comp in (None, "", "NONE", "none") else str(comp).lower()
    c = PipelineConfig(
        target_width=int(ip.get("target_width", 224)),
        target_height=int(ip.get("target_height", 224)),
        color_space=str(ip.get("color_space", "RGB")),
        normalization=str(norm.get("method", "min_max")),
        norm_min=float(norm.get("min_value", 0.0)),
        norm_max=float(norm.get("max_value", 1.0)),
        augmentation=bool(aug.get("enabled", False)),
        rotation_range=float(aug.get("rotation_range", 0) or 0),
        horizontal_flip=bool(aug.get("horizontal_flip", False)),
        vertical_flip=bool(aug.get("vertical_flip", False)),
        brightness_range=(float(br[0]), float(br[1])) if br is not None else None,
        augmentation_factor=int(aug.get("augmentation_factor", 2)),
        denoise=bool(den.get("enabled", False)),
        denoise_method=str(den.get("method", "gaussian")),
        kernel_size=int(den.get("kernel_size", 3)),
        features=bool(feat.get("enabled", False)),
        feature_methods=tuple(feat.get("methods", []) or ()),
        batch_size=int(bat.get("batch_size", 32)),
        shuffle=bool(bat.get("shuffle", True)),
        seed=int(bat.get("seed", 42)),
        split_train=float(splits.get("train", 0.70)),
        split_validation=float(splits.get("validation", 0.15)),
        split_test=float(splits.get("test", 0.15)),
        preserve_existing_splits=bool(splits.get("preserve_existing_splits", True)),
        split_assignment=str(splits.get("assignment", "folder")),
        label_encoding=tuple((str(k), int(v)) for k, v in labels.items()),
        tfrecord_enabled=bool(tfr.get("enabled", True)),
        tfrecord_compression=comp,
        tfrecord_shard_size_mb=float(tfr.get("shard_size_mb", 100)),
        parquet_enabled=bool(pq.get("enabled", True)),
        parquet_compression=str(pq.get("compression", "snappy")),
        parquet_row_group_size_mb=pq.get("row_group_size_mb"),
        version_tag=str(ver.get("version_tag", "v1.0")),
        metadata_file=str(ver.get("metadata_file", "metadata.json")),
        track_parameters=bool(ver.get("track_parameters", True)),
        track_statistics=bool(ver.get("track_statistics", False)),
        num_partitions=proc.get("num_partitions"),
        engine=str(own.get("engine", "kernel")),
        brightness_mode=str(own.get("brightness_mode", "clip_range")),
        histogram_stage=str(own.get("histogram_stage", "pre")),
        label_match=str(own.get("label_match", "path")),
        keep_nested_array=bool(own.get("keep_nested_array", False)),
        assemble_batches=bool(own.get("assemble_batches", False)),
        examples_parquet=bool(own.get("examples_parquet", False)),
        repartition_records=bool(own.get("repartition_records", False)),
        round_u8=bool(own.get("round_u8", True)),
        extensions=tuple(str(e).lower() for e in own.get("extensions", DEFAULT_EXTENSIONS)),
        split_folders=tuple(str(x) for x in own.get("split_folders", DEFAULT_SPLIT_FOLDERS)),
        raw_config=cfg,
    )
    return c.validate()


def default_config() -> PipelineConfig:
    """The configuration used when no file is given: min-max, augmentation on,
    both outputs on (the original's built-in default)."""
    return from_dict(
        {
            "image_processing": {
                "target_width": 224,
                "target_height": 224,
                "normalization": {"method": "min_max"},
                "augmentation": {"enabled": True},
            },
            "label_encoding": dict(DEFAULT_LABEL_ENCODING),
            "output_formats": {"tfrecord": {"enabled": True}, "parquet": {"enabled": True}},
        }
    )


def load_config(spark=None, path: str | None = None) -> PipelineConfig:
    """Read a YAML config from any Hadoop-readable path (local, HDFS, object
    store) through Spark's text reader, else fall back to the default."""
    if path is None:
        return default_config()
    if spark is None:
        with open(path) as f:
            return from_dict(yaml.safe_load(f))
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        raise ValueError(f"config file {path} is empty or missing")
    return from_dict(yaml.safe_load(text[0]))
