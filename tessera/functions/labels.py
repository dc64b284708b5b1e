"""Label, split and ratio-split expressions over a path column.

All of these are plain Catalyst expressions (no Python UDF), so a filter on
``label`` or ``split`` stays in the optimizer's view and can be pushed or
folded like any other predicate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import PipelineConfig
from .random import md5_uniform

UNKNOWN_LABEL = -1
UNKNOWN_SPLIT = "unknown"

# Split folder markers, tested in this order, and the split
# name each maps to.
SPLIT_MARKERS = (
    ("/train/", "train"),
    ("/val/", "validation"),
    ("/validation/", "validation"),
    ("/test/", "test"),
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def slash_path(path) -> Column:
    """Windows separators to '/', so one marker set serves both forms."""
    return F.translate(_col(path), "\\", "/")


def label_expr(path, cfg: PipelineConfig) -> Column:
    """Class code from the path; first configured class that matches wins.

    ``label_match="path"`` tests the whole upper-cased path for the class
    name (so a parent folder or a file name can decide, as the original
    does); ``"parent_dir"`` compares the immediate parent folder only.
    """
    p = _col(path)
    if cfg.label_match == "parent_dir":
        subject = F.upper(F.element_at(F.split(slash_path(p), "/"), -2))
        test = lambda name: subject == F.lit(name.upper())
    else:
        subject = F.upper(p)
        test = lambda name: subject.contains(name.upper())
    expr = None
    for name, code in cfg.label_encoding:
        expr = F.when(test(name), F.lit(int(code))) if expr is None else expr.when(test(name), F.lit(int(code)))
    if expr is None:
        return F.lit(UNKNOWN_LABEL)
    return expr.otherwise(F.lit(UNKNOWN_LABEL)).cast("int")


def split_expr(path) -> Column:
    """Split name from the folder markers; case-sensitive, else 'unknown'."""
    p = slash_path(path)
    expr = None
    for marker, name in SPLIT_MARKERS:
        expr = F.when(p.contains(marker), F.lit(name)) if expr is None else expr.when(p.contains(marker), F.lit(name))
    return expr.otherwise(F.lit(UNKNOWN_SPLIT))


def ratio_split_expr(path, cfg: PipelineConfig, existing: Column | None = None) -> Column:
    """Seeded ratio split on the image path (before any fan-out, so every
    variant of one image lands in one split).  With
    ``preserve_existing_splits`` a known folder split is kept."""
    u = md5_uniform(cfg.seed, _col(path))
    t1 = cfg.split_train
    t2 = cfg.split_train + cfg.split_validation
    assigned = F.when(u < F.lit(t1), "train").when(u < F.lit(t2), "validation").otherwise("test")
    if existing is not None and cfg.preserve_existing_splits:
        return F.when(existing != F.lit(UNKNOWN_SPLIT), existing).otherwise(assigned)
    return assigned


def extension_expr(path) -> Column:
    """Lower-cased file extension ('' when there is none)."""
    return F.lower(F.regexp_extract(_col(path), r"\.([^./\\]+)$", 1))


def normalise_path(path, percent_decode: bool) -> Column:
    """One spelling for a file URI: percent-decoded, single slash after
    ``file:``.  The image source reports ``file:///a/sp%20ace.png`` where
    the binary source reports ``file:/a/sp ace.png``; both become the
    latter.  Only the image source's form is percent-decoded."""
    p = _col(path)
    if percent_decode:
        # protect a literal '+' (url_decode would turn it into a space)
        p = F.url_decode(F.regexp_replace(p, r"\+", "%2B"))
    return F.regexp_replace(p, r"^file:/+", "file:/")
