"""Counts and statistics over image / record tables.

All of these aggregate keys or per-image partial sums: tensors are reduced
inside their row first (``aggregate``), so the shuffle carries a few numbers
per image, never pixels.  Spark's partial aggregation (map-side combine)
means a hot split or label costs one row per task, not one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as LB
from ..functions import tensor as TN


def count_by(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def scan_counts(files: DataFrame, path_col: str = "path") -> DataFrame:
    """Files per (split folder, extension), one pass over the listing."""
    p = F.col(path_col)
    return count_by(files.select(LB.split_expr(p).alias("split"), LB.extension_expr(p).alias("extension")),
                    "split", "extension")


def metadata_counts(records: DataFrame) -> DataFrame:
    """Records per split, per label and in total, as one grouping-sets
    aggregate (one scan instead of three jobs)."""
    return (
        records.groupingSets([["split"], ["label"], []], "split", "label")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.grouping("split").alias("g_split"),
            F.grouping("label").alias("g_label"),
        )
        .select(
            F.when((F.col("g_split") == 0), F.lit("split"))
            .when(F.col("g_label") == 0, F.lit("label"))
            .otherwise(F.lit("total"))
            .alias("grouping_set"),
            "split",
            # NULL where the row is not grouped by label; text keeps the column
            # free of nullable integers
            F.col("label").cast("string").alias("label"),
            "n",
        )
    )


def _batch_histograms(channels: int, data_col: str):
    import numpy as np
    import pyarrow as pa

    def run(batches):
        total = np.zeros((channels, 256), dtype=np.int64)
        seen = False
        for b in batches:
            if b.num_rows == 0:
                continue
            col = b.column(b.schema.get_field_index(data_col))
            v = col.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
            offs = col.offsets.to_numpy()
            v = v[offs[0] : offs[-1]].reshape(-1, channels)
            ok = (v >= 0) & (v < 256)
            for c in range(channels):
                total[c] += np.bincount(np.floor(v[ok[:, c], c]).astype(np.int64), minlength=256)[:256]
            seen = True
        if seen:  # one partial histogram per task
            ch, bins = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ch.astype(np.int64)), pa.array(bins.astype(np.int64)), pa.array(total[ch, bins])],
                ["channel", "bin", "cnt"],
            )

    return run


def histogram_dataset(images: DataFrame, channels: int, data_col: str = "data", engine: str = "native") -> DataFrame:
    """Dataset-wide 256-bin histogram per channel.

    ``native``: pixels are exploded inside the task and pre-aggregated
    map-side.  ``kernel``: each task sums its images' histograms in NumPy
    and emits at most channels * 256 rows (no per-pixel rows at all).
    Either way the shuffle carries a few hundred rows per task."""
    if engine == "kernel":
        from pyspark.sql import types as T

        from ..session import ship_package

        ship_package(images.sparkSession)
        schema = T.StructType(
            [T.StructField("channel", T.LongType()), T.StructField("bin", T.LongType()), T.StructField("cnt", T.LongType())]
        )
        part = images.select(data_col).mapInArrow(_batch_histograms(channels, data_col), schema)
        return part.groupBy("channel", "bin").agg(F.sum("cnt").cast("bigint").alias("cnt"))
    ex = images.select(F.posexplode(data_col).alias("pos", "v"))
    ex = ex.where((F.col("v") >= 0) & (F.col("v") < 256))
    return (
        ex.groupBy((F.col("pos") % channels).cast("bigint").alias("channel"), F.floor("v").cast("bigint").alias("bin"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def _partial_sums_batches(channels: int, group_cols: tuple[str, ...], data_col: str, arrow_schema):
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            col = b.column(b.schema.get_field_index(data_col))
            offs = col.offsets.to_numpy()
            vals = col.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
            out = {g: [] for g in group_cols}
            out.update(shape=[], channel=[], n=[], s1=[], s2=[], mn=[], mx=[])
            keys = {g: b.column(b.schema.get_field_index(g)).to_pylist() for g in group_cols}
            hs = b.column(b.schema.get_field_index("height")).to_pylist()
            ws = b.column(b.schema.get_field_index("width")).to_pylist()
            cs = b.column(b.schema.get_field_index("channels")).to_pylist()
            for i in range(n):
                v = vals[offs[i] : offs[i + 1]].reshape(-1, channels)
                for c in range(channels):
                    x = v[:, c]
                    for g in group_cols:
                        out[g].append(keys[g][i])
                    out["shape"].append(f"{hs[i]},{ws[i]},{cs[i]}")
                    out["channel"].append(c)
                    out["n"].append(x.size)
                    out["s1"].append(float(x.sum()))
                    out["s2"].append(float((x * x).sum()))
                    out["mn"].append(float(x.min()) if x.size else None)
                    out["mx"].append(float(x.max()) if x.size else None)
            yield pa.RecordBatch.from_pydict(out, schema=arrow_schema)

    return run


def dataset_statistics(
    images: DataFrame, channels: int, group_cols=("split", "label"), data_col: str = "data", engine: str = "native"
) -> DataFrame:
    """Per group and channel: images, values, mean, population std, min,
    max, distinct shapes; from per-image partial sums.

    ``engine="kernel"`` computes the partial sums in one Arrow-batched
    NumPy pass (for full-size stored tensors); ``"native"`` uses Catalyst
    ``aggregate``.  Either way only five numbers per image and channel
    reach the shuffle."""
    if engine == "kernel":
        from pyspark.sql import types as T

        from ..session import ship_package

        ship_package(images.sparkSession)
        fields = [images.schema[g] for g in group_cols] + [
            T.StructField("shape", T.StringType()),
            T.StructField("channel", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("s1", T.DoubleType()),
            T.StructField("s2", T.DoubleType()),
            T.StructField("mn", T.DoubleType()),
            T.StructField("mx", T.DoubleType()),
        ]
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = T.StructType(fields)
        src = images.select(*group_cols, "height", "width", "channels", data_col)
        fn = _partial_sums_batches(channels, tuple(group_cols), data_col, to_arrow_schema(schema))
        ps = src.mapInArrow(fn, schema)
        img = ps.select(
            *group_cols, "shape", F.struct("channel", F.struct("n", "s1", "s2", "mn", "mx").alias("ps")).alias("pc")
        )
        return _finish_statistics(img, group_cols)
    d = F.col(data_col)
    per_channel = F.array(
        *[
            F.struct(
                F.lit(c).cast("bigint").alias("channel"),
                TN.partial_sums(F.filter(d, lambda x, i: i % channels == c)).alias("ps"),
            )
            for c in range(channels)
        ]
    )
    img = images.select(
        *group_cols,
        F.concat_ws(",", "height", "width", "channels").alias("shape"),
        F.explode(per_channel).alias("pc"),
    )
    return _finish_statistics(img, group_cols)


def _finish_statistics(img: DataFrame, group_cols) -> DataFrame:
    g = img.groupBy(*group_cols, F.col("pc.channel").alias("channel")).agg(
        F.count(F.lit(1)).alias("n_images"),
        F.sum("pc.ps.n").alias("n_values"),
        F.sum("pc.ps.s1").alias("s1"),
        F.sum("pc.ps.s2").alias("s2"),
        F.min("pc.ps.mn").alias("v_min"),
        F.max("pc.ps.mx").alias("v_max"),
        # distinct shapes per group: a handful after resizing, so the set is small
        F.size(F.collect_set("shape")).alias("n_shapes"),
    )
    mean = F.col("s1") / F.col("n_values")
    return g.select(
        *group_cols,
        "channel",
        "n_images",
        "n_values",
        TN.round6(mean).alias("v_mean"),
        TN.round6(F.sqrt(F.greatest(F.col("s2") / F.col("n_values") - mean * mean, F.lit(0.0)))).alias("v_std"),
        TN.round6("v_min").alias("v_min"),
        TN.round6("v_max").alias("v_max"),
        F.col("n_shapes").cast("bigint").alias("n_shapes"),
    )
