"""Image tables derived from the ``embeddings`` table.

The driver's tables hold no image files, so the tensor operators are
exercised on tiles cut from the 64-long embedding vectors:

* ``T``   8x8x1 continuous tile, pixel (y, x) at index y*8 + x
* ``T8``  the same as 0..255 levels: ``floor((e + 1) * 127.5)``
* ``T3``  8x8x3 RGB tile from all 64 levels of ``T8``: as they are, reversed,
          and shifted by one
* ``P``   a synthetic image path per vector (split folder, class folder,
          extension), so path-driven operators see every case.

All of these are projections of the scanned table (no shuffle), so they
grow with it and keep its partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: tasks a core of steps that write a file for each row
_TASKS_A_CORE = 4


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def synthetic_path(vec_id: Column, label: Column) -> Column:
    """raw/v1.0/{split folder}/{class folder}/img{id}.{ext}"""
    folder = (
        F.when(vec_id % 10 < 6, "train")
        .when(vec_id % 10 == 6, "val")
        .when(vec_id % 10 == 7, "validation")
        .when(vec_id % 10 == 8, "test")
        .otherwise("holdout")
    )
    klass = (
        F.when(label < 5, "NORMAL").when(label < 8, "PNEUMONIA").when(label == 8, "other").otherwise("Pneumonia")
    )
    ext = F.when(vec_id % 3 == 0, "jpeg").when(vec_id % 3 == 1, "jpg").otherwise("png")
    return F.concat(F.lit("raw/v1.0/"), folder, F.lit("/"), klass, F.lit("/img"), vec_id.cast("string"), F.lit("."), ext)


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P: (vec_id, path)."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", synthetic_path(F.col("vec_id"), F.col("label")).alias("path"))


def tiles(spark: SparkSession, sf_dir: str, *, with_path: bool = True) -> DataFrame:
    """T: (vec_id, [path,] height=8, width=8, channels=1, data array<double>)."""
    e = read_table(spark, sf_dir, "embeddings")
    cols = [F.col("vec_id")]
    if with_path:
        cols.append(synthetic_path(F.col("vec_id"), F.col("label")).alias("path"))
    return e.select(
        *cols,
        F.lit(8).alias("height"),
        F.lit(8).alias("width"),
        F.lit(1).alias("channels"),
        F.transform("embedding", lambda x: x.cast("double")).alias("data"),
    )


def u8_levels(arr: Column) -> Column:
    return F.transform(arr, lambda x: F.floor((x.cast("double") + F.lit(1.0)) * F.lit(127.5)).cast("double"))


def tiles_u8(spark: SparkSession, sf_dir: str, *, with_path: bool = True) -> DataFrame:
    """T8: 8x8x1 tile of 0..255 levels."""
    t = tiles(spark, sf_dir, with_path=with_path)
    return t.withColumn("data", u8_levels(F.col("data")))


def tiles_rgb(spark: SparkSession, sf_dir: str, *, with_path: bool = True) -> DataFrame:
    """T3: 8x8x3 RGB tile; the channels of pixel p are levels p, 63 - p and
    (p + 1) mod 64 of T8."""
    return rgb_channels(tiles_u8(spark, sf_dir, with_path=with_path))


def rgb_channels(t: DataFrame) -> DataFrame:
    """One-channel tiles as three channels: the values, reversed, shifted."""
    shifted = F.concat(F.slice("data", F.lit(2), F.size("data") - 1), F.slice("data", 1, 1))
    zipped = F.arrays_zip(F.col("data").alias("r"), F.reverse("data").alias("g"), shifted.alias("b"))
    data = F.flatten(F.transform(zipped, lambda p: F.array(p["r"], p["g"], p["b"])))
    return t.withColumns({"channels": F.lit(3), "data": data})


def _write_png_batches(root: str):
    import pyarrow as pa

    from ..functions.png import encode_png
    from .tfrecord import fs_and_path

    def run(batches):
        for b in batches:
            rels = b.column(b.schema.get_field_index("rel_path")).to_pylist()
            data = b.column(b.schema.get_field_index("data"))
            hs = b.column(b.schema.get_field_index("height")).to_pylist()
            ws = b.column(b.schema.get_field_index("width")).to_pylist()
            cs = b.column(b.schema.get_field_index("channels")).to_pylist()
            offs = data.offsets.to_numpy()
            vals = data.values.to_numpy(zero_copy_only=False)
            out = []
            for i, rel in enumerate(rels):
                px = vals[offs[i] : offs[i + 1]].reshape(hs[i], ws[i], cs[i])
                path = f"{root}/{rel}"
                fs, p = fs_and_path(path)
                fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
                # deterministic name and bytes: a retried task rewrites the same file
                with fs.open_output_stream(p) as f:
                    f.write(encode_png(px[:, :, 0] if cs[i] == 1 else px))
                out.append(path)
            yield pa.RecordBatch.from_arrays([pa.array(out, type=pa.string())], ["file"])

    return run


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by a key for work that costs far more than its bytes say."""
    return df.repartition(_TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism, key)


def write_tile_images(df: DataFrame, root: str) -> DataFrame:
    """Materialise u8 tiles as PNG files ``{root}/{rel_path}``, dealt by path to a
    few tasks a core: a table of a few MB is one partition, but many files.
    Returns the written paths as a DataFrame (lazy: run an action to write)."""
    from pyspark.sql import types as T

    from ..session import ship_package

    ship_package(df.sparkSession)
    cols = dealt(df.select("rel_path", "height", "width", "channels", "data"), "rel_path")
    return cols.mapInArrow(_write_png_batches(root.rstrip("/")), T.StructType([T.StructField("file", T.StringType())]))


def tile_image_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """u8 tiles with a relative file path ``{split}/{class}/img{id}.png``
    (the P layout with every file written as PNG)."""
    t = tiles_u8(spark, sf_dir)
    rel = F.regexp_replace(F.regexp_replace("path", r"^raw/v1\.0/", ""), r"\.(jpeg|jpg|png)$", ".png")
    return t.withColumn("rel_path", rel)
