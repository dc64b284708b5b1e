"""Record -> training-example bytes, one Arrow batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.example import decode_example, encode_example
from ..session import ship_package


def examples_from_batch(b: pa.RecordBatch) -> list[bytes]:
    """Encode the record columns of one Arrow batch (image_flattened,
    label, image_shape, image_path) as example messages."""
    n = b.num_rows
    img = b.column(b.schema.get_field_index("image_flattened"))
    offs = img.offsets.to_numpy()
    vals = img.values.to_numpy(zero_copy_only=False).astype("<f4", copy=False)
    labels = b.column(b.schema.get_field_index("label")).to_pylist()
    shapes = b.column(b.schema.get_field_index("image_shape")).to_pylist()
    paths = b.column(b.schema.get_field_index("image_path")).to_pylist()
    return [encode_example(vals[offs[i] : offs[i + 1]], int(labels[i]), shapes[i], paths[i]) for i in range(n)]


def _encode_batches(batches):
    for b in batches:
        n = b.num_rows
        if n == 0:
            continue
        out = examples_from_batch(b)
        keep = [b.column(b.schema.get_field_index(c)) for c in ("image_path", "augmentation_index", "split")]
        yield pa.RecordBatch.from_arrays(
            [*keep, pa.array(out, type=pa.binary())], ["image_path", "augmentation_index", "split", "example"]
        )


EXAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("image_path", T.StringType()),
        T.StructField("augmentation_index", T.IntegerType()),
        T.StructField("split", T.StringType()),
        T.StructField("example", T.BinaryType()),
    ]
)


def encode_examples(records: DataFrame) -> DataFrame:
    """(image_path, augmentation_index, split, example) from stored records."""
    ship_package(records.sparkSession)
    cols = records.select(
        "image_path",
        F.col("augmentation_index").cast("int").alias("augmentation_index"),
        "split",
        F.col("label").cast("bigint").alias("label"),
        F.col("image_shape").cast("array<bigint>").alias("image_shape"),
        F.col("image_flattened").cast("array<float>").alias("image_flattened"),
    )
    return cols.mapInArrow(_encode_batches, EXAMPLE_SCHEMA)


def _decode_batches(batches):
    for b in batches:
        n = b.num_rows
        if n == 0:
            continue
        ex = b.column(b.schema.get_field_index("example")).to_pylist()
        imgs, labels, shapes, paths = [], [], [], []
        for e in ex:
            d = decode_example(e)
            imgs.append(np.frombuffer(d["image"][0], dtype="<f4").astype(np.float64))
            labels.append(d["label"][0])
            shapes.append(d["image_shape"])
            paths.append(d["image_path"][0].decode("utf-8"))
        offs = np.zeros(n + 1, dtype=np.int32)
        np.cumsum([a.size for a in imgs], out=offs[1:])
        flat = np.concatenate(imgs)
        keep = [b.column(b.schema.get_field_index(c)) for c in ("augmentation_index", "split")]
        yield pa.RecordBatch.from_arrays(
            [
                *keep,
                pa.array(paths, type=pa.string()),
                pa.array(labels, type=pa.int64()),
                pa.array(shapes, type=pa.list_(pa.int64())),
                pa.ListArray.from_arrays(pa.array(offs), pa.array(np.ascontiguousarray(flat, dtype=np.float64))),
            ],
            ["augmentation_index", "split", "image_path", "label", "image_shape", "image"],
        )


DECODED_SCHEMA = T.StructType(
    [
        T.StructField("augmentation_index", T.IntegerType()),
        T.StructField("split", T.StringType()),
        T.StructField("image_path", T.StringType()),
        T.StructField("label", T.LongType()),
        T.StructField("image_shape", T.ArrayType(T.LongType())),
        T.StructField("image", T.ArrayType(T.DoubleType())),
    ]
)


def decode_examples(examples: DataFrame) -> DataFrame:
    """Inverse of :func:`encode_examples` (keeps index and split columns)."""
    ship_package(examples.sparkSession)
    return examples.select("augmentation_index", "split", "example").mapInArrow(_decode_batches, DECODED_SCHEMA)
