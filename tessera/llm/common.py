"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path, ship_package

#: ASCII white space that separates words: space and U+0009..U+000D
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read again:
    cuts the lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: deletes the shuffle files of a query as soon as it has ended
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored_alone(df: DataFrame, name: str) -> DataFrame:
    """``stored``, after which the shuffles that made the table are gone at once;
    else they lie beside it until the driver happens to collect them.  Only for
    frames that nothing else runs."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return stored(df, name)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def drop_stored(*frames: DataFrame) -> None:
    """Delete scratch tables of ``stored`` that no later step reads."""
    for df in frames:
        spark = df.sparkSession
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        roots = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for r in roots:
            if "/tessera/llm-" in r:
                p = jvm.org.apache.hadoop.fs.Path(r)
                p.getFileSystem(conf).delete(p, True)


def ready(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers."""
    ship_package(spark)
    return spark


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def pieces(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``max_bytes`` of text, one row at
    least, so that working arrays stay small whatever the batch size."""
    for b in batches:
        if not b.num_rows:
            continue
        off = text_offsets(b.column(column))
        start = 0
        while start < b.num_rows:
            stop = int(np.searchsorted(off, off[start] + max_bytes, side="right")) - 1
            stop = min(max(stop, start + 1), b.num_rows)
            yield b.slice(start, stop - start)
            start = stop


def text_offsets(col: pa.Array) -> np.ndarray:
    """Byte offsets of a string array's rows in its data buffer (len + 1)."""
    n = len(col)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    kind = np.int64 if wide else np.int32
    buf = col.buffers()[1]
    if buf is None or n == 0:
        return np.zeros(n + 1, np.int64)
    return np.frombuffer(buf, kind)[col.offset : col.offset + n + 1].astype(np.int64)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows one after another, offsets from 0); nulls are empty."""
    if col.null_count:
        col = col.fill_null("")
    off = text_offsets(col)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift-multiply), vectorised."""
    x = x ^ (x >> np.uint64(33))
    x *= _M1
    x ^= x >> np.uint64(33)
    x *= _M2
    x ^= x >> np.uint64(33)
    return x


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of tables that are already
    written and of frames that are no longer held."""
    import gc

    gc.collect()
    spark._jvm.System.gc()


#: keys that ``join_split`` broadcasts at most
HOT_KEYS = 10_000


def join_split(rows: DataFrame, table: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has each key once and in
    ``weight`` the number of rows that carry it; ``total`` is their sum.  Keys with
    more than total / HOT_KEYS rows, so fewer than HOT_KEYS of them, are broadcast;
    what the others bring to one task is as small."""
    hot = F.col(weight) > total // HOT_KEYS
    few, rest = F.broadcast(table.where(hot)), table.where(~hot)
    cold = rows.join(F.broadcast(table.where(hot).select(key)), key, "left_anti").join(rest, key)
    return rows.join(few, key).unionByName(cold)
