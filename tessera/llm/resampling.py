"""Target-distribution importance resampling over hashed n-grams.

Features are runs of up to ``max_run`` words; a feature's bucket is the CRC-32 of
its UTF-8 bytes modulo the number of buckets.  A bucket's gain is the log ratio of
its share in the target to its share in the corpus; a document's weight is the
mean gain of its features, and the documents with the highest weight plus a
Gumbel noise drawn from their ids are taken, which samples without replacement
in proportion to exp(weight).

The CRC of many spans comes from a position table: the register is linear over
XOR, so a byte's part depends only on the byte and its distance from the span's
end.  Parts are looked up for all bytes of all spans at once and joined by
``bitwise_xor.reduceat``; a constant by length accounts for the start value.
Spans longer than ``PLACES`` bytes are folded block by block.

Defined results: a null or empty text, or one without words, has no features and
weight 0; a null doc_id draws its noise as empty text and loses ties; rows that
repeat an id are documents of their own with one noise, ties between them going
to fewer features and the lower weight; an empty corpus gives an empty result,
an empty target counts 0 everywhere; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tessera.llm.common import pieces, ready, stored, text_bytes

BUCKETS, MAX_RUN = 10_000, 1
MIN_WORDS, PERCENT, SEED = 20, 10, 2024
#: distances from a span's end that the position table knows
PLACES = 64
#: bytes whose parts are looked up at once, and bytes scanned for words at once
_CHUNK, _BLOCK = 1 << 18, 1 << 20
_ALL = 0xFFFFFFFF
_POLY = 0xEDB88320

#: word bytes after lower-casing: digits, letters, and all bytes of characters beyond ASCII
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(part of a byte by its distance from the end, register that ``_ALL``
    becomes after 0 to PLACES zero bytes)."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(_POLY), step >> 1).astype(np.uint32)
    parts, start = [step], [np.uint32(_ALL)]
    for _ in range(PLACES):
        parts.append((parts[-1] >> 8) ^ step[parts[-1] & 255])
        start.append((start[-1] >> np.uint32(8)) ^ step[start[-1] & np.uint32(255)])
    return np.stack(parts[:PLACES]), np.array(start, np.uint32)


_PARTS, _START = _tables()
_LOWER_PARTS = _PARTS.copy()
_LOWER_PARTS[:, 65:91] = _PARTS[:, 97:123]  # A-Z count as a-z


def _folded(raw: np.ndarray, lo: np.ndarray, hi: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Register of each block raw[lo:hi] of 1 to PLACES bytes from register 0."""
    size, out, flat = hi - lo, np.empty(len(lo), np.uint32), parts.ravel()
    upto = np.r_[0, np.cumsum(size)]
    a = 0
    while a < len(lo):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + _CHUNK, side="right")) - 1)
        n = size[a:b]
        first = upto[a:b] - upto[a]
        byte = np.arange(upto[b] - upto[a]) + np.repeat(lo[a:b] - first, n)
        place = np.repeat(hi[a:b] - 1, n) - byte
        out[a:b] = np.bitwise_xor.reduceat(flat[place * 256 + raw[byte]], first)
        a = b
    return out


def span_crcs(raw: np.ndarray, start: np.ndarray, size: np.ndarray, lower: bool = True) -> np.ndarray:
    """CRC-32 of the spans raw[start : start + size], none empty; ``lower``:
    with A-Z as a-z."""
    if not len(start):
        return np.zeros(0, np.uint32)
    parts = _LOWER_PARTS if lower else _PARTS
    blocks = -(-size // PLACES)
    if (blocks == 1).all():
        return _START[size] ^ _folded(raw, start, start + size, parts) ^ np.uint32(_ALL)
    # every block but a span's first has PLACES bytes
    first = np.cumsum(blocks) - blocks
    span = np.repeat(np.arange(len(start)), blocks)
    left = blocks[span] - 1 - (np.arange(len(span)) - first[span])
    hi = (start + size)[span] - PLACES * left
    lo = np.maximum(hi - PLACES, start[span])
    part = _folded(raw, lo, hi, parts)
    out = _START[hi[first] - start] ^ part[first]
    long = np.flatnonzero(blocks > 1)
    long = long[np.argsort(-blocks[long], kind="stable")]
    for k in range(1, int(blocks.max())):
        long = long[: np.searchsorted(-blocks[long], -k)]  # those with a block k
        r, moved = out[long], part[first[long] + k]
        for i in range(4):  # a register advances as its four bytes would
            moved = moved ^ _PARTS[PLACES - 1 - i][(r >> np.uint32(8 * i)) & np.uint32(255)]
        out[long] = moved
    return out ^ np.uint32(_ALL)


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, sizes, words before each text and in all)."""
    fresh = np.zeros(len(raw) + 1, bool)
    fresh[off] = True
    starts, stops = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, len(raw), _BLOCK):
        hi = min(lo + _BLOCK, len(raw))
        w = np.zeros(hi - lo + 2, bool)  # with a neighbour on either side
        a, b = max(lo - 1, 0), min(hi + 1, len(raw))
        w[a - lo + 1 : b - lo + 1] = _WORD[raw[a:b]]
        own = w[1:-1]
        starts.append(lo + np.flatnonzero(own & (~w[:-2] | fresh[lo:hi])))
        stops.append(lo + 1 + np.flatnonzero(own & (~w[2:] | fresh[lo + 1 : hi + 1])))
    start = np.concatenate(starts)
    return start, np.concatenate(stops) - start, np.searchsorted(start, off)


def feature_buckets(raw: np.ndarray, off: np.ndarray, buckets: int = BUCKETS, max_run: int = MAX_RUN) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each run length: (buckets of its features, features before each text
    and in all)."""
    start, size, at = word_spans(raw, off)
    if max_run > 1 and len(start):  # words joined by one space
        stop, word = start + size, np.zeros(len(raw) + 1, bool)
        word[:-1] = _WORD[raw]
        gap = (~word[stop]) & (stop < len(raw))
        keep = word[:-1]
        raw = raw.copy()
        raw[~keep] = 32
        keep[stop[gap]] = True
        raw = raw[keep]
        start = np.cumsum(size + gap) - size - gap
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for run in range(1, max_run + 1):
        n = max(len(start) - run + 1, 0)
        i = np.flatnonzero(text[:n] == text[run - 1 : run - 1 + n])
        last = i + run - 1
        crc = span_crcs(raw, start[i], start[last] + size[last] - start[i])
        yield (crc % np.uint32(buckets)).astype(np.int64), np.searchsorted(i, at)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, max_run: int = MAX_RUN, column: str = "text") -> DataFrame:
    """(bucket, n) over all rows: each task counts into one array."""
    ready(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for b in pieces(batches, column, 1 << 20):
            for found, _ in feature_buckets(*text_bytes(b.column(0)), buckets, max_run):
                n += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["bucket", "n"])

    return texts.select(column).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, floored."""
    c, t = corpus.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (c.sum() + len(c)) / ((c + 1) * (t.sum() + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, max_run: int = MAX_RUN) -> DataFrame:
    """doc_id, n_words, n_features and weight, the floored mean gain."""
    spark = ready(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    shared = spark.sparkContext.broadcast(gain)  # a number for each bucket
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for b in pieces(batches, "text", 1 << 20):
            n, total, words = np.zeros((2, b.num_rows), np.int64), np.zeros(b.num_rows, np.int64), None
            for found, at in feature_buckets(*text_bytes(b.column(1)), len(gain), max_run):
                words = np.diff(at) if words is None else words
                n[0] += np.diff(at)
                total += np.diff(np.r_[0, np.cumsum(gain[found])][at])
            weight = total // np.maximum(n[0], 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words), pa.array(n[0]), pa.array(weight)], names=schema.names)

    return docs.mapInArrow(run, schema)


def _counts(table: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for b, n in table.collect():  # a row for each bucket
        out[b] = n
    return out


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    buckets: int = BUCKETS,
    max_run: int = MAX_RUN,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null unless drawn) for
    every row of ``docs``.

    Scores are whole thousandths within the range of the gains and the noise, so
    there are some 10^5 of them whatever the corpus; counts by score give each
    score's first rank, and only rows at drawn scores are sorted, score by score.
    The noise spreads even equal weights, so no score holds more than 0.04 % of
    the ids."""
    gain = gains(_counts(bucket_counts(docs, buckets, max_run), buckets), _counts(bucket_counts(target, buckets, max_run), buckets))
    rows = weighted(docs, gain, max_run)
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    rows = stored(rows.withColumn("score", (F.col("weight") + noise).cast("long")), "resample-scored")
    able = F.col("n_words") >= min_words
    draws = rows.where(able).count() * percent // 100
    per = rows.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("__n"))
    before = (F.sum("__n").over(W.orderBy(F.desc("score"))) - F.col("__n")).alias("__before")
    high = stored(per.select("score", before).where(F.col("__before") < draws), "resample-scores")
    inside = W.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight")
    some = rows.where(able).join(high, "score")
    some = some.withColumn("rank", (F.col("__before") + F.row_number().over(inside)).cast("long")).drop("__before")
    some = some.withColumn("rank", F.when(F.col("rank") <= draws, F.col("rank")))
    rest = rows.where(~able).unionByName(rows.where(able).join(high.select("score"), "score", "left_anti"))
    out = some.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_words", "n_features", "weight", "score", "rank")
