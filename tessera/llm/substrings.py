"""Substring dedup by bucket-pointer refinement.

Removes every byte covered by a LENGTH-byte string that also starts earlier
(smaller doc_id, or the same document and an earlier start).

A suffix array of all texts would need a rank for every byte, so places are
sampled first: every LENGTH-byte window holds an anchor that its own bytes choose
(``anchors``), and equal windows hold equal anchors.  Anchors are dealt by their
gram, each with the windows whose anchor it is.  A gram that occurs once
ends there.  An anchor whose whole context (all bytes of its windows) also occurs
earlier covers that context.  What
remains, first contexts of grams with several contexts, is compared by
bucket-pointer refinement: the contexts of a range of grams lie in one flat array,
buckets of ``Q``-grams are refined by sorting on the bucket identifiers of later
offsets, the refined identifiers are used again to double the length until it is
LENGTH, and places alone in their bucket drop out on the way.  In a bucket every
window but the earliest repeats.

Skew: equal contexts are combined inside map tasks, and the gram runs are read as
sorted streams, never held.  A gram with more contexts than the limit (2,000 to
50,000, by the total) is dealt by its windows instead, and each run of equal
windows is again read as a stream; both ways are exact.

Defined results: a null text is empty; texts under LENGTH bytes lose nothing; rows
without a doc_id are kept whole and compared with nothing; rows of equal id and
text are one document; of rows of equal id and different texts the one with the
smallest text hash is compared and the others are kept whole; an empty table gives
an empty result; other columns are carried through, and input columns named like a
result are replaced.  Grams, contexts and windows are compared by 64-bit hashes,
contexts within equal grams.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.anchors import LENGTH, Prints, anchors
from tessera.llm.common import mix64, pieces, ready, release, stored, text_bytes

#: length of the first buckets' grams; it doubles until it reaches LENGTH
Q = 50
#: anchors that a map task combines at once; contexts that are refined at once
COMBINE, CHUNK = 500_000, 10_000
LEAST_LIMIT, MOST_LIMIT = 2_000, 50_000
PACK = 128


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where any key differs from the one before."""
    n = len(keys[0])
    out = np.zeros(n, bool)
    out[:1] = True
    for k in keys:
        out[1:] |= k[1:] != k[:-1]
    return out


def _repeats(fresh: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Rows sorted by group, doc and pos: those at another place than their
    group's first."""
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))
    return (doc != doc[first]) | (pos != pos[first])


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """(key, c, doc_id, pos, whole): the anchors, key their gram and c their
    context (the bytes of its windows); pos: its first window and how many
    follow (packed); whole: an equal context came earlier in the task, and key only deals the row
    out."""
    schema = T.StructType(
        [T.StructField("key", T.LongType()), T.StructField("c", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("pos", T.LongType()), T.StructField("whole", T.BooleanType())]
    )

    def combined(parts: list) -> pa.RecordBatch:
        k, c, d, p = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((p, d, c, k))
        k, c, d, p = k[order], c[order], d[order], p[order]
        whole = _repeats(_starts(k, c), d, p)
        k = np.where(whole, mix64(d.view(np.uint64) + p.astype(np.uint64)), k)
        return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c.view(np.int64)), pa.array(d), pa.array(p), pa.array(whole)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in pieces(batches, "text", 256 << 10):  # arrays that stay in the cache
            raw, off = text_bytes(b.column(1))
            prints = Prints(raw)
            i, lo, n, k = anchors(raw, off, prints)
            c = prints.of(lo, lo + n - 1 + LENGTH) + n.astype(np.uint64)
            parts.append((k, c, b.column(0).to_numpy()[i], (lo - off[i]) * PACK + n - 1))
            held += len(i)
            if held > COMBINE:
                yield combined(parts)
                parts, held = [], 0
        if parts:
            yield combined(parts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def _hits(rows: DataFrame) -> DataFrame:
    """(doc_id, pos, key): anchors whose context repeats an earlier one (key
    null), and the first of each context of grams with several contexts."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("pos", T.LongType()), T.StructField("key", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # held: the last context's first row and whether its gram had another context before
        held, several = None, False
        for b in _and_end(batches):
            if b is not None and not b.num_rows:
                continue
            if b is None:
                if held is not None and several:
                    yield _hit(schema, held[2], held[3], held[0])
                return
            k, c, d, p, whole = (b.column(x).to_numpy(zero_copy_only=False) for x in range(5))
            if whole.any():
                yield _hit(schema, d[whole], p[whole], None)
                k, c, d, p = k[~whole], c[~whole], d[~whole], p[~whole]
            if not len(k):
                continue
            if held is not None:
                k, c, d, p = (np.r_[h, x] for h, x in zip(held, (k, c, d, p)))
            gram = _starts(k)
            context = gram | _starts(c)
            again = _repeats(context, d, p)
            yield _hit(schema, d[again], p[again], None)
            at = np.flatnonzero(context)
            new_gram = gram[at]
            more = np.r_[~new_gram[1:], False]  # the next context has the same gram
            follows = ~new_gram
            if held is not None:
                follows[0] = several
            amb = (follows | more)[:-1]
            some = at[:-1][amb]
            yield _hit(schema, d[some], p[some], k[some])
            last = at[-1]
            held, several = (k[last : last + 1], c[last : last + 1], d[last : last + 1], p[last : last + 1]), bool(follows[-1])

    return rows.repartition("key").sortWithinPartitions("key", "c", "doc_id", "pos").mapInArrow(run, schema)


def _and_end(batches):
    yield from batches
    yield None


def _hit(schema: T.StructType, d: np.ndarray, p: np.ndarray, k: np.ndarray | None) -> pa.RecordBatch:
    key = pa.nulls(len(d), pa.int64()) if k is None else pa.array(k)
    return pa.RecordBatch.from_arrays([pa.array(d), pa.array(p), key], names=schema.names)


def _contexts(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """(key, doc_id, pos, bytes) of undecided anchors, pos where the context
    begins; windows (bytes: a second hash) for the anchors of crowded grams."""
    wanted = hits.where(F.col("key").isNotNull())
    total = wanted.count()
    limit = min(max(LEAST_LIMIT, total // 64), MOST_LIMIT)
    crowded = stored(wanted.groupBy("key").count().where(F.col("count") > limit).select("key", F.lit(True).alias("split")), "substr-crowded")
    wanted = wanted.join(crowded, "key", "left") if not crowded.isEmpty() else wanted.withColumn("split", F.lit(None).cast("boolean"))
    per = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("pos", "key", "split")).alias("at"))
    joined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(per, "doc_id")
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("pos", T.IntegerType()), T.StructField("bytes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text", 1 << 20):
            out: list[tuple] = []
            for doc, text, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                raw = text.encode("utf-8", "surrogatepass")
                pos, key, split = (at.values.field(f).to_pylist() for f in ("pos", "key", "split"))
                windows = set()
                for p, k, s in zip(pos, key, split):
                    lo, hi = p // PACK, min(len(raw), p // PACK + p % PACK + LENGTH)
                    if s:
                        windows.update(range(lo, hi - LENGTH + 1))
                    else:
                        out.append((k, doc, lo, raw[lo:hi]))
                if windows:
                    w = np.array(sorted(windows))
                    h = Prints(np.frombuffer(raw, np.uint8)).of(w, w + LENGTH).view(np.int64)
                    out += [(k, doc, p, b"") for k, p in zip(h.tolist(), w.tolist())]
            if out:
                k, d, p, x = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(d, pa.int64()), pa.array(p, pa.int32()), pa.array(x, pa.binary())], names=schema.names)

    return joined.mapInArrow(run, schema)


def refine(flat: np.ndarray, off: np.ndarray, length: int = LENGTH, q: int = Q) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``flat``, bucket of each): the places whose ``length`` bytes,
    inside their own piece ``flat[off[i] : off[i + 1]]``, also lie elsewhere."""
    end = np.repeat(off[1:], np.diff(off))
    gram = Prints(flat).all(q).view(np.int64)
    place = np.flatnonzero(np.arange(len(gram)) + q <= end[: len(gram)])
    bucket = np.full(len(flat) + length, -1, np.int64)  # -1: alone, or no room
    ids = gram[place]
    while True:
        order = np.argsort(ids)
        s = ids[order]
        fresh = _starts(s)
        alone = fresh & np.r_[fresh[1:], True]
        number = np.cumsum(fresh) - 1
        keep = np.sort(order[~alone])
        own = np.empty(len(order), np.int64)
        own[order] = number
        bucket[place] = -1
        place = place[keep]
        bucket[place] = own[keep]
        if q == length:
            return place, bucket[place]
        # the longer string begins with this bucket's and goes on with a later offset's
        step = min(q, length - q)
        later = np.where(place + step < len(flat), bucket[place + step], -1)
        room = (place + q + step <= end[place]) & (later >= 0)
        bucket_here, place, later = bucket[place][room], place[room], later[room]
        ids = bucket_here * (int(number[-1]) + 2 if len(number) else 1) + later
        bucket = np.full_like(bucket, -1)
        q += step


def repeated_windows(doc: np.ndarray, pos: np.ndarray, pieces_: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, end) of the runs of windows, each inside one context, that
    also start earlier in any of the contexts."""
    size = np.array([len(x) for x in pieces_])
    off = np.r_[0, np.cumsum(size)]
    place, bucket = refine(np.frombuffer(b"".join(pieces_), np.uint8), off)
    own = np.searchsorted(off, place, side="right") - 1
    d, p = doc[own], pos[own] + place - off[own]
    order = np.lexsort((p, d, bucket))
    again = np.zeros(len(order), bool)
    again[order] = _repeats(_starts(bucket[order]), d[order], p[order]) if len(order) else False
    at = np.flatnonzero(again)  # by place
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    fresh = _starts(own[at]) | np.r_[True, np.diff(place[at]) != 1]
    first = at[fresh]
    last = at[np.r_[np.flatnonzero(fresh)[1:] - 1, len(at) - 1]]
    return d[first], p[first], p[last] + LENGTH


def _spans(contexts: DataFrame) -> DataFrame:
    """(doc_id, start, end) of repeated windows, from contexts dealt by gram."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])

    def batch(d, s, e):
        return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32))], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        count, first = 0, None  # first: key, doc and pos of the current run of windows
        for b in batches:
            size = pc.binary_length(b.column(3)).to_numpy(zero_copy_only=False)
            w = np.flatnonzero(size == 0)
            if len(w):
                k, d, p = (b.column(x).to_numpy()[w] for x in range(3))
                if first is not None:
                    k, d, p = (np.r_[f, x] for f, x in zip(first, (k, d, p)))
                fresh = _starts(k)
                again = _repeats(fresh, d, p)
                yield batch(d[again], p[again], p[again] + LENGTH)
                last = np.flatnonzero(fresh)[-1]
                first = (k[last : last + 1], d[last : last + 1], p[last : last + 1])
            c = np.flatnonzero(size)
            if not len(c):
                continue
            held.append(pa.Table.from_batches([b.take(pa.array(c))]))
            count += len(c)
            if count >= CHUNK:
                t = pa.concat_tables(held).combine_chunks()
                k = t.column(0).to_numpy()
                cut = int(np.flatnonzero(_starts(k))[-1])  # the last gram may go on
                if cut:
                    yield batch(*_of(t.slice(0, cut)))
                    held, count = [t.slice(cut)], len(k) - cut
        if count:
            yield batch(*_of(pa.concat_tables(held)))

    return contexts.repartition("key").sortWithinPartitions("key", "doc_id", "pos").mapInArrow(run, schema)


def _of(t: pa.Table):
    return repeated_windows(t.column(1).to_numpy(), t.column(2).to_numpy().astype(np.int64), t.column(3).to_pylist())


def cut_spans(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """(what stays, bytes removed, maximal removed runs)"""
    kept, end, runs, last = [], 0, 0, -1
    for lo, hi in sorted(spans):
        hi = min(hi, len(raw))
        if lo > end or last < 0:
            kept.append(raw[end:lo])
            runs += 1
        last = 0
        end = max(end, hi)
    kept.append(raw[end:])
    out = b"".join(kept)
    return out, len(raw) - len(out), runs


def remove_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """Every row of ``docs`` with n_bytes, n_removed, n_spans and ``kept``
    (binary: a cut may fall inside a character); ``digest``: its SHA-256 in
    ``kept`` instead."""
    spark = ready(docs.sparkSession)
    docs = docs.drop("n_bytes", "n_removed", "n_spans", "kept", "__spans", "__id", "__own")
    own = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    twice = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select("doc_id")
    several = not twice.isEmpty()
    if several:  # one text for each id
        chosen = docs.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("__own"))
        chosen = stored(chosen, "substr-own")
        docs = docs.join(chosen, "doc_id", "left")
        own = own.join(chosen, "doc_id", "left").where(F.col("__own").isNull() | (F.col("__own") == F.xxhash64("text"))).drop("__own")
    hits = stored(_hits(_anchor_rows(own)), "substr-hits")
    release(spark)
    spans = stored(_spans(_contexts(own, hits)), "substr-spans")
    release(spark)
    whole = hits.where(F.col("key").isNull()).select(
        "doc_id",
        F.floor(F.col("pos") / PACK).cast("int").alias("start"),
        (F.floor(F.col("pos") / PACK) + F.col("pos") % PACK + LENGTH).cast("int").alias("end"),
    )
    per = spans.unionByName(whole).groupBy(F.col("doc_id").alias("__id")).agg(F.collect_list(F.struct("start", "end")).alias("__spans"))
    joined = docs.join(per, F.col("doc_id").cast("long") == F.col("__id"), "left").drop("__id")
    if several:
        fits = F.col("__own").isNull() | (F.col("__own") == F.xxhash64("text"))
        joined = joined.withColumn("__spans", F.when(fits, F.col("__spans"))).drop("__own")
    base = [c for c in joined.columns if c != "__spans"]
    joined = joined.select(*base, "__spans")
    fields = [*[joined.schema[c] for c in base], *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")], T.StructField("kept", T.BinaryType())]
    at = base.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            size, gone, runs, kept = [], [], [], []
            for text, s in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1)):
                raw = (text or "").encode("utf-8", "surrogatepass")
                spans = list(zip(*(s.values.field(f).to_pylist() for f in ("start", "end")))) if s.is_valid else []
                out, n, r = cut_spans(raw, spans) if spans else (raw, 0, 0)
                size.append(len(raw)), gone.append(n), runs.append(r), kept.append(hashlib.sha256(out).digest() if digest else out)
            cols = [*b.columns[:-1], *[pa.array(x, pa.int64()) for x in (size, gone, runs)], pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return joined.mapInArrow(run, T.StructType(fields))
