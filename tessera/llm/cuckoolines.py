"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased.
Keys of at least ``MIN_CHARS`` code points found in at least ``min_docs``
documents lose all their lines except in the largest doc_id that holds them.

The index is three tables: ``pairs`` (key, document), the exact reference table
``refs`` (key, number of documents, largest one), and ``filters``, a cuckoo
filter for each shard of keys that holds the keys at or over ``min_docs``.
``insert`` and ``delete`` change the counts of the touched keys and move those
that cross ``min_docs`` into or out of their shard's filter, so a later apply()
gives what a fresh build over the remaining documents gives.  Lines are first
probed against the filter of their shard; what passes is checked against
``refs``, so a false positive never drops a line.  Shards are sized by the
number of keys that they hold, and the probes of a shard are salted by document
into groups of about ``GROUP_PAIRS``, so a line that a third of all documents hold
meets no single task and all shards' filters together are copied at most
pairs / GROUP_PAIRS + shards times.

Defined results: a null or empty text is one empty line; rows with the same
doc_id are one document (a line of all of them counts once); rows without a
doc_id are one document below all others; an empty table gives an empty result;
other columns are carried through, and input columns named like a result are
replaced.  Keys are compared by a 128-bit BLAKE2b digest.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import SPACE_CHARS, mix64, pieces, ready, stored

MIN_CHARS, MIN_DOCS = 20, 3
#: keys in a filter and probes in a group at most on average
SHARD_KEYS, GROUP_PAIRS = 100_000, 50_000
SLOTS, MAX_ROUNDS = 4, 200
_KEY = ["h1", "h2"]


def line_key(line: str) -> bytes | None:
    """The digest of a line's key, None if the key is too short."""
    k = line.strip(SPACE_CHARS)
    return hashlib.blake2b(k.encode("utf-8", "surrogatepass").lower(), digest_size=16).digest() if len(k) >= MIN_CHARS else None


# ------------------------------------------------------------------ the filter


class CuckooFilter:
    """Buckets of SLOTS 16-bit fingerprints; 0 is a free slot.  ``add``,
    ``remove`` and ``holds`` take arrays of 64-bit key hashes, each key added
    once at most."""

    def __init__(self, table: np.ndarray):
        self.table = table  # uint16 [buckets, SLOTS], buckets a power of two

    @staticmethod
    def build(keys: np.ndarray) -> CuckooFilter:
        buckets = 1 << max(2, math.ceil(math.log2(max(1, len(keys)) / (SLOTS * 0.85))))
        while True:
            f = CuckooFilter(np.zeros((buckets, SLOTS), np.uint16))
            if f.add(keys):
                return f
            buckets *= 2

    @staticmethod
    def from_bytes(raw: bytes) -> CuckooFilter:
        return CuckooFilter(np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix64(np.ascontiguousarray(keys).view(np.uint64))
        print_ = (h >> np.uint64(48)).astype(np.uint16)
        print_[print_ == 0] = 1
        return print_, (h & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, print_: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ (mix64(print_.astype(np.uint64)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        p, b = self._place(keys)
        return (self.table[b] == p[:, None]).any(1) | (self.table[self._other(p, b)] == p[:, None]).any(1)

    def add(self, keys: np.ndarray) -> bool:
        """False if there is no room: the caller builds a larger filter."""
        p, b = self._place(keys)
        if p.size > self.table.size:
            return False
        rng = np.random.default_rng(6)
        for turn in range(MAX_ROUNDS):
            # as many of each bucket's newcomers as it has free slots
            order = np.argsort(b, kind="stable")
            p, b = p[order], b[order]
            first = np.r_[True, b[1:] != b[:-1]] if len(b) else np.zeros(0, bool)
            nth = np.arange(len(b)) - np.maximum.accumulate(np.where(first, np.arange(len(b)), 0)) if len(b) else np.zeros(0, int)
            free = self.table[b] == 0
            fits = nth < free.sum(1)
            slot = np.argsort(~free, axis=1, kind="stable")[np.arange(len(b)), np.minimum(nth, SLOTS - 1)]
            self.table[b[fits], slot[fits]] = p[fits]
            p, b = p[~fits], b[~fits]
            if not len(p):
                return True
            if turn % 2:  # both buckets are full: one newcomer of each bucket takes a slot
                lead = np.r_[True, b[1:] != b[:-1]]
                at, put = b[lead], rng.integers(0, SLOTS, lead.sum())
                out = self.table[at, put].copy()
                self.table[at, put] = p[lead]
                p[lead] = out
            b = self._other(p, b)
        return False

    def remove(self, keys: np.ndarray) -> None:
        """Takes out one fingerprint for each key; every key must be in."""
        p, b = self._place(keys)
        for _ in range(2):  # from a key's own bucket as far as that has them, else from the other one
            if not len(p):
                return
            order = np.lexsort((p, b))
            p, b = p[order], b[order]
            at = np.arange(len(p))
            again = np.r_[False, (b[1:] == b[:-1]) & (p[1:] == p[:-1])]
            nth = at - np.maximum.accumulate(np.where(again, 0, at))
            here = self.table[b] == p[:, None]
            fits = nth < here.sum(1)
            slot = np.argsort(~here, axis=1, kind="stable")[at, np.minimum(nth, SLOTS - 1)]
            self.table[b[fits], slot[fits]] = 0
            p, b = p[~fits], b[~fits]
            b = self._other(p, b)


# ------------------------------------------------------------------- the index


@dataclass(frozen=True)
class LineIndex:
    pairs: DataFrame  # doc_id, h1, h2: distinct
    refs: DataFrame  # h1, h2, n_docs, max_doc
    filters: DataFrame  # shard, filter
    shards: int
    min_docs: int = MIN_DOCS


def line_pairs(docs: DataFrame) -> DataFrame:
    """(doc_id, h1, h2) of the line keys of each document row."""
    ready(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    schema = T.StructType([docs.schema["doc_id"], T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            owner, keys = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                own = {k for x in (t or "").split("\n") if (k := line_key(x))}
                keys += own
                owner += [i] * len(own)
            h = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(owner, pa.int32())), pa.array(h[:, 0]), pa.array(h[:, 1])], names=schema.names)

    return docs.mapInArrow(run, schema)


def _count_refs(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("max_doc"))


def _shard(shards: int):
    return F.pmod(F.col("h2"), F.lit(shards)).cast("int")


def build(docs: DataFrame, min_docs: int = MIN_DOCS) -> LineIndex:
    pairs = stored(line_pairs(docs).dropDuplicates(["doc_id", *_KEY]), "line-pairs")
    refs = stored(_count_refs(pairs), "line-refs")
    hot = refs.where(F.col("n_docs") >= min_docs)
    shards = max(4, math.ceil(hot.count() / SHARD_KEYS))
    return LineIndex(pairs, refs, _filters(hot, shards), shards, min_docs)


def _filters(hot: DataFrame, shards: int) -> DataFrame:
    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [key[0]], "filter": [CuckooFilter.build(rows["h1"].to_numpy()).to_bytes()]})

    made = hot.select(_shard(shards).alias("shard"), "h1").groupBy("shard").applyInPandas(one, "shard int, filter binary")
    return stored(made, "line-filters")


def insert(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index with more documents (rows already in it change nothing)."""
    new = line_pairs(docs).dropDuplicates(["doc_id", *_KEY])
    same = [F.col("n.h1") == F.col("p.h1"), F.col("n.h2") == F.col("p.h2"), F.col("n.doc_id").eqNullSafe(F.col("p.doc_id"))]
    new = stored(new.alias("n").join(index.pairs.alias("p"), same, "left_anti"), "line-insert")
    return _changed(index, index.pairs.unionByName(new), _count_refs(new), 1)


def delete(index: LineIndex, doc_ids: DataFrame) -> LineIndex:
    """The index without the documents of ``doc_ids`` (column doc_id)."""
    ids = doc_ids.select("doc_id").distinct().alias("d")
    match = F.col("p.doc_id").eqNullSafe(F.col("d.doc_id"))
    gone = stored(index.pairs.alias("p").join(ids, match, "left_semi"), "line-delete")
    rest = index.pairs.alias("p").join(ids, match, "left_anti")
    return _changed(index, rest, _count_refs(gone), -1)


def _changed(index: LineIndex, pairs: DataFrame, delta: DataFrame, sign: int) -> LineIndex:
    pairs = stored(pairs, "line-pairs")
    delta = delta.select(*_KEY, F.col("n_docs").alias("__d"), F.col("max_doc").alias("__max"))
    both = index.refs.join(delta, _KEY, "full_outer")
    old = F.coalesce("n_docs", F.lit(0))
    count = old + sign * F.coalesce("__d", F.lit(0))
    both = both.withColumns({"__old": old, "n_docs": count, "__touched": F.col("__d").isNotNull()})
    if sign > 0:
        both = both.withColumn("max_doc", F.greatest("max_doc", "__max"))
    else:  # the largest holder may be gone: taken anew from the pairs of touched keys
        left = pairs.join(delta.select(*_KEY), _KEY, "left_semi").groupBy(*_KEY).agg(F.max("doc_id").alias("__left"))
        both = both.join(left, _KEY, "left").withColumn("max_doc", F.when(F.col("__touched"), F.col("__left")).otherwise(F.col("max_doc")))
    both = stored(both.select(*_KEY, "n_docs", "max_doc", "__old"), "line-change")
    m = index.min_docs
    crossed = both.where((F.col("__old") >= m) != (F.col("n_docs") >= m)).select(_shard(index.shards).alias("shard"), "h1", (F.col("n_docs") >= m).alias("up"))
    refs = both.where(F.col("n_docs") > 0).drop("__old")

    def move(key: tuple, old: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        f = CuckooFilter.from_bytes(old["filter"][0]) if len(old) else CuckooFilter(np.zeros((4, SLOTS), np.uint16))
        up = rows["up"].to_numpy(bool)
        f.remove(rows["h1"].to_numpy()[~up])
        ok = f.add(rows["h1"].to_numpy()[up])
        return pd.DataFrame({"shard": [key[0]], "filter": [f.to_bytes() if ok else None]})

    moved = stored(index.filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(move, "shard int, filter binary"), "line-filters")
    full = moved.where(F.col("filter").isNull()).select("shard")  # no room left: built anew from the exact table
    hot = refs.where(F.col("n_docs") >= m)
    anew = _filters(hot.join(full, _shard(index.shards) == F.col("shard"), "left_semi"), index.shards)
    return replace(index, pairs=pairs, refs=refs, filters=moved.where(F.col("filter").isNotNull()).unionByName(anew))


def _salts(index: LineIndex, pairs: DataFrame) -> DataFrame:
    """(shard, salts): the groups that a shard's probes are dealt into."""
    per = pairs.groupBy(_shard(index.shards).alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    return per.select("shard", F.ceil(F.col("n") / F.lit(GROUP_PAIRS)).cast("int").alias("salts"))


def drops(index: LineIndex, pairs: DataFrame | None = None) -> DataFrame:
    """(doc_id, keys binary): for each document, the digests of the keys whose
    lines it loses.  ``pairs``: other documents' pairs than the index's own."""
    own = index.pairs if pairs is None else pairs
    # one small row a shard, of SHARD_KEYS hot keys each
    salts = F.broadcast(stored(_salts(index, own), "line-salts"))
    salted = own.withColumn("shard", _shard(index.shards)).join(salts, "shard")
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int")).drop("salts")
    filters = index.filters.join(salts, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")

    def probe(f: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(f) or not len(rows):
            return rows.iloc[:0][["doc_id", *_KEY]]
        return rows.loc[CuckooFilter.from_bytes(f["filter"][0]).holds(rows["h1"].to_numpy()), ["doc_id", *_KEY]]

    schema = T.StructType([own.schema[c] for c in ("doc_id", *_KEY)])
    maybe = filters.groupBy("shard", "salt").cogroup(salted.groupBy("shard", "salt")).applyInPandas(probe, schema)
    hot = index.refs.where(F.col("n_docs") >= index.min_docs).select(*_KEY, "max_doc")
    lost = maybe.join(hot, _KEY).where(~F.col("doc_id").eqNullSafe(F.col("max_doc")))
    return lost.groupBy("doc_id").agg(F.collect_list(F.struct(*_KEY)).alias("__lost"))


def apply(docs: DataFrame, lost: DataFrame) -> DataFrame:
    """Every row of ``docs`` with ``text`` without its lost lines, and n_lines
    (before), n_dropped."""
    ready(docs.sparkSession)
    docs = docs.drop("n_lines", "n_dropped", "__lost")
    lost = lost.withColumnRenamed("doc_id", "__doc")
    joined = docs.join(lost, F.col("doc_id").eqNullSafe(F.col("__doc")), "left").drop("__doc")
    fields = [*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            kept, n, gone = [], [], []
            texts, losing = b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist()
            for t, lose in zip(texts, losing):
                lines = (t or "").split("\n")
                stay = lines
                if lose:
                    keys = {np.array([x["h1"], x["h2"]], np.int64).tobytes() for x in lose}
                    stay = [x for x in lines if line_key(x) not in keys]
                kept.append("\n".join(stay) if lose else t)
                n.append(len(lines))
                gone.append(len(lines) - len(stay))
            cols = [*b.columns[:at], pa.array(kept, pa.string()), *b.columns[at + 1 : -1], pa.array(n, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return joined.mapInArrow(run, T.StructType(fields))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with deduplicated text, n_lines and n_dropped."""
    return apply(docs, drops(build(docs, min_docs)))
