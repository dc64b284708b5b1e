"""MinHash near-dedup with odd sketches.

A document's set of five-word shingles gets ``SAMPLES`` MinHash values.  Bands
of ``ROWS`` of them propose candidates; all values are folded into a parity
bitmap of ``BITS`` bits, the odd sketch, whose XOR with another's has a
population count that estimates the similarity; pairs that the estimate leaves
within ``MARGIN`` of the threshold are confirmed on their full sets.

Documents with equal sets are one class and enter once.  A band's bucket is
never expanded into all pairs: in buckets of up to ``SMALL`` members those near by
sketch are confirmed at once; in larger ones first each member with the smallest
of all its buckets' members.  What that leaves apart meets in blocks: the members
outside a bucket's largest component, each block of them with blocks of all its
members.  A task compares the sketches of one meeting and names the members that have
a candidate there; only those get their full sets, and a second task of the same
meeting confirms them, nearest first, and skips whatever an earlier link has already
joined.  Pairs stay inside tasks; the members that meet and the links are all that is
shuffled.  A pair that shares several buckets is confirmed in the first of them.

With 48 bands of 5 a pair at similarity 0.75 shares no band with probability
2e-6; the sketch's margin is six standard deviations
(0.019 of the samples and 0.012 of the bits at that similarity).

Defined results: a document without words, or without a doc_id, links with
nothing; rows with the same doc_id are one document with several texts, linked by
each of them (but see ``dedup_rows``); ties
can't occur (the smallest doc_id names a component); an empty table gives an
empty result; other columns are not read.  Sets are compared by 64-bit shingle
hashes, classes by a 128-bit digest of the set.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import drop_stored, join_split, mix64, pieces, ready, release, stored, text_bytes, union_all
from tessera.llm.components import components
from tessera.llm.shingles import shingle_sets

SAMPLES, BITS = 512, 2048
BANDS, ROWS = 48, 5
#: links have 100 * intersection >= THRESHOLD * union
THRESHOLD, MARGIN = 75, 0.13
#: members up to which a bucket is compared by a join, all at once
SMALL = 16
#: members, and shingle hashes in their sets, on either side of a meeting on average
BLOCK, GROUP_HASHES = 1024, 2_000_000
_HALF = 1 << 16
_rng = np.random.default_rng(20)
_XOR = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)
_ODD = (_rng.integers(0, 1 << 31, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)


def most_bits(similarity: float, samples: int = SAMPLES, bits: int = BITS) -> int:
    """The population count of XORed odd sketches at a similarity: that many
    samples fall in one set only, and each toggles a random bit."""
    toggles = 2 * samples * (1 - similarity)
    return int(bits / 2 * (1 - math.exp(-2 * toggles / bits)))


def minhashes(sets: np.ndarray, off: np.ndarray) -> np.ndarray:
    """uint32 [sets, SAMPLES]; every set has a member."""
    out = np.empty((len(off) - 1, SAMPLES), np.uint32)
    short = (sets >> np.uint64(32)).astype(np.uint32)
    lo = 0
    while lo < len(off) - 1:  # blocks that stay in the cache
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + _HALF, side="right")) - 1)
        x = short[off[lo] : off[hi]]
        starts, buffer = off[lo:hi] - off[lo], np.empty_like(x)
        for k in range(SAMPLES):
            np.bitwise_xor(x, _XOR[k], out=buffer)
            np.multiply(buffer, _ODD[k], out=buffer)
            out[lo:hi, k] = np.minimum.reduceat(buffer, starts)
        lo = hi
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """int64 [sets, BITS / 64]: each (place, value) toggles one bit."""
    n = len(samples)
    tagged = samples.astype(np.uint64) | (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32))
    bit = (mix64(tagged) % np.uint64(BITS)).astype(np.int64) + np.arange(n)[:, None] * BITS
    odd = (np.bincount(bit.ravel(), minlength=n * BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, BITS), axis=1).view(np.int64)


def band_hashes(samples: np.ndarray) -> np.ndarray:
    """int64 [sets, BANDS]"""
    rows = samples[:, : BANDS * ROWS].astype(np.uint64).reshape(len(samples), BANDS, ROWS)
    h = np.arange(BANDS, dtype=np.uint64)[None, :].repeat(len(samples), 0)
    for k in range(ROWS):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
    return h.view(np.int64)


def _digests(sets: np.ndarray, off: np.ndarray) -> np.ndarray:
    """int64 [sets, 2]; every set has a member."""
    a = np.add.reduceat(mix64(sets ^ np.uint64(0x5851F42D4C957F2D)), off[:-1])
    b = np.add.reduceat(mix64(sets * np.uint64(0xD1342543DE82EF95) + np.uint64(1)), off[:-1])
    return np.stack([a, b], 1).view(np.int64)


def _lists(a: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1]), pa.array(a.ravel()))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, print, n_shingles, the class digest d1 and d2, bands and sketch
    (the last four null for empty sets) of (doc_id, print, text)."""
    ready(docs.sparkSession)
    docs = docs.select("doc_id", "print", "text")
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("print", "n_shingles", "d1", "d2")], T.StructField("bands", longs), T.StructField("sketch", longs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text", 1 << 20):
            sets, off = shingle_sets(*text_bytes(b.column(2)))
            size = np.diff(off)
            some = np.flatnonzero(size)
            spread = np.full(len(size), -1)
            spread[some] = np.arange(len(some))
            at = pa.array(spread, mask=spread < 0)
            cols = [pa.array(np.zeros(0, np.int64))] * 2 + [pa.array([], pa.list_(pa.int64()))] * 2
            if len(some):
                o = np.r_[off[some], off[-1]]
                m, d = minhashes(sets, o), _digests(sets, o)
                cols = [pa.array(d[:, 0]), pa.array(d[:, 1]), _lists(band_hashes(m)), _lists(odd_sketches(m))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(size), *[c.take(at) for c in cols]], names=schema.names)

    return docs.mapInArrow(run, schema)


def _full_sets(rows: DataFrame) -> DataFrame:
    """(rep, set) of the rows (rep, text)."""
    schema = T.StructType([T.StructField("rep", T.LongType()), T.StructField("set", T.ArrayType(T.LongType()))])

    def run(batches):
        for b in pieces(batches, "text", 1 << 20):
            sets, off = shingle_sets(*text_bytes(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(sets.view(np.int64)))], names=schema.names)

    return rows.select("rep", "text").mapInArrow(run, schema)


def _apart(a: Column, b: Column) -> Column:
    """Population count of the XOR of two sketches."""
    parts = [F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))) for k in range(BITS // 64)]
    return sum(parts[1:], parts[0])


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links by their full sets."""
    x = sets.select(F.col("rep").alias("a"), F.col("set").alias("xa"))
    pairs = pairs.join(x, "a").join(x.toDF("b", "xb"), "b")
    both = pairs.withColumn("both", F.size(F.array_intersect("xa", "xb")))
    return both.where(100 * F.col("both") >= THRESHOLD * (F.size("xa") + F.size("xb") - F.col("both"))).select("a", "b").distinct()


def near_pairs(t: pa.Table, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of a meeting's pairs that are in different components, near
    enough by sketch and size, and whose first common bucket is ``band``; i is on the
    left side, j on the right one, two minor members meet once; the nearest first."""
    rep, part, size, minor, left = (t.column(c).to_numpy() for c in ("rep", "part", "size", "minor", "left"))
    sketch, bands = (t.column(c).combine_chunks().flatten().to_numpy().reshape(len(rep), -1) for c in ("sketch", "bands"))
    limit = most_bits(THRESHOLD / 100 - MARGIN)
    right, lefts = np.flatnonzero(~left), np.flatnonzero(left)
    found = [(lefts[:0], lefts[:0], lefts[:0])]
    for lo in range(0, len(lefts), 32):
        i = lefts[lo : lo + 32]
        one, other = size[i][:, None], size[right][None, :]
        meets = (part[i][:, None] != part[right][None, :]) & (~minor[right] | (rep[i][:, None] > rep[right][None, :]))
        meets &= 100 * np.minimum(one, other) >= THRESHOLD * np.maximum(one, other)
        apart = np.bitwise_count((sketch[i][:, None, :] ^ sketch[right][None, :, :]).view(np.uint64)).sum(2, dtype=np.int64)
        x, y = np.nonzero(meets & (apart <= limit))
        first = (bands[i[x]] == bands[right[y]]).argmax(1)
        own = bands[i[x], first] == band
        x, y = x[own], y[own]
        found.append((i[x], right[y], apart[x, y]))
    i, j, d = (np.concatenate([f[k] for f in found]) for k in range(3))
    order = np.lexsort((rep[j], rep[i], d))
    return i[order], j[order]


def linked_pairs(t: pa.Table, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Links by full sets that join all components which the pairs (i, j), tried in
    order, can join; pairs of components that are joined already are passed over."""
    held = t.column("set").combine_chunks()
    off, flat = held.offsets.to_numpy(), held.values.to_numpy()
    rep, part = t.column("rep").to_pylist(), t.column("part").to_pylist()
    parent = {p: p for p in part}
    sets: dict[int, np.ndarray] = {}

    def find(p: int) -> int:
        while parent[p] != p:
            parent[p] = p = parent[parent[p]]
        return p

    def ordered(k: int) -> np.ndarray:
        if k not in sets:
            sets[k] = np.sort(flat[off[k] : off[k + 1]])
        return sets[k]

    links = []
    for a, b in zip(i.tolist(), j.tolist()):
        p, q = find(part[a]), find(part[b])
        if p == q:
            continue
        x, y = ordered(a), ordered(b)
        place = np.minimum(np.searchsorted(x, y), len(x) - 1)
        both = int((x[place] == y).sum())
        if 100 * both >= THRESHOLD * (len(x) + len(y) - both):
            parent[q] = p
            links.append((rep[a], rep[b]))
    return links


def _first_pairs(crowded: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidates (a, b), near by sketch: all of buckets of up to SMALL members,
    and each member of larger ones with the smallest that leads one of them.  What
    that one pair leaves apart meets in the open buckets."""
    near = _apart(F.col("sa"), F.col("sb")) <= most_bits(THRESHOLD / 100 - MARGIN)
    sketches = nodes.select("rep", "sketch")
    rows = crowded.where(F.col("n") <= SMALL).join(sketches, "rep")
    a = rows.select("band", F.col("rep").alias("a"), F.col("sketch").alias("sa"))
    b = rows.select("band", F.col("rep").alias("b"), F.col("sketch").alias("sb"))
    small = a.join(b, (a["band"] == b["band"]) & (F.col("a") > F.col("b")) & near).select("a", "b")
    star = crowded.where(F.col("n") > SMALL).groupBy(F.col("rep").alias("a")).agg(F.min("lead").alias("b")).where("a != b")
    star = star.join(sketches.toDF("a", "sa"), "a").join(sketches.toDF("b", "sb"), "b").where(near).select("a", "b")
    return small.unionByName(star).distinct()


def _open_members(crowded: DataFrame, nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """(band, rep, part, major, na, nb): members of buckets with several components;
    ``major`` is the component with most members there, na the number of blocks of
    the others, nb that of all."""
    rows = crowded.select("band", "rep").join(nodes.select("rep", "size"), "rep")
    rows = rows.join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left")
    rows = rows.select("band", "rep", "size", F.coalesce("component", "rep").alias("part"))
    per = rows.groupBy("band", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("w"))
    of = per.groupBy("band").agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.max(F.struct("n", "w", "part")).alias("most"))
    of = of.where(F.col("n") > F.col("most.n"))

    def blocks(n: Column, w: Column) -> Column:
        return F.ceil(F.greatest(n / F.lit(BLOCK), w / F.lit(GROUP_HASHES))).cast("int")

    na = blocks(F.col("n") - F.col("most.n"), F.col("w") - F.col("most.w"))
    of = of.select("band", F.col("most.part").alias("major"), na.alias("na"), blocks(F.col("n"), F.col("w")).alias("nb"))
    return rows.drop("size").join(of, "band")


def _meetings(members: DataFrame) -> DataFrame:
    """(band, ka, kb, rep, part, minor, left): block ka of the members outside the
    major component (left) with block kb of all members of the bucket."""
    minor = F.col("part") != F.col("major")
    every = F.sequence(F.lit(0), F.col("nb") - 1), F.sequence(F.lit(0), F.col("na") - 1)
    held = F.xxhash64("rep")
    left = members.where(minor).select("band", F.pmod(held, F.col("na")).cast("int").alias("ka"), F.explode(every[0]).alias("kb"), "rep", "part", F.lit(True).alias("minor"), F.lit(True).alias("left"))
    right = members.select("band", F.explode(every[1]).alias("ka"), F.pmod(held, F.col("nb")).cast("int").alias("kb"), "rep", "part", minor.alias("minor"), F.lit(False).alias("left"))
    return left.unionByName(right)


def _open_links(members: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) by full sets that join every two components of open buckets which
    a link between near members joins."""
    key = ["band", "ka", "kb"]
    schema = "band long, ka int, kb int, rep long, part long, minor boolean, left boolean"
    columns = [c.split()[0] for c in schema.split(", ")]
    marks = nodes.select("rep", "size", "sketch", "bands")

    def meet(group: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        i, j = near_pairs(t, group[0].as_py())
        return t.select(columns).take(pa.array(np.unique(np.r_[i, j])))

    def confirm(group: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        links = linked_pairs(t, *near_pairs(t, group[0].as_py()))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    near = stored(_meetings(members).join(marks, "rep").groupBy(*key).applyInArrow(meet, schema), "near-meetings")
    held = near.join(marks, "rep").join(sets, "rep")
    links = stored(held.groupBy(*key).applyInArrow(confirm, "a long, b long"), "near-links")
    drop_stored(near)
    return links


def _nodes(marks: DataFrame) -> DataFrame:
    """One row a class of equal sets: d1, d2, size, bands, sketch, its smallest row
    (doc_id ``first`` and ``print``), and rep, the number it goes by: ``first``, or a
    digest's where several classes share that doc_id."""
    some = marks.where(F.col("d1").isNotNull() & F.col("doc_id").isNotNull())
    low = F.min(F.struct(F.col("doc_id").cast("long").alias("doc_id"), "print")).alias("low")
    classes = some.groupBy("d1", "d2").agg(low, F.first("n_shingles").alias("size"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = stored(classes.select("d1", "d2", F.col("low.doc_id").alias("first"), F.col("low.print").alias("print"), "size", "bands", "sketch"), "near-classes")
    shared = stored(classes.groupBy("first").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n"), "near-shared")
    other = F.lit(1 << 62) + F.pmod(F.xxhash64("d1", "d2"), F.lit(1 << 62))
    both = classes.join(shared.withColumn("__shared", F.lit(True)), "first", "left")
    nodes = both.withColumn("rep", F.when(F.col("__shared"), other).otherwise(F.col("first"))).drop("__shared")
    nodes = stored(nodes, "near-nodes")
    drop_stored(classes, shared)
    return nodes


def _same_id(marks: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of documents that have several texts."""
    some = marks.where(F.col("d1").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "d1", "d2")
    digest = F.struct("d1", "d2")
    per = some.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__n"), F.min(digest).alias("lo"), F.max(digest).alias("hi"))
    several = stored(per.where("lo != hi").select("doc_id", "__n", F.col("lo.d1").alias("lo1"), F.col("lo.d2").alias("lo2")), "near-several")
    total = several.agg(F.sum("__n")).first()[0] or 0
    own = join_split(some, several, "doc_id", "__n", total).select("d1", "d2", "lo1", "lo2").distinct()
    by = nodes.select("d1", "d2", F.col("rep").alias("a"))
    lead = nodes.select(F.col("d1").alias("lo1"), F.col("d2").alias("lo2"), F.col("rep").alias("b"))
    links = stored(own.join(by, ["d1", "d2"]).join(lead, ["lo1", "lo2"]).select("a", "b").where("a != b"), "near-links")
    drop_stored(several)
    return links


def _components(docs: DataFrame, same_id: bool) -> DataFrame:
    """doc_id, print, n_shingles of every row of ``docs``, and of the rows with a
    set and a doc_id the smallest row of their component (low_id, low_print); a
    written table."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.xxhash64("text").alias("print"), "text")
    marks = stored(signatures(docs), "near-marks")
    nodes = _nodes(marks)
    members = nodes.select("rep", F.explode("bands").alias("band"))
    crowds = members.groupBy("band").agg(F.min("rep").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded = stored(members.join(crowds, "band"), "near-crowded")
    release(spark)
    first = stored(_first_pairs(crowded, nodes), "near-pairs")
    large = crowded.where(F.col("n") > SMALL)
    wanted = union_all([first.select("a").toDF("rep"), first.select("b").toDF("rep"), large.select("rep")]).distinct()
    wanted = wanted.join(nodes.select("rep", F.col("first").alias("doc_id"), "print"), "rep")
    sets = stored(_full_sets(docs.join(wanted, ["doc_id", "print"])), "near-sets")
    release(spark)
    links = [stored(_confirm(first, sets), "near-links")]
    if same_id:
        links.append(_same_id(marks, nodes))
    parts = stored(components(union_all(links)), "near-parts")
    members = stored(_open_members(large, nodes, parts), "near-open")
    links.append(_open_links(members, nodes, sets))
    drop_stored(parts, members)
    parts = stored(components(union_all(links)), "near-parts")
    drop_stored(crowded, first, sets, *links)
    release(spark)
    found = nodes.select("d1", "d2", "first", "print", "rep").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    found = found.withColumn("component", F.coalesce("component", "rep"))
    low = found.groupBy("component").agg(F.min(F.struct("first", "print")).alias("low"))
    named = found.select("d1", "d2", "component").join(low, "component")
    named = named.select("d1", "d2", F.col("low.first").alias("low_id"), F.col("low.print").alias("low_print"))
    rows = marks.select("doc_id", "print", "n_shingles", *[F.when(F.col("doc_id").isNotNull(), F.col(d)).alias(d) for d in ("d1", "d2")])
    out = stored(rows.join(named, ["d1", "d2"], "left").drop("d1", "d2"), "near-rows")
    drop_stored(marks, nodes, parts)
    release(spark)
    return out


def near_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    rows = _components(docs, same_id=True)
    component = F.coalesce("low_id", F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def dedup_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` of which none smaller (doc_id, then a hash of the text)
    is reached by links between texts: here a repeated doc_id links nothing, so no
    text goes without a near-duplicate that stays.  Rows without words or without a
    doc_id stay, and so do rows that repeat a kept one in full."""
    rows = _components(docs, same_id=False)
    gone = rows.where((F.col("doc_id") != F.col("low_id")) | (F.col("print") != F.col("low_print")))
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("print").alias("__print")).distinct()
    return docs.join(gone, (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__print")), "left_anti")
