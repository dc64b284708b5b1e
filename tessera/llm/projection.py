"""Embedding near-duplicates by sorted projection passes.

Each pass gives a vector the concatenated signs of ``BITS`` random projections,
orders all vectors by them, equal signs by a hash of pass and vector, and compares
every vector with the ``WINDOW`` before it, by cosine in double precision.
Verified links of all passes are united.

Vectors that are equal in every component are one class and are compared once.
A pass deals the order out in blocks of ``BLOCK`` ranks, each with the WINDOW
ranks before it, so no task holds more than BLOCK + WINDOW vectors.  A block
returns a spanning forest, never its pairs.  Links are then counted among all
members of each component, however many windows it fills: a large component is
dealt in parts of about ``PART`` vectors, part against part.  So a vector's count
lacks only links to vectors that no chain of found links reaches; counting takes
time with the square of a component's number of classes.

Defined results: vectors that are null, empty, zero, or hold a null or
non-finite component, and rows without an id, link with nothing; vectors of
different lengths are never linked; equal rows are links of each other; ties in
the order fall by class; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tessera.llm.common import ready, stored
from tessera.llm.components import components

COSINE = 0.95
PASSES, BITS = 16, 48
WINDOW, BLOCK = 512, 2048
#: vectors of a component compared in one task, on either side
PART = 8192


def unit_vectors(rows: DataFrame, vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id, the class digest (d1, d2) and the unit vector of usable rows."""
    ready(rows.sparkSession)
    usable = rows.select(F.col(key).alias("vec_id"), F.col(vec).cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    schema = T.StructType([usable.schema["vec_id"], *[T.StructField(c, T.LongType()) for c in ("d1", "d2")], T.StructField("unit", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, d, units = [], [], []
            for i, (lo, hi) in enumerate(_bounds(b.column(1))):
                x = _values(b.column(1))[lo:hi] + 0.0  # -0.0 is 0.0
                top = np.abs(x).max()
                if top > 0:
                    x = x / top
                    keep.append(i)
                    d.append(hashlib.blake2b(_values(b.column(1))[lo:hi].tobytes(), digest_size=16).digest())
                    units.append(x / np.sqrt(x @ x))
            h = np.frombuffer(b"".join(d), np.int64).reshape(-1, 2)
            off = pa.array(np.r_[0, np.cumsum([len(u) for u in units])].astype(np.int32))
            flat = pa.array(np.concatenate(units) if units else np.zeros(0))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep, pa.int32())), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.ListArray.from_arrays(off, flat)], names=schema.names
            )

    return usable.mapInArrow(run, schema)


def _bounds(col: pa.Array) -> Iterator[tuple[int, int]]:
    off = col.offsets.to_numpy()
    return zip(off[:-1].tolist(), off[1:].tolist())


def _values(col: pa.Array) -> np.ndarray:
    return col.values.to_numpy(zero_copy_only=False)


def projections(size: int, passes: int, bits: int) -> np.ndarray:
    return np.random.default_rng([4, size]).standard_normal((size, passes * bits))


def _hashes(classes: DataFrame, passes: int, bits: int) -> DataFrame:
    """(pass, hash, node): the concatenated signs as one whole number."""

    def run(batches):
        for b in batches:
            values, out = _values(b.column(1)), np.zeros((b.num_rows, passes), np.int64)
            size = np.array([hi - lo for lo, hi in _bounds(b.column(1))], np.int64)
            start = np.array([lo for lo, _ in _bounds(b.column(1))], np.int64)
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                signs = (values[start[at][:, None] + np.arange(n)] @ projections(int(n), passes, bits)) > 0
                out[at] = signs.reshape(len(at), passes, bits) @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))
            node = np.repeat(b.column(0).to_numpy(), passes)
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(passes, dtype=np.int32), b.num_rows)), pa.array(out.ravel()), pa.array(node)], names=["pass", "hash", "node"])

    return classes.select("node", "unit").mapInArrow(run, "pass int, hash long, node long")


def _ranks(hashes: DataFrame, nodes: int) -> DataFrame:
    """(node, ranks): each node's place in the order of every pass."""
    # equal hashes: another order in every pass, so that the passes differ
    by = ["pass", "hash", F.xxhash64("pass", "node"), "node"]
    n = max(2, int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = stored(hashes.repartitionByRange(n, *by).withColumn("__range", F.spark_partition_id()), "vec-order")
    counts = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    # a row for each of n ranges
    offset = counts.select("__range", (F.sum("__n").over(W.orderBy("__range")) - F.col("__n")).alias("__before"))
    inside = F.row_number().over(W.partitionBy("__range").orderBy(*by)) - 1
    rank = F.col("__before") + F.col("__in") - F.col("pass").cast("long") * nodes  # every pass orders all nodes
    ranked = dealt.withColumn("__in", inside).join(offset, "__range").select("node", "pass", rank.alias("rank"))
    return ranked.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("pass", "rank"))).alias("r")).select("node", F.col("r.rank").alias("ranks"))


def compare_block(unit: list[np.ndarray], rank: np.ndarray, block: int, window: int, block_size: int, cosine: float) -> np.ndarray:
    """For each vector of a block a root that it reaches by links of this block."""
    order = np.argsort(rank)
    at = rank[order]
    size = np.array([len(u) for u in unit])
    root = np.arange(len(unit))
    edges = []
    for n in np.unique(size):
        own = order[size[order] == n]
        place = at[size[order] == n]
        x = np.stack([unit[i] for i in own])
        for lo in range(0, len(own), window):
            hi = min(lo + window, len(own))
            from_ = int(np.searchsorted(place, place[lo] - window))
            i, j = np.nonzero(x[from_:hi] @ x[lo:hi].T >= cosine)
            i, j = i + from_, j + lo
            ok = (i < j) & (place[j] - place[i] <= window) & (place[j] >= block * block_size)
            edges.append((own[i[ok]], own[j[ok]]))
    i, j = (np.concatenate([e[k] for e in edges]) if edges else np.zeros(0, np.int64) for k in (0, 1))
    while len(i):  # the smallest position reached
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            break
        root = low
    return root


def count_links(x: np.ndarray, copies: np.ndarray, cosine: float, y: np.ndarray | None = None, y_copies: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x, and of y, the copies on the other side that it links
    with; without y, among the rows of x."""
    alone = y is None
    if alone:
        y, y_copies = x, copies
    one, two = copies.astype(float), y_copies.astype(float)  # whole numbers
    a, b = np.zeros(len(x)), np.zeros(len(y))
    for lo in range(0, len(x), 512):
        from_ = lo if alone else 0
        hit = (x[lo : lo + 512] @ y[from_:].T >= cosine).astype(float)
        if alone:  # a pair once
            hit = np.triu(hit, 1)
        a[lo : lo + 512] += hit @ two[from_:]
        b[from_:] += hit.T @ one[lo : lo + 512]
    return (a.astype(np.int64), b.astype(np.int64)) if not alone else ((a + b).astype(np.int64), np.zeros(0, np.int64))


def _counted(members: DataFrame, classes: DataFrame, cosine: float, part: int) -> DataFrame:
    """(node, links) among the members (node, component, copies, classes) of each
    component.  Small components share tasks; the parts of a large one meet in
    pairs."""
    linked = members.where("classes > 1")
    n = max(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(linked.count() / 2048))
    parts = F.ceil(F.col("classes") / part).cast("int")
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), parts - 1), lambda k: F.struct(F.least(k, own).alias("a"), F.greatest(k, own).alias("b")))
    dealt = linked.join(classes.select("node", "unit"), "node").select(
        "node", "component", "copies", "unit", own.alias("part"),
        F.when(parts > 1, F.col("component")).otherwise(-1 - F.pmod(F.xxhash64("component"), F.lit(n))).alias("group"),
        F.explode(pairs).alias("pair"),
    )

    def count(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        unit = t.column("unit").chunk(0)
        values, start = _values(unit), unit.offsets.to_numpy()
        component, copies, of = (t.column(c).to_numpy() for c in ("component", "copies", "part"))
        links = np.zeros(t.num_rows, np.int64)

        def rows(i: np.ndarray) -> np.ndarray:  # linked vectors are of one length
            return values[start[i][:, None] + np.arange(start[i[0] + 1] - start[i[0]])]

        a, b = key[1].as_py(), key[2].as_py()
        if a != b:
            i, j = np.flatnonzero(of == a), np.flatnonzero(of == b)
            if len(i) and len(j):
                links[i], links[j] = count_links(rows(i), copies[i], cosine, rows(j), copies[j])
        else:
            order = np.argsort(component, kind="stable")
            for i in np.split(order, np.flatnonzero(np.diff(component[order])) + 1):
                links[i] = count_links(rows(i), copies[i], cosine)[0]
        return pa.table({"node": t.column("node"), "links": links})

    dealt = dealt.select("*", F.col("pair.a").alias("a"), F.col("pair.b").alias("b")).drop("pair")
    return dealt.groupBy("group", "a", "b").applyInArrow(count, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(rows: DataFrame, cosine: float = COSINE, passes: int = PASSES, bits: int = BITS, window: int = WINDOW, block: int = BLOCK, part: int = PART, vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    usable = stored(unit_vectors(rows, vec, key), "vec-units")
    classes = usable.groupBy("d1", "d2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("unit").alias("unit"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vec-classes")
    ranks = _ranks(_hashes(classes, passes, bits), classes.count())
    full = stored(classes.select("node", "unit").join(ranks, "node"), "vec-ranks")
    number = F.posexplode("ranks").alias("pass", "rank")
    dealt = full.select("node", "unit", number)
    own = F.floor(F.col("rank") / block).cast("long")
    dealt = dealt.withColumn("block", F.explode(F.when(F.col("rank") % block >= block - window, F.array(own, own + 1)).otherwise(F.array(own))))

    def compare(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        unit = t.column("unit").chunk(0)
        values = _values(unit)
        node = t.column("node").to_numpy()
        root = compare_block([values[lo:hi] for lo, hi in _bounds(unit)], t.column("rank").to_numpy(), key[1].as_py(), window, block, cosine)
        some = root != np.arange(len(node))
        return pa.table({"node": node[some], "root": node[root[some]]})

    found = dealt.groupBy("pass", "block").applyInArrow(compare, "node long, root long")
    named = classes.select("node", "d1", "d2", "rep", "copies").join(components(found, "node", "root"), "node", "left")
    named = stored(named.withColumn("component", F.coalesce("component", "node")), "vec-named")
    whole = named.groupBy("component").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    members = stored(named.join(whole, "component"), "vec-members")
    named = members.join(_counted(members, classes, cosine, part), "node", "left")
    named = named.select("d1", "d2", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    of = usable.select("vec_id", "d1", "d2").join(named, ["d1", "d2"]).select("vec_id", "n_links", "component_id")
    alone = _unusable(rows, vec, key).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return of.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _unusable(rows: DataFrame, vec: str, key: str) -> DataFrame:
    v = F.col(vec).cast("array<double>")
    fine = F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
    fine = fine & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0)
    return rows.select(F.col(key).alias("vec_id"), F.col(vec)).where(~F.coalesce(fine, F.lit(False)))
