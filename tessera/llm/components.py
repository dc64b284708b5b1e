"""Connected components of an edge table.

Tasks of up to about ``LOCAL_EDGES`` edges first replace their edges by stars of
the same components; alternating large and small stars then join the tasks'
results until nothing changes.  A table that fits one task is done after the
first step."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import drop_stored, ready, stored

#: edges of a task in the first step
LOCAL_EDGES = 200_000


def smallest_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node of each node's component) of the edges u - v."""
    nodes, at = np.unique(np.r_[u, v], return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    low = np.arange(len(nodes))
    while True:
        new = low.copy()
        np.minimum.at(new, low[a], low[b])
        np.minimum.at(new, low[b], low[a])
        while (new[new] != new).any():
            new = new[new]
        new = new[low]
        if (new == low).all():
            return nodes, nodes[low]
        low = new


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if held:
        nodes, low = smallest_reached(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
        some = nodes != low
        yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(low[some])], names=["u", "v"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v), u > v."""
    near = edges
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    both = near.join(low, "u")
    if large:
        out = both.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = both.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(low.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") > F.col("v"))


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``: component is the smallest
    node that it reaches.  Null ends are no edges; repeated edges and loops
    change nothing.  Each round is written to the shared folder; the driver sees
    a count and a checksum."""
    known = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    ends = F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")
    now = stored(known.select(*ends).distinct(), "edges")
    loops = now.where(F.col("u") == F.col("v")).select("u", "v")
    proper = now.where(F.col("u") > F.col("v"))
    tasks = max(1, math.ceil(proper.count() / LOCAL_EDGES))
    ready(now.sparkSession)
    now, seen = stored(proper.coalesce(tasks).mapInArrow(_local_stars, "u long, v long"), "edges"), None
    while tasks > 1:
        step = stored(_star(_star(now, True), False).distinct(), "edges")
        mark = _print(step)
        drop_stored(now)
        now = step
        if mark == seen:
            break
        seen = mark
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).unionByName(
        loops.select(F.col("u").alias("node"), F.col("v").alias("component")).join(now.select(F.col("u").alias("node")), "node", "left_anti")
    )
    return ends.unionByName(roots.distinct())
