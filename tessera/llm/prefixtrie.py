"""The prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns.  The peel descends from the largest
depth: the conversations that end at a depth join the nodes that survived from
below, equal sequences merge into one node and its figures are summed, the last
turn is stripped, and what is left is grouped again one depth higher.  So nodes
are discovered and aggregated in the same pass, each depth is one grouped sum
over partial sums of the tasks, and a prefix that a third of all conversations
share meets no single task.

Turns are known by digest.  A sequence's key is the running digest of its turns,
and a row carries the keys of at most ``BLOCK`` depths (its spine); the next
block's are fetched when one is used up.  Where only one conversation goes on
below a block's end, the rest of it is no shared prefix of anything: its nodes
are written at once and it enters the peel at that end.  So the number of rounds
is that of the deepest shared prefix, not of the longest conversation.

Defined results: null roles and texts are empty; turns that are equal in number
are ordered by digest; repeated rows are turns of their own; rows without a
conv_id are no conversation; an empty table has no node; other columns are not
read.  Sequences are compared by 128-bit digests.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import join_split, ready, stored
from tessera.session import scratch_path

#: depths of one spine
BLOCK = 16
#: conversations of a range that share turns in ``grafted``, and the most turns
STEP, MOST = 5, 8
#: key of the empty sequence
ROOT = bytes(16)
#: bytes of comma-joined ids in one piece of a node's ends
PIECE_BYTES = 1 << 20
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
_SPINE = T.ArrayType(T.StructType([T.StructField("key", T.BinaryType()), T.StructField("bytes", T.LongType())]))


def digests(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, the 128-bit digest of (role, text) and the text's UTF-8
    bytes of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col("conv_id").isNotNull())
    digest = F.substring(F.unhex(F.sha2(told, 256)), 1, 16).alias("digest")
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest, F.octet_length(text).cast("long").alias("bytes"))


def grafted(conv_id: int, step: int = STEP, most: int = MOST) -> tuple[int, int]:
    """(the conversation whose first turns replace this one's, how many).  The
    remainder has the sign of the id, as in SQL."""
    rest = abs(conv_id) % step * (1 if conv_id >= 0 else -1)
    return conv_id - rest, zlib.crc32(str(conv_id).encode()) % (most + 1)


def _unchanged(conv_id: int) -> tuple[int, int]:
    return conv_id, 0


class _Spines:
    """Running digests of the conversations of one task, in blocks."""

    def __init__(self, graft: Callable[[int], tuple[int, int]], most: int, size: int) -> None:
        self.graft, self.most, self.size = graft, most, size
        self.donor, self.head, self.conv = None, [], None
        self.rows: list[tuple] = []

    def _begin(self, conv_id: int) -> None:
        self.end()
        self.conv, self.key, self.block, self.spine = conv_id, ROOT, 0, [{"key": ROOT, "bytes": 0}]
        source, self.skip = self.graft(conv_id)
        if source == conv_id:
            self.donor, self.head, self.skip = conv_id, [], 0
        elif source == self.donor:
            for turn in self.head[: self.skip]:
                self._add(*turn)

    def _add(self, digest: bytes, size: int) -> None:
        if len(self.spine) > self.size:
            self._write(False)
            self.block, self.spine = self.block + 1, self.spine[-1:]
        self.key = hashlib.blake2b(self.key + digest, digest_size=16).digest()
        self.spine.append({"key": self.key, "bytes": size})

    def _write(self, last: bool) -> None:
        self.rows.append((self.conv, self.block, self.spine, last))

    def turn(self, conv_id: int, digest: bytes, size: int) -> None:
        if conv_id != self.conv:
            self._begin(conv_id)
        if conv_id == self.donor and len(self.head) < self.most:
            self.head.append((digest, size))
        if self.skip:
            self.skip -= 1
        else:
            self._add(digest, size)

    def end(self) -> None:
        if self.conv is not None:
            self._write(True)
            self.conv = None


def spines(turns: DataFrame, graft: Callable[[int], tuple[int, int]] = _unchanged, step: int = 1, most: int = 0, size: int = BLOCK) -> DataFrame:
    """conv_id, block, spine (the node before the block, then up to ``size`` depths:
    key and last text's bytes) and last, for each block of every rebuilt
    conversation.  ``graft`` names the conversation whose first turns replace as
    many of this one's, and how many, ``most`` at most; it lies in the same range
    of ``step`` ids.  A range's turns, some 40 bytes each, pass one task as a
    stream; it holds the donor's first ``most`` turns and one block."""
    ready(turns.sparkSession)
    group = F.col("conv_id") - F.col("conv_id") % step
    rows = turns.withColumn("group", group).repartition("group")
    rows = rows.sortWithinPartitions("group", F.col("conv_id") != F.col("group"), "conv_id", F.asc_nulls_first("turn"), "digest")
    schema = T.StructType(
        [
            T.StructField("conv_id", T.LongType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("spine", _SPINE),
            T.StructField("last", T.BooleanType()),
        ]
    )
    pair = pa.list_(pa.struct([("key", pa.binary()), ("bytes", pa.int64())]))
    types = [pa.int64(), pa.int32(), pair, pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Spines(graft, most, size)

        def written() -> pa.RecordBatch:
            rows, state.rows = state.rows, []
            cols = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=schema.names)

        for b in batches:
            for turn in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                state.turn(*turn)
            if state.rows:
                yield written()
        state.end()
        if state.rows:
            yield written()

    return rows.select("conv_id", "digest", "bytes").mapInArrow(run, schema)


def ends(last: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """key and ends_sha256 of the nodes at which conversations (key, conv_id) end.

    The ids of a node are sorted by range, so that a node with a third of all is
    dealt to many tasks; each joins its part into pieces of text, and the digest,
    which must read a node's ids in order, then streams over a node's pieces."""
    ready(last.sparkSession)
    n = max(2, int(last.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = last.select("key", "conv_id").repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, size, out = None, [], 0, []

        def close() -> None:
            nonlocal ids, size
            if ids:
                out.append((key, ids[0], ",".join(map(str, ids))))
            ids, size = [], 0

        def batch() -> pa.RecordBatch:
            rows = out.copy()
            out.clear()
            types = (pa.binary(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["key", "first", "ids"])

        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k != key or size > piece_bytes:
                    close()
                    key = k
                ids.append(c)
                size += 20
            if out:
                yield batch()
        close()
        if out:
            yield batch()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, out = None, None, []

        def batch() -> pa.RecordBatch:
            rows = out.copy()
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["key", "ends_sha256"])

        for b in batches:
            for k, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k == key:
                    sha.update(b",")
                else:
                    if key is not None:
                        out.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                sha.update(ids.encode())
            if out:
                yield batch()
        if key is not None:
            out.append((key, sha.hexdigest()))
            yield batch()

    joined = dealt.mapInArrow(pieces, "key binary, first long, ids string")
    streams = joined.repartition("key").sortWithinPartitions("key", "first").select("key", "ids")
    return streams.mapInArrow(digest, "key binary, ends_sha256 string")


_FIGURES = ("n_convs", "n_children", "n_leaves", "saved_tokens")
_NODE = "key binary, parent_key binary, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _long(n: int | Column) -> Column:
    return (n if isinstance(n, Column) else F.lit(n)).cast("long")


def _key(nth: int) -> Column:
    """Key of the spine's entry ``nth``, from the end if negative."""
    return F.element_at("spine", nth)["key"]


def _merged(rows: DataFrame) -> DataFrame:
    """One row a node of the contributions at one depth: conversations that end
    there, and nodes of the depth below with their last turn stripped."""
    sums = [F.sum(c).cast("long").alias(c) for c in _FIGURES]
    nodes = rows.groupBy("spine").agg(F.min("conv_id").alias("conv_id"), *sums)
    leaves = F.when(F.col("n_children") == 0, _long(1)).otherwise(F.col("n_leaves"))
    own = (F.col("n_convs") - 1) * F.element_at("spine", -1)["bytes"]  # the root has none
    return nodes.withColumn("n_leaves", leaves).withColumn("saved_tokens", F.col("saved_tokens") + own)


def _alone(blocks: DataFrame) -> DataFrame:
    """The blocks that only one conversation reaches."""
    above = F.element_at("spine", 1)["key"].alias("above")
    later = blocks.where("block > 0").select("*", above)
    single = later.groupBy("block", "above").agg(F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")
    return later.join(single, ["block", "above"])


def _tails(alone: DataFrame, size: int) -> DataFrame:
    """The nodes in blocks of one conversation alone."""
    nth = F.col("nth")
    final = F.col("last") & (nth == F.size("spine") - 1)
    each = alone.select("*", F.posexplode("spine").alias("nth", "turn")).where(nth > 0)
    return each.select(
        _long(F.col("block") * size + nth).alias("depth"), F.col("turn")["key"].alias("key"), F.get("spine", nth - 1)["key"].alias("parent_key"),
        "conv_id", _long(1).alias("n_convs"), _long(F.when(final, 0).otherwise(1)).alias("n_children"),
        _long(1).alias("n_leaves"), _long(0).alias("saved_tokens"),
    )


def _entries(blocks: DataFrame, cut: DataFrame, size: int) -> DataFrame:
    """Where each conversation enters the peel: at its last turn, or at the end of
    the block before it is alone, as a node with one child."""
    ended = F.col("cut").isNull()
    below = _long(F.when(ended, 0).otherwise(1))
    kept = blocks.join(cut, "conv_id", "left").where((F.col("last") & ended) | (F.col("block") == F.col("cut") - 1))
    return kept.select(
        "spine", "conv_id", _long(1).alias("n_convs"), below.alias("n_children"), below.alias("n_leaves"), _long(0).alias("saved_tokens"),
        (F.col("block") * size + F.size("spine") - 1).cast("int").alias("enters"),
    )


def trie(blocks: DataFrame, size: int = BLOCK) -> DataFrame:
    """The nodes of the conversations in ``blocks`` (a stored table of
    ``spines``): depth, key, parent_key, conv_id (the smallest member), n_convs,
    n_children, n_leaves and saved_tokens.  The driver sees the largest depth."""
    spark = blocks.sparkSession
    alone = stored(_alone(blocks), "trie-alone")
    cut = alone.groupBy("conv_id").agg(F.min("block").alias("cut"))
    entered, root = scratch_path(spark, "llm-trie-entries"), scratch_path(spark, "llm-trie-nodes")
    entry = _entries(blocks, cut, size)
    entry.write.partitionBy("enters").parquet(entered)
    entry = spark.read.schema(entry.schema).parquet(entered)
    depth, below = entry.agg(F.max("enters")).first()[0], None
    if depth is None:
        return spark.createDataFrame([], f"depth long, {_NODE}")
    while depth >= 0:
        rows = entry.where(F.col("enters") == depth).drop("enters")
        nodes = _merged(rows if below is None else rows.unionByName(below))
        nodes = nodes.withColumns({"key": _key(-1), "parent_key": _key(-2) if depth else F.lit(None).cast("binary")})
        nodes.write.parquet(f"{root}/depth={depth}")
        nodes = spark.read.schema(nodes.schema).parquet(f"{root}/depth={depth}")
        below = nodes.withColumn("n_children", _long(1)).withColumn("spine", F.slice("spine", 1, F.size("spine") - 1)).drop("key", "parent_key")
        depth -= 1
        if depth > 0 and depth % size == 0:  # the block is used up: the one before it, of any member
            more = blocks.where(F.col("block") == depth // size - 1).select("conv_id", "spine")
            below = below.drop("spine").join(more, "conv_id")
    peeled = spark.read.schema(f"{_NODE}, depth long").parquet(root)
    names = ["depth", "key", "parent_key", "conv_id", *_FIGURES]
    return peeled.select(names).unionByName(_tails(alone, size).select(names))


def prefix_trie(
    conversations: DataFrame,
    graft: Callable[[int], tuple[int, int]] = _unchanged,
    step: int = 1,
    most: int = 0,
    *,
    size: int = BLOCK,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 and key of every node."""
    blocks = stored(spines(digests(conversations), graft, step, most, size), "trie-blocks")
    nodes = stored(trie(blocks, size), "trie-all")
    done = blocks.where("last").select(_key(-1).alias("key"), "conv_id")
    closed = ends(done, piece_bytes)
    parents = nodes.where("n_children > 0").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("__n"))
    below = nodes.where("depth > 0")
    named = join_split(below, parents, "parent_key", "__n", below.count()).drop("__n")
    top = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    out = named.unionByName(top).join(closed, "key", "left")
    ends_sha256 = F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")
    return out.select("conv_id", "depth", "parent_conv_id", *_FIGURES, ends_sha256, "key")
