"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule, piecewise linear over training time 0..1.
Its integral is the source's weight: the token budget is shared by weight, no
source gets more than ``MAX_EPOCHS`` times its size, and what it can't use is
reshared by weight until none is above.  A source's documents, in an order drawn
by a keyed hash of their ids, fill its target: whole epochs first, then the
prefix of one more epoch that comes nearest.  The cumulative demand of a source,
its target times the integrated schedule, is inverted at each copy's place in
the source's sequence, which gives the copy's training position; the mix is
range-sorted by position.

Running sums are two-level: sums of small (source, hash) buckets, their offsets,
and the sums inside a bucket, so a source with a third of all rows meets no
single task.  The driver sees totals only, never the sources.

Defined results: a null or empty text has size 0 and is never taken; a null
source is a source of its own, last; rows that repeat an id are documents of
their own, next to each other in the order, by size; with no words at all every
target is 0; an empty table gives an empty result; other columns are carried
through by ``mixed``, and input columns named like a result are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tessera.llm.common import SPACE_CHARS, pieces, ready, stored, stored_alone, text_bytes

#: knots (time, weight) of the schedules, dealt to the sources in turn; their
#: integrals are the weights 3, 1 and 2
SCHEDULES = (
    ((0, Fraction(9, 2)), (1, Fraction(3, 2))),
    ((0, Fraction(1, 2)), (1, Fraction(3, 2))),
    ((0, 1), (Fraction(1, 2), 3), (1, 1)),
)
#: the budget as a share of all words, and the most passes over a source
BUDGET, MAX_EPOCHS = Fraction(3, 2), 2
#: rows of one bucket of a running sum, on average at most
BUCKET_ROWS = 20_000


def integral(knots) -> Fraction:
    return sum((Fraction(w0) + Fraction(w1)) / 2 * (Fraction(t1) - Fraction(t0)) for (t0, w0), (t1, w1) in zip(knots, knots[1:]))


def time_at(share: Column, knots) -> Column:
    """Inverse of the integrated schedule: the time by which ``share`` (0..1) of
    a source's demand has come."""
    total = float(integral(knots))
    out, before = F.lit(1.0), Fraction(0)
    parts = []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        area = integral(((t0, w0), (t1, w1)))
        slope = float((Fraction(w1) - Fraction(w0)) / (Fraction(t1) - Fraction(t0)))
        rest = F.greatest(share * total - float(before), F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(float(w0) ** 2) + 2 * slope * rest, F.lit(0.0)))
        parts.append((float((before + area) / integral(knots)), F.lit(float(t0)) + 2 * rest / (float(w0) + root)))
        before += area
    for upto, t in reversed(parts):
        out = F.when(share <= upto, t).otherwise(out)
    return F.least(out, F.lit(1.0))


def with_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, print (a hash of the text), size (words of the whole
    text) and the order key."""
    ready(docs.sparkSession)
    docs = docs.select("doc_id", "source", F.xxhash64("text").alias("print"), "text")
    schema = T.StructType([*docs.drop("text").schema.fields, T.StructField("size", T.LongType())])
    space = np.zeros(256, bool)
    space[[ord(c) for c in SPACE_CHARS]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            raw, off = text_bytes(b.column(3))
            is_space = space[raw]
            fresh = np.r_[True, is_space][: len(raw)]  # nothing or a space comes before
            fresh[off[:-1][off[:-1] < len(raw)]] = True
            begins = np.r_[0, np.cumsum(fresh & ~is_space)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(begins[off[1:]] - begins[off[:-1]], pa.int64())], names=schema.names)

    key = F.md5(F.concat(F.lit("mix|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return docs.mapInArrow(run, schema).withColumn("key", key)


def ranked(sources: DataFrame, column: str = "source") -> DataFrame:
    """Adds ``rank`` from 0 by code point, null last: sorted ranges, a number
    within each range, and the ranges' offsets."""
    by = F.col(column).asc_nulls_last()
    n = max(2, int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = stored(sources.repartitionByRange(n, by).withColumn("__range", F.spark_partition_id()), "mix-ranges")
    counts = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    # a row for each of n ranges
    offset = counts.select("__range", (F.sum("__n").over(W.orderBy("__range")) - F.col("__n")).alias("__before"))
    inside = F.row_number().over(W.partitionBy("__range").orderBy(by)) - 1
    return dealt.join(offset, "__range").withColumn("rank", (F.col("__before") + inside).cast("long")).drop("__range", "__before")


def targets(sources: DataFrame, schedules=SCHEDULES, budget: Fraction = BUDGET, cap: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (source, source_size) with rank, turn (its schedule) and
    target."""
    weights = [integral(k) for k in schedules]
    scale = math.lcm(*[w.denominator for w in weights])
    weights = [int(w * scale) for w in weights]
    turn = F.pmod(F.col("rank"), F.lit(len(schedules))).cast("int")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.col("turn")).cast("long")
    known = stored(ranked(sources).withColumn("turn", turn).withColumn("weight", weight), "mix-sources")

    def wide(x) -> Column:
        return (x if isinstance(x, Column) else F.lit(str(x))).cast("decimal(19,0)")

    total = known.agg(F.sum("source_size")).first()[0] or 0
    used, rest = 0, known.agg(F.sum("weight")).first()[0] or 1
    num, den = budget.numerator, budget.denominator
    while True:
        # above its cap: cap * size < (budget - used) * weight / rest, in whole numbers
        left = num * total - den * cap * used
        full = wide(F.col("source_size") * den * cap) * wide(rest) < wide(left) * wide(F.col("weight"))
        now = known.agg(
            F.sum(F.when(full, F.col("source_size")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        if (now[0] or 0, now[1] or 1) == (used, rest):
            break
        used, rest = now[0] or 0, now[1] or 1
    share = F.lit(float(left)) * F.col("weight").cast("double") / F.lit(float(den * rest))
    return known.withColumn("target", F.when(full, (F.col("source_size") * cap).cast("double")).otherwise(share))


def assign(docs: DataFrame, schedules=SCHEDULES, budget: Fraction = BUDGET, cap: int = MAX_EPOCHS) -> DataFrame:
    """doc_id, source, print, size, source_size, target, copies, taken,
    positions (one a copy, in 0..1) for every row of ``docs``."""
    sized = stored(with_sizes(docs), "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stored(targets(sources, schedules, budget, cap), "mix-targets").drop("weight")
    digits = max(2, math.ceil(math.log(max(1, sized.count() / BUCKET_ROWS), 16)))
    p = plan.withColumnRenamed("source", "__source")
    rows = sized.join(p, F.col("source").eqNullSafe(F.col("__source"))).drop("__source").withColumn("bucket", F.substring("key", 1, digits))
    per = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("__sum"))
    # at most 16 ** digits rows a source
    before = per.select("rank", "bucket", (F.sum("__sum").over(W.partitionBy("rank").orderBy("bucket")) - F.col("__sum")).alias("__before"))
    inside = W.partitionBy("rank", "bucket").orderBy("key", "size", "print").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("__upto", F.sum("size").over(inside)).join(before, ["rank", "bucket"])
    start = F.col("__before") + F.col("__upto") - F.col("size")
    size, z, target = F.col("source_size"), F.col("source_size").cast("double"), F.col("target")
    epochs = F.when(size > 0, F.floor(target / z)).otherwise(0).cast("long")
    rest = target - F.col("epochs").cast("double") * z
    more = (F.col("size") > 0) & ((2 * F.col("start") + F.col("size")).cast("double") <= F.lit(2.0) * rest)
    copies = F.when(F.col("size") > 0, F.col("epochs") + more.cast("long")).otherwise(0)
    rows = rows.withColumn("start", start).withColumn("epochs", epochs).withColumn("copies", copies)

    def position(e: Column) -> Column:
        share = F.least(F.lit(1.0), (e * F.col("source_size") + F.col("start") + F.col("size") / 2) / F.col("target"))
        out = F.lit(0.0)
        for k, knots in enumerate(schedules):
            out = F.when(F.col("turn") == k, time_at(share, knots)).otherwise(out)
        return out

    positions = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1), position))
    return rows.select(
        "doc_id", "source", "print", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
        F.coalesce(positions, F.array().cast("array<double>")).alias("positions"),
    )


def mixed(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: the rows of ``docs``, one a copy, range-sorted by
    ``position``.  Rows of equal id, source and text share their copies."""
    docs = docs.drop("position")
    own = ["__id", "__source", "__print"]

    def key(doc_id: str, source: str, print_: Column) -> Column:
        return F.xxhash64(F.col(doc_id), F.col(doc_id).isNull(), F.col(source), F.col(source).isNull(), print_)

    plan = assign(docs, **kw).where(F.col("copies") > 0)
    plan = plan.groupBy(F.col("doc_id").alias(own[0]), F.col("source").alias(own[1]), F.col("print").alias(own[2]))
    plan = plan.agg(F.flatten(F.collect_list("positions")).alias("__at")).withColumn("__key", key(*own[:2], F.col(own[2])))
    same = F.col("doc_id").eqNullSafe(F.col(own[0])) & F.col("source").eqNullSafe(F.col(own[1])) & (F.xxhash64("text") == F.col(own[2]))
    plan = stored(plan, "mix-plan")
    rows = docs.withColumn("__key", key("doc_id", "source", F.xxhash64("text"))).join(plan, "__key").where(same)
    # dealt by the join's key already: the texts aren't shuffled again
    one = F.row_number().over(W.partitionBy("__key", *own).orderBy(own[0]))
    rows = rows.withColumn("__nth", one).where(F.col("__nth") == 1).drop(*own, "__nth", "__key")
    # written once, so that the join's shuffle is gone before the sort's comes
    rows = stored_alone(rows, "mix-rows")
    return rows.withColumn("position", F.explode("__at")).drop("__at").repartitionByRange(F.col("position"), F.col("doc_id")).sortWithinPartitions("position", "doc_id")
