from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tessera.llm import curriculum

from .conftest import prose


def brute_targets(sizes):
    """Targets by the contract's words: share, cap, reshare until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = Fraction(3, 2) * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] > 2 * sizes[s]}
        if not over:
            return out | {s: unit * weight[s] for s in open_}
        for s in over:
            out[s] = Fraction(2 * sizes[s])
            left -= out[s]
        open_ -= over
    return out


def test_targets_and_taken(spark):
    rows = [(i, prose(5 + i * 7 % 40, i), f"s{i % 7}" if i % 9 else None) for i in range(300)]
    rows += [(1000 + i, prose(30, i), "z-big") for i in range(200)] + [(2000, "word", "Z-one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = curriculum.assign(docs).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want = brute_targets(sizes)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(want[r.source]))
        assert r.taken in (0, r.size, 2 * r.size) and len(r.positions) == r.copies
        assert list(r.positions) == sorted(r.positions) and all(0 <= p <= 1 for p in r.positions)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1e-6
    again = curriculum.assign(docs.repartition(2)).collect()
    assert sorted((r.doc_id, r.taken, tuple(r.positions)) for r in got) == sorted((r.doc_id, r.taken, tuple(r.positions)) for r in again)


def test_schedules_integrate_to_the_weights_and_invert(spark):
    assert [curriculum.integral(k) for k in curriculum.SCHEDULES] == [3, 1, 2]
    for knots in curriculum.SCHEDULES:
        df = spark.range(101).select((F.col("id") / 100).alias("share"))
        for r in df.select("share", curriculum.time_at(F.col("share"), knots).alias("t")).collect():
            area = 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                x = min(max(r.t - float(t0), 0), float(t1) - float(t0))
                area += float(w0) * x + (float(w1) - float(w0)) / (float(t1) - float(t0)) * x * x / 2
            assert area / float(curriculum.integral(knots)) == pytest.approx(r.share, abs=1e-9)


def test_early_sources_come_early(spark):
    rows = [(i, prose(20, i), "abc"[i % 3]) for i in range(600)]
    got = curriculum.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    mean = {s: sum(r.position for r in got if r.source == s) / sum(r.source == s for r in got) for s in "abc"}
    assert mean["a"] < 0.46 < 0.54 < mean["b"]
    assert [r.position for r in got] == sorted(r.position for r in got)


def test_edges(clashing, edges, edge_rows):
    got = curriculum.assign(clashing).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in edge_rows)
    assert all(r.taken == 0 for r in got if r.size == 0) and all(0 <= r.taken <= 2 * r.size for r in got)
    mix = curriculum.mixed(clashing)
    assert set(mix.columns) == set(clashing.columns)
    assert mix.count() == sum(r.copies for r in got)


def test_empty(empty):
    assert curriculum.assign(empty).count() == 0 and curriculum.mixed(empty).count() == 0
    nothing = empty.sparkSession.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in curriculum.assign(nothing).collect()] == [(0.0, 0), (0.0, 0)]


def shuffle_files(spark):
    files = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles())
    return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle")}


def test_the_joins_shuffle_is_gone_before_the_sort(spark):
    import random
    import time

    r = random.Random(5)
    rows = [(i, " ".join(f"{r.getrandbits(64):x}" for _ in range(200)), "en", "abc"[i % 3], 1) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, held = shuffle_files(spark), spark.conf.get(key, None)
    mix = curriculum.mixed(docs)
    for _ in range(20):
        left = sum(n for k, n in shuffle_files(spark).items() if k not in before)
        if left < 500_000:
            break
        time.sleep(0.1)
    assert left < 500_000  # the texts have 1.3 MB
    assert spark.conf.get(key, None) == held
    assert mix.count() > 400
