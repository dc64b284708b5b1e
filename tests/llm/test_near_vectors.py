import numpy as np
from pyspark.sql import functions as F

from tessera.llm import projection


def brute(rows):
    """vec_id -> (links, component) over all pairs."""
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, low = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}
    edges = []
    for n, (i, a) in enumerate(ok):
        for j, b in ok[:n]:
            if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95:
                links[i] += 1
                links[j] += 1
                edges.append((i, j))
    for _ in rows:
        for i, j in edges:
            low[i] = low[j] = min(low[i], low[j])
    return {i: (links[i], low[i]) for i, _ in rows}


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)


def vectors(n, size, seed, groups):
    r = np.random.default_rng(seed)
    rows = [r.standard_normal(size) for _ in range(n)]
    for g in range(groups):
        base = r.standard_normal(size)
        rows += [base + 0.15 * r.standard_normal(size) for _ in range(12)] + [base] * 3
    return [(i, v.tolist()) for i, v in enumerate(rows)]


def test_matches_brute_force_when_windows_cover_the_table(spark):
    rows = vectors(120, 16, 1, 4)
    got = {r.vec_id: (r.n_links, r.component_id) for r in projection.near_vectors(table(spark, rows)).collect()}
    assert got == brute(rows)


def test_small_windows_and_blocks_reach_the_recall(spark):
    rows = vectors(600, 32, 2, 10)
    want = brute(rows)
    got = {r.vec_id: r for r in projection.near_vectors(table(spark, rows), window=32, block=64).collect()}
    assert all(got[i].n_links <= n for i, (n, _) in want.items())
    found, there = sum(r.n_links for r in got.values()), sum(n for n, _ in want.values())
    assert found >= 0.9 * there
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_group_of_many_windows_has_all_its_links(spark):
    r = np.random.default_rng(3)
    base = r.standard_normal(16)
    tight = [(i, (base + 1e-6 * r.standard_normal(16)).tolist()) for i in range(400)]
    rows = tight + [(i + 1000, v) for i, v in vectors(100, 16, 4, 3)]
    want = brute(rows[400:])
    for part in (8192, 64):  # in one task, and part against part
        got = {r.vec_id: (r.n_links, r.component_id) for r in projection.near_vectors(table(spark, rows), window=32, block=64, part=part).collect()}
        assert all(got[i] == (399, 0) for i, _ in tight)
        assert all(got[i][0] <= n for i, (n, _) in want.items())


def test_equal_hashes_are_ordered_anew_in_every_pass(spark):
    hashes = spark.range(200).select(F.explode(F.sequence(F.lit(0), F.lit(1))).alias("pass"), F.lit(7).cast("long").alias("hash"), F.col("id").alias("node"))
    ranks = [r.ranks for r in projection._ranks(hashes, 200).collect()]
    assert sorted(a for a, _ in ranks) == sorted(b for _, b in ranks) == list(range(200))
    assert sum(abs(a - b) > 20 for a, b in ranks) > 100


def test_unusable_vectors_link_with_nothing(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [1.0, 0.0]), (10, [1.0, 0.0]), (None, [1.0, 0.0]), (11, [1e300, 1e290]), (12, [-1.0, 0.0])]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in projection.near_vectors(table(spark, rows)).collect()), key=str)
    group = {i: (i, 4, 1, i == 1) for i in (1, 2, 10, 11)}
    want = [group[1], group[2], group[10], group[10], group[11], (None, 0, None, True)]
    want += [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 12)]
    assert got == sorted(want, key=str)


def test_empty(spark):
    assert projection.near_vectors(table(spark, [])).count() == 0
