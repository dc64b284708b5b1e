import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import components as components_module
from tessera.llm import oddsketch, shingles
from tessera.llm.common import text_bytes
from tessera.llm.components import components

from .conftest import prose


def word_sets(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    """doc_id -> smallest reachable doc_id, over all pairs of rows."""
    sets = [(i, word_sets(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in parent}


def edited(text, every, seed):
    w = text.split()
    return " ".join(f"changed{seed}" if k % every == seed % every else x for k, x in enumerate(w))


def test_shingles_match_brute_force(edge_rows):
    texts = [t or "" for _, t, *_ in edge_rows] + ["A b\tC", "a b c d e\x0bf", "é É e", "\x1ca b"]
    sets, off = shingles.shingle_sets(*text_bytes(pa.array(texts)))
    assert np.diff(off).tolist() == [len(word_sets(t)) for t in texts]


def test_blocks_cut_between_words(monkeypatch):
    texts = [prose(500, 1), "w" * 300, prose(50, 2)]
    whole = shingles.shingle_sets(*text_bytes(pa.array(texts)))[0]
    monkeypatch.setattr(shingles, "_BLOCK", 64)
    assert (shingles.shingle_sets(*text_bytes(pa.array(texts)))[0] == whole).all()


def test_odd_sketch_estimates_similarity():
    a = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    b = np.concatenate([a[:900], a[:100] + np.uint64(1)])
    x = oddsketch.odd_sketches(oddsketch.minhashes(np.concatenate([a, b]), np.array([0, 1000, 2000])))
    bits = int(np.bitwise_count((x[0] ^ x[1]).view(np.uint64)).sum())
    similarity = 900 / 1100
    assert abs(bits - oddsketch.most_bits(similarity)) < 75


def test_near_documents_on_edges(clashing, edge_rows):
    got = oddsketch.near_documents(clashing).collect()
    assert len(got) == len(edge_rows)
    want = brute_components([(i, t) for i, t, *_ in edge_rows])
    for r in got:
        assert r.component_id == (want[r.doc_id] if r.doc_id is not None else None)
        assert r.kept == (r.doc_id == r.component_id)


def test_star_misses_are_found(spark):
    """A chain and a dense group whose members differ from the smallest one."""
    base = prose(120, 9)
    rows = [(i, edited(base, 60, i)) for i in range(40)]
    chain = prose(100, 10).split()
    for i in range(12):
        chain[8 * i : 8 * i + 4] = [f"n{i}{k}" for k in range(4)]
        rows.append((100 + i, " ".join(chain)))
    want = brute_components(rows)
    got = {r.doc_id: r.component_id for r in oddsketch.near_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and len(set(want.values())) < len(want)


def test_blocks_of_a_crowded_bucket(spark, monkeypatch):
    monkeypatch.setattr(oddsketch, "BLOCK", 4)
    monkeypatch.setattr(oddsketch, "SMALL", 1)
    base = prose(120, 9)
    rows = [(i, edited(base, 20, i)) for i in range(30)]
    got = {r.doc_id: r.component_id for r in oddsketch.near_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)


@pytest.mark.parametrize(("block", "hashes"), [(3, 2_000_000), (1024, 400)])
def test_every_pair_of_open_buckets_meets_once(spark, monkeypatch, block, hashes):
    """Each pair of near members of different components that share a large bucket
    is in one meeting, whatever the blocks; pairs of one component in none."""
    monkeypatch.setattr(oddsketch, "BLOCK", block)
    monkeypatch.setattr(oddsketch, "GROUP_HASHES", hashes)
    base = prose(120, 9)
    rows = [(i, edited(base, 40, i)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "0L as print", "text")
    nodes = oddsketch._nodes(oddsketch.signatures(docs))
    held = {r.rep: r for r in nodes.collect()}
    crowded = nodes.selectExpr("rep", "explode(bands) as band")
    part = {k: k % 3 if k < 20 else k for k in held}
    parts = spark.createDataFrame([(k, p) for k, p in part.items() if k < 20], "node long, component long")
    t = oddsketch._meetings(oddsketch._open_members(crowded, nodes, parts)).join(nodes.select("rep", "size", "sketch", "bands"), "rep").toArrow()
    got = []
    for key in {tuple(k.values()) for k in t.select(["band", "ka", "kb"]).to_pylist()}:
        own = t.filter(pa.array([tuple(k.values()) == key for k in t.select(["band", "ka", "kb"]).to_pylist()]))
        i, j = oddsketch.near_pairs(own, key[0])
        rep = own.column("rep").to_numpy()
        got += [tuple(sorted(p)) for p in zip(rep[i].tolist(), rep[j].tolist())]
    limit = oddsketch.most_bits(0.75 - oddsketch.MARGIN)
    want = set()
    for a in held:
        for b in held:
            bits = sum(bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(held[a].sketch, held[b].sketch))
            sizes = sorted((held[a].size, held[b].size))
            if a < b and part[a] != part[b] and set(held[a].bands) & set(held[b].bands) and bits <= limit and 100 * sizes[0] >= 75 * sizes[1]:
                want.add((a, b))
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20


def test_empty(empty):
    assert oddsketch.near_documents(empty).count() == 0


@pytest.mark.parametrize("limit", [200_000, 8])
def test_components_of_a_long_path(spark, monkeypatch, limit):
    monkeypatch.setattr(components_module, "LOCAL_EDGES", limit)
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 100), (7, 7), (200, 200), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 200: 200}


def test_no_class_is_reported_twice(spark):
    d = spark.createDataFrame([(1, "a b c d e f"), (2, "A B c d e F"), (2, "A B c d e F")], "doc_id long, text string")
    got = defaultdict(list)
    for r in oddsketch.near_documents(d).collect():
        got[r.doc_id].append((r.component_id, r.n_shingles))
    assert got == {1: [(1, 2)], 2: [(1, 2), (1, 2)]}


def test_repeated_ids(spark):
    """Texts of one doc_id are one document for the operator, and rows of their own
    for ``dedup_rows``, which leaves none without a near-duplicate that stays."""
    a, b, c = prose(40, 1), prose(40, 2), prose(40, 3)
    rows = [(5, a), (5, b), (3, b), (9, a), (9, a), (11, c), (11, b + " x y z"), (12, c), (13, ""), (13, b), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.component_id) for r in oddsketch.near_documents(df).collect()}
    assert got == brute_ids(rows)
    assert {(5, 3), (3, 3), (9, 3), (13, 13), (None, None)} < got
    kept = sorted(((r.doc_id, r.text) for r in oddsketch.dedup_rows(df).collect()), key=repr)
    assert kept == sorted(brute_rows(rows), key=repr)


def brute_ids(rows):
    """(doc_id, component) of every row: links between texts, and between the
    texts of an id."""
    sets = [word_sets(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (x, a) in enumerate(zip(rows, sets)):
        for j in range(i):
            if None not in (x[0], rows[j][0]) and a and sets[j]:
                if x[0] == rows[j][0] or 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                    parent[find(i)] = find(j)
    low = defaultdict(list)
    for i, (x, _) in enumerate(rows):
        low[find(i)].append(x)
    return {(x, None if x is None else min(low[find(i)], key=lambda v: (v is None, v)) if sets[i] else x) for i, (x, _) in enumerate(rows)}


def brute_rows(rows):
    """The rows that stay: one text of each group, all its full repeats."""
    texts = {}
    for x, t in rows:
        if x is not None and word_sets(t):
            texts.setdefault((x, t), None)
    names = list(texts)
    parts = brute_components([(k, t) for k, (_, t) in enumerate(names)])
    groups = defaultdict(list)
    for k, (x, t) in enumerate(names):
        groups[parts[k]].append((x, t))
    stay = set()
    for g in groups.values():
        least = min(x for x, _ in g)
        own = [n for n in g if n[0] == least]
        assert len(own) == 1  # the fixture names no group's smallest id twice
        stay.add(own[0])
    return [(x, t) for x, t in rows if x is None or not word_sets(t) or (x, t) in stay]
