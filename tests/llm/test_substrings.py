import random

import numpy as np
import pytest

from tessera.llm import substrings
from tessera.llm.anchors import LENGTH, anchors

from .conftest import prose


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, kept) by a set of all windows."""
    seen, out = set(), []
    for i, t in sorted(rows):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - LENGTH + 1):
            w = raw[p : p + LENGTH]
            if w in seen:
                gone[p : p + LENGTH] = True
            seen.add(w)
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(raw), int(gone.sum()), runs, np.frombuffer(raw, np.uint8)[~gone].tobytes()))
    return out


def rows_of(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect())


def corpus():
    r = random.Random(4)
    shared = [prose(40, s) for s in range(5)]
    rows = []
    for i in range(60):
        parts = [prose(r.randint(0, 40), 100 + i)]
        for _ in range(r.randint(0, 3)):
            s = r.choice(shared)
            lo = r.randint(0, 60)
            parts += [s[lo : lo + r.randint(90, 250)], prose(r.randint(0, 10), r.random())]
        rows.append((i, "é ".join(parts)))
    rows += [(70, rows[3][1]), (71, rows[3][1] + "!"), (72, "ab" * 400), (73, "a" * 350), (74, "x" + "a" * 99), (75, "a" * 100), (76, ""), (77, None)]
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(substrings.remove_repeats(docs)) == brute(rows)


def test_crowded_grams_and_small_chunks(spark, monkeypatch):
    """Grams dealt by windows, and streams cut into many chunks and batches."""
    monkeypatch.setattr(substrings, "LEAST_LIMIT", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = corpus()
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        assert rows_of(substrings.remove_repeats(docs)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_refine_finds_equal_strings():
    r = np.random.default_rng(5)
    flat = r.integers(97, 99, 400).astype(np.uint8)
    off = np.array([0, 150, 150, 400])
    for length, q in ((7, 2), (8, 4), (9, 9), (20, 3)):
        place, bucket = substrings.refine(flat, off, length, q)
        inside = [p for lo, hi in zip(off, off[1:]) for p in range(lo, hi - length + 1)]
        groups = {}
        for p in inside:
            groups.setdefault(flat[p : p + length].tobytes(), []).append(p)
        want = sorted(tuple(g) for g in groups.values() if len(g) > 1)
        got = {}
        for p, b in zip(place.tolist(), bucket.tolist()):
            got.setdefault(b, []).append(p)
        assert sorted(tuple(sorted(g)) for g in got.values()) == want


def test_every_window_belongs_to_one_anchor_and_equal_windows_to_equal_ones():
    texts = [prose(120, 6) + prose(300, 7) + prose(120, 6), "short", "q" * 250, "", prose(30, 8)]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.r_[0, np.cumsum([len(t) for t in texts])]
    own = {}
    for i, first, count, gram in zip(*(x.tolist() for x in anchors(raw, off))):
        for p in range(first, first + count):
            assert p not in own and off[i] <= p
            own[p] = gram
    assert sorted(own) == [p for lo, hi in zip(off, off[1:]) for p in range(lo, hi - LENGTH + 1)]
    seen = {}
    for p, anchor in own.items():
        assert seen.setdefault(raw[p : p + LENGTH].tobytes(), anchor) == anchor


def test_edges(spark, clashing, edges):
    got = {}
    for r in substrings.remove_repeats(clashing).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert all(bytes(r.kept).decode() == (r.text or "") and r.n_removed == 0 for r in got[None])
    assert len(got[11]) == 2 and {r.n_removed for r in got[11]} == {0}  # one document, under LENGTH
    assert len(got[12]) == 2
    assert got[1][0].n_removed == 0 and got[2][0].n_removed == got[2][0].n_bytes and bytes(got[2][0].kept) == b""
    assert got[4][0].n_bytes == 0 and got[5][0].n_spans == 0
    assert got[7][0].n_removed == got[7][0].n_bytes - 1  # the first byte of a run stays
    assert substrings.remove_repeats(spark.createDataFrame([], edges.schema)).count() == 0


@pytest.mark.parametrize("spans,want", [([(0, 3)], (b"defghij", 3, 1)), ([(2, 5), (5, 7), (6, 20)], (b"ab", 8, 1)), ([(1, 2), (8, 12)], (b"acdefgh", 3, 2))])
def test_cut_spans(spans, want):
    assert substrings.cut_spans(b"abcdefghij", spans) == want
