"""CRCs against zlib, resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import resampling as rs

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, max_run=1):
    w = WORD.findall((text or "").translate(UPPER))
    return [" ".join(w[i : i + n]) for n in range(1, max_run + 1) for i in range(len(w) - n + 1)], len(w)


def brute(docs, target, buckets=10_000, max_run=1, min_words=20, percent=10, seed=2024):
    def crc(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for text in docs:
        for f in features(text[1], max_run)[0]:
            s[crc(f)] += 1
    for text in target:
        for f in features(text, max_run)[0]:
            t[crc(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, (doc_id, text) in enumerate(docs):
        f, words = features(text, max_run)
        weight = sum(gain[crc(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, words, len(f), weight, score, None])
    able = [r for r in rows if r[1] >= min_words]
    able.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for nth, r in enumerate(able[: len(able) * percent // 100], 1):
        r[5] = nth
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("sizes", [[1], [3, 64, 65], [1, 500, 128, 129, 63, 4000, 2]])
def test_span_crcs(sizes):
    r = np.random.default_rng(5)
    raw = r.integers(0, 256, 5000, dtype=np.uint8)
    start = np.array([int(r.integers(0, 5000 - n)) for n in sizes])  # spans may overlap
    want = [zlib.crc32(raw[a : a + n].tobytes()) for a, n in zip(start, sizes)]
    assert rs.span_crcs(raw, start, np.array(sizes), lower=False).tolist() == want
    low = [zlib.crc32(raw[a : a + n].tobytes().lower()) for a, n in zip(start, sizes)]
    assert rs.span_crcs(raw, start, np.array(sizes)).tolist() == low


@pytest.mark.parametrize("max_run", [1, 3])
def test_feature_buckets(max_run, monkeypatch):
    monkeypatch.setattr(rs, "_BLOCK", 7)
    monkeypatch.setattr(rs, "_CHUNK", 50)
    texts = ["One two,  THREE\n4four ééx", "", "a", "glued", "...", "x" * 300 + " y中 z", "end"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.r_[0, np.cumsum([len(t.encode()) for t in texts])]
    got = list(rs.feature_buckets(raw, off, 997, max_run))
    for run, (found, at) in enumerate(got, 1):
        for k, t in enumerate(texts):
            f, n = features(t, max_run)
            want = [zlib.crc32(x.encode()) % 997 for x in f if x.count(" ") == run - 1]
            assert found[at[k] : at[k + 1]].tolist() == want


def corpus(edge_rows):
    r = random.Random(3)
    words = "alpha beta Gamma delta zeta é1 q7".split()
    rows = [(i, " ".join(r.choice(words[i % 4 :]) for _ in range(r.randint(0, 60)))) for i in range(100, 220)]
    return [(x[0], x[1]) for x in edge_rows] + rows + rows[:7]


@pytest.mark.parametrize("max_run", [1, 2])
def test_against_plain_version(spark, edge_rows, max_run):
    docs, target = corpus(edge_rows), ["gamma delta zeta zeta", None, "", "Q7 Q7 new"]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = rs.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), max_run=max_run)
    assert sorted([tuple(x) for x in got.collect()], key=repr) == brute(docs, target, max_run=max_run)


def test_empty_tables_and_clashing_columns(spark, empty, clashing, edge_rows):
    target = spark.createDataFrame([("alpha beta",)], "text string")
    assert rs.resample(empty, target).count() == 0
    docs = [(x[0], x[1]) for x in edge_rows]
    got = rs.resample(clashing.withColumn("weight", F.lit("clash")), target.where("false"))
    assert sorted([tuple(x) for x in got.collect()], key=repr) == brute(docs, [])
