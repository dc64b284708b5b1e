"""The prefix trie against a dictionary of all prefixes."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import prefixtrie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, graft=lambda c: (c, 0)):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            told = f"{len(role or '')}:{role or ''}{text or ''}"
            own[c].append((turn is not None, turn or 0, hashlib.sha256(told.encode()).digest()[:16], role or "", text or ""))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in turns:
        donor, h = graft(c)
        built[c] = tuple(turns.get(donor, [])[:h] + turns[c][h:])
    nodes = defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            nodes[t[:d]].append(c)
    kids = defaultdict(int)
    for k in nodes:
        if k:
            kids[k[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1].encode()) if k else 0
    out = []
    for k, members in nodes.items():
        done = ",".join(str(c) for c in sorted(c for c in members if len(built[c]) == len(k)))
        parent = min(nodes[k[:-1]]) if k else None
        out.append((min(members), len(k), parent, len(members), kids[k], leaves[k], saved[k], hashlib.sha256(done.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted([tuple(r) for r in df.drop("key").collect()], key=repr)


def graft(c):
    rest = c % 5 if c >= 0 else -(-c % 5)
    return c - rest, zlib.crc32(str(c).encode()) % 9


def conversations():
    import random

    r = random.Random(4)
    rows = []
    for c in [*range(-7, 60), 203, 204]:
        n = r.choice([1, 2, 3, 4, 10])
        rows += [(c, t, r.choice(["user", "assistant"]), r.choice(["yes", "no", "é" * 3])) for t in range(n)]
    rows += [(70, None, None, None), (70, 3, "user", ""), (70, 3, "user", "tie"), (70, 3, "user", "tie"), (70, 1, "user", "x" * 100_000)]
    return rows + [(None, 0, "user", "yes"), (None, None, None, None)]


def test_against_brute_force(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(pt.prefix_trie(df, size=4)) == brute(rows)


def test_rebuilt_conversations(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(pt.prefix_trie(df, pt.grafted, pt.STEP, pt.MOST)) == brute(rows, graft)


def test_spines_of_several_blocks(spark):
    """Shared prefixes and lone tails longer than a block."""
    rows = [(c, t, "user", str(t) if t < 2 * c else f"{c} {t}") for c in range(1, 5) for t in range(4 * c)]
    rows += [(9, t, "user", str(t)) for t in range(7)]  # ends inside the others
    rows += [(10 + k, t, "user", str(t)) for k in range(3) for t in range(6)]  # copies
    df = spark.createDataFrame(rows, SCHEMA)
    assert {len(b.spine) for b in pt.spines(pt.digests(df), size=3).collect()} == {2, 3, 4}
    assert got(pt.prefix_trie(df, size=3)) == brute(rows)


def test_one_long_conversation_takes_few_rounds(spark, monkeypatch):
    rounds = []
    merged = pt._merged
    monkeypatch.setattr(pt, "_merged", lambda rows: rounds.append(1) or merged(rows))
    rows = [(1, t, "user", str(t)) for t in range(200)] + [(2, t, "user", str(t)) for t in range(2)]
    assert got(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA), size=4)) == brute(rows)
    assert len(rounds) == 5


def test_hot_node(spark):
    """A third of all conversations end at one node, whose ids need many pieces."""
    rows = [(c, 0, "user", "hello" if c % 3 else str(c)) for c in range(600)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(pt.prefix_trie(df, piece_bytes=200)) == brute(rows)


def test_empty_table_and_extra_columns(spark):
    empty = pt.prefix_trie(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[:4] == ["conv_id", "depth", "parent_conv_id", "n_convs"]
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("depth", "key", "spine", "block", "group", "bytes")})
    assert got(pt.prefix_trie(df)) == brute(rows)


@pytest.mark.parametrize("conv_id", [0, 1, 4, 5, -1, -6, 10**12 + 3])
def test_graft(conv_id):
    assert pt.grafted(conv_id) == graft(conv_id)
