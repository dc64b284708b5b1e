import hashlib
from collections import defaultdict

import numpy as np

from tessera.llm import cuckoolines
from tessera.llm.cuckoolines import CuckooFilter

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    k = line.strip(SPACE)
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k) if len(k) >= 20 else None


def brute(rows):
    holders = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if key(x):
                holders[key(x)].add(i)
    keeper = {k: max(i for i in d if i is not None) for k, d in holders.items() if len(d) >= 3}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in df.collect()), key=str)


def test_edges_match_brute_force(clashing, edge_rows):
    assert rows_of(cuckoolines.dedup_lines(clashing)) == brute([(i, t) for i, t, *_ in edge_rows])


def test_empty(empty):
    assert cuckoolines.dedup_lines(empty).count() == 0


def test_insert_and_delete_are_reversible(spark):
    line = [f"common line number {k} of the documents" for k in range(6)]
    rows = [(i, "\n".join([line[i % 6], line[(i + 1) % 6].upper(), f"own line of document {i} and no other"])) for i in range(12)]
    more = [(20 + i, "\n".join([line[0], line[3], "brand new shared line of text"])) for i in range(4)]
    docs, extra = (spark.createDataFrame(r, "doc_id long, text string") for r in (rows, more))
    index = cuckoolines.insert(cuckoolines.build(docs), extra)
    both = docs.unionByName(extra)
    assert rows_of(cuckoolines.apply(both, cuckoolines.drops(index))) == brute(rows + more)
    again = cuckoolines.insert(index, extra)  # nothing new
    assert sorted(again.refs.collect()) == sorted(index.refs.collect())
    back = cuckoolines.delete(index, extra.select("doc_id"))
    fresh = cuckoolines.build(docs)
    assert sorted(back.refs.collect()) == sorted(fresh.refs.collect())
    assert rows_of(cuckoolines.apply(docs, cuckoolines.drops(back))) == brute(rows)
    less = cuckoolines.delete(back, docs.where("doc_id >= 9").select("doc_id"))
    assert rows_of(cuckoolines.apply(docs.where("doc_id < 9"), cuckoolines.drops(less))) == brute(rows[:9])


def test_filter_holds_what_was_added_and_not_removed():
    keys = np.random.default_rng(3).integers(-(1 << 62), 1 << 62, 30_000)
    f = CuckooFilter.build(keys[:20_000])
    assert f.holds(keys[:20_000]).all()
    assert f.holds(keys[20_000:]).mean() < 0.01
    f.remove(keys[:5_000])
    assert f.holds(keys[5_000:20_000]).all() and f.holds(keys[:5_000]).mean() < 0.01
    assert f.add(keys[20_000:22_000]) and f.holds(keys[5_000:22_000]).all()
    assert CuckooFilter.from_bytes(f.to_bytes()).holds(keys[5_000:22_000]).all()


def test_equal_fingerprints_are_removed_one_a_key():
    keys = np.random.default_rng(4).integers(-(1 << 62), 1 << 62, 60)
    f = CuckooFilter(np.zeros((64, 4), np.uint16))
    print_, bucket = np.full(60, 7, np.uint16), np.arange(60) % 8
    bucket[30:] = f._other(print_[30:], bucket[:30])  # keys of one class from either side
    f._place = lambda k: (print_[: len(k)], bucket[: len(k)])
    spread = CuckooFilter(np.zeros((64, 4), np.uint16))
    spread._place = f._place
    assert spread.add(keys[:20])
    held = (spread.table == 7).sum()
    spread.remove(keys[:15])
    assert held == 20 and (spread.table == 7).sum() == 5


def test_filter_copies_follow_the_pairs(spark, monkeypatch):
    monkeypatch.setattr(cuckoolines, "GROUP_PAIRS", 5)
    rows = [(i, "a line that every document here holds\nanother line that all of them hold\n" + f"own line of document {i} and no other") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = cuckoolines.build(docs)
    n = index.pairs.count()
    salts = cuckoolines._salts(index, index.pairs).collect()
    assert n == 120 and n / 5 <= sum(r.salts for r in salts) <= n / 5 + index.shards
    assert rows_of(cuckoolines.apply(docs, cuckoolines.drops(index))) == brute(rows)


def test_a_full_filter_says_so():
    f = CuckooFilter(np.zeros((4, 4), np.uint16))
    assert not f.add(np.arange(40))


def test_key_digest_ignores_case_and_ends():
    assert cuckoolines.line_key("  A line of TWENTY characters\r") == hashlib.blake2b(b"a line of twenty characters", digest_size=16).digest()
    assert cuckoolines.line_key("short") is None
