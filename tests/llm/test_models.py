"""Toxicity and language ID: held-out accuracy, edges, brute force."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np

from tessera.llm import ppm, queries, toxicity

SF = "/root/testdata/sf0.01"


def slow_bits(samples, raw):
    """Code length by walking the context trees byte by byte."""
    trees = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
    for t in samples:
        x = b"\n" * ppm.ORDER + t
        for i in range(ppm.ORDER, len(x)):
            for d in range(ppm.ORDER + 1):
                trees[d][x[i - d : i]][x[i]] += 1
    x, total = b"\n" * ppm.ORDER + raw, 0.0
    for i in range(ppm.ORDER, len(x)):
        for d in range(ppm.ORDER, -1, -1):
            seen = trees[d].get(x[i - d : i])
            if seen:
                n, kinds = sum(seen.values()), len(seen)
                if x[i] in seen:
                    total -= math.log2(seen[x[i]] / (n + kinds))
                    break
                total -= math.log2(kinds / (n + kinds))
        else:
            total += 8
    return total


def test_code_lengths_match_the_trees(monkeypatch):
    samples = {"en": [b"the cat sat on the mat", b"that hat"], "de": ["für die Katze im Hut".encode(), b"das ist der Hut"]}
    model = ppm.train(samples)
    texts = [b"the hat", "für den Hut".encode(), b"", b"\x00\xff zzz", b"a" * 50]
    bits = model.bits_of_many(texts)
    for k, lang in enumerate(model.languages):
        for t, b in zip(texts, bits[:, k]):
            assert abs(b - slow_bits(samples[lang], t)) < 1e-3
    monkeypatch.setattr(ppm, "_BLOCK", 16)  # a text longer than a block
    assert np.allclose(model.bits_of_many(texts), bits, atol=1e-3)


def test_scoring_works_in_small_blocks():
    import tracemalloc

    model = ppm.train({k: [(k * 40 + " the cat sat on the mat").encode()] for k in ("en", "de", "fr", "es")})
    texts = [b"the cat sat on the mat " * 40] * 1000 + [b"xyz " * 60_000]
    tracemalloc.start()
    try:
        model.bits_of_many(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 30e6  # with 1 MB blocks 76 MB


def test_texts_need_not_come_back(spark, edges):
    model = ppm.train({"en": [b"alpha beta gamma"], "fr": ["é è ê".encode()]})
    got = ppm.identify(edges.select("text", "doc_id"), model, keep_text=False)
    whole = ppm.identify(edges.select("text", "doc_id"), model)
    assert got.columns == ["doc_id", "lang_pred", "score"]
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.drop("text").collect()))


def test_fewer_nodes_still_give_code_lengths():
    samples = {"a": [b"abcabcabcabd"], "b": [b"xyzxyzxyw"]}
    model = ppm.train(samples, max_cells=200)
    assert model.cost.size <= 200 * 2 and model.bits(b"abcabc").argmin() == 0


def test_language_held_out(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op8_language_id(spark, SF).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.98 * len(held)


def test_language_edges(spark, clashing, empty):
    model = ppm.train({"en": [b"alpha beta gamma delta epsilon zeta"], "fr": ["é è ê".encode()]})
    got = ppm.identify(clashing, model).collect()
    for r in got:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "fr") and r.size == "clash"
    assert ppm.identify(empty, model).count() == 0
    assert ppm.fit(empty) is None
    assert {r.lang_pred for r in ppm.identify(clashing, None).collect()} == {"und"}
    nothing = ppm.train({"en": [b"aa"], "de": [b"aa"]}).bits_of_many([b"a"])
    assert nothing.argmin(1).tolist() == [0]  # ties: first by code point


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    got = queries.op7_toxicity(spark, "/root/testdata/sf0.1").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for r in got)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    toxic, clean = [p for y, p in held if y], [p for y, p in held if not y]
    assert sum(toxic) >= 0.75 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def biased():
    """Labels in which one group is named mostly in toxic texts."""
    r = np.random.default_rng(7)
    fill = [f"word{k}" for k in range(300)]
    texts, toxic = [], []
    for k in range(600):
        y = k % 3 == 0
        words = list(r.choice(fill, 20))
        if y:
            words[3] = r.choice(["idiot", "scum", "moron"])
        if r.random() < (0.6 if y else 0.03):
            words[8] = "muslims"
        texts.append(" ".join(words))
        toxic.append(int(y))
    return texts, toxic


def test_counterfactuals_take_the_group_out_of_the_score():
    texts, toxic = biased()
    free, tied = (toxicity.train(texts, toxic, penalty=p).scorer() for p in (0.0, 5.0))
    neutral = ["muslims word1 word2 word3", "people word1 word2 word3"]
    gap = [abs(np.subtract(*f(neutral))) for f in (free, tied)]
    assert gap[1] < 0.25 * gap[0]
    assert tied(["word5 you idiot word7"])[0] >= 0.7 > tied(["muslims word5 word7"])[0]


def test_swap_keeps_the_kind():
    assert toxicity.swapped("The women and Muslims") == "The men and jews"
    assert toxicity.swapped("nobody here") is None


def test_swap_knows_the_languages():
    for text in ("die Frauen und Muslime", "les femmes et les musulmans", "las mujeres y los musulmanes"):
        new = toxicity.swapped(text)
        assert new is not None and sum(a != b for a, b in zip(text.split(), new.split())) == 2


def test_label_weight_is_chosen_on_the_training_folds():
    texts, toxic = biased()
    assert toxicity.choose_power(texts, toxic) in toxicity.POWERS
    assert toxicity.choose_power(texts, toxic) == toxicity.choose_power(texts, toxic)


def test_toxicity_edges(clashing, empty):
    texts, toxic = biased()
    model = toxicity.train(texts, toxic)
    got = toxicity.classify(clashing, model).collect()
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) and r["size"] == "clash" for r in got)
    assert len({r.score for r in got if not r.text}) == 1
    assert toxicity.classify(empty, model).count() == 0
    assert toxicity.train(["a b c"], [1]).weights == {}
