"""The stages on a small corpus, each against a brute-force version."""

from collections import Counter

import corpus_pipeline as p
import pytest

from .conftest import prose
from .test_lines import brute as brute_lines
from .test_near_documents import brute_components


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    shared = "A shared line that many of the documents hold."
    rows = [(i, prose(60, i) + ("\n" + shared if i % 4 == 0 else ""), "en", f"s{i % 3}", 1) for i in range(40)]
    rows += [(50 + i, rows[i][1] + " end", "en", "s1", 1) for i in range(8)]
    rows += [(60, "123 !!!", "en", "s0", 1), (61, None, None, None, None), (62, "", "en", "s0", 0), (63, prose(50, 63), None, None, None)]
    docs, out = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), {}
    out["documents"] = docs.collect()
    for name, f in p.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        f(spark, docs, "").write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = docs.collect()
        if name != "bpe":
            assert docs.columns == list(p.COLUMNS)
    return out


def test_order():
    assert [n for n, _ in p.STAGES] == ["language_id", "line_dedup", "near_dedup", "mix_sources", "bpe"]


def test_language_rejects_rows_without_letters(stages):
    want = {r.doc_id for r in stages["documents"] if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in stages["language_id"]} == want and all(r.lang for r in stages["language_id"])


def test_lines(stages):
    want = {i: t for i, _, _, t in brute_lines([(r.doc_id, r.text) for r in stages["language_id"]])}
    assert {r.doc_id: r.text for r in stages["line_dedup"]} == want
    assert all(r.n_chars == len(r.text) for r in stages["line_dedup"])


def test_one_of_each_group_stays(stages):
    want = brute_components([(r.doc_id, r.text) for r in stages["line_dedup"]])
    assert sorted(r.doc_id for r in stages["near_dedup"]) == sorted(set(want.values()))


def test_mix(stages):
    before, after = stages["near_dedup"], stages["mix_sources"]
    taken = Counter(r.doc_id for r in after)
    assert max(taken.values()) <= 2 and set(taken) <= {r.doc_id for r in before}
    words = sum(len(r.text.split()) for r in before)
    assert abs(sum(len(r.text.split()) for r in after) - 1.5 * words) <= 4 * 70


def test_encoded_rows(stages):
    assert Counter(r.doc_id for r in stages["bpe"]) == Counter(r.doc_id for r in stages["mix_sources"])
    assert all(r.n_tokens > 0 for r in stages["bpe"])


def test_empty_table(spark, empty):
    docs = empty
    for _, f in p.STAGES:
        docs = f(spark, docs, "")
    assert docs.count() == 0


def test_repeated_ids_and_clashing_columns(spark, tmp_path):
    """A text stays if none near it does; columns named like the stages' own are
    left behind."""
    a, b = prose(60, 1), prose(60, 2)
    rows = [(5, a, "en", "s0", 1), (5, b, "en", "s0", 1), (3, b, "en", "s1", 1), (9, a + " end", "en", "s1", 1), (9, prose(60, 3), None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "'clash' as kept", "1 as print", "2 as low_id", "3 as position", "4 as size", "5 as lang_pred")
    for name, f in p.STAGES:
        f(spark, docs, "").write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "near_dedup":
            assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted([(5, a), (3, b), (9, rows[4][1])])
    assert docs.columns[0] == "doc_id" and docs.count() >= 3
