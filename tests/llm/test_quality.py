import re
from collections import Counter

from pyspark.sql import functions as F

from tessera.llm import rulecascade


def metrics(text):
    text = text or ""
    w = [x for x in re.split(r"[ \t-\r]+", text) if x]
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^ \t-\r]", x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_edges_match_brute_force(clashing, edge_rows):
    got = rulecascade.quality(clashing).collect()
    want = Counter((i, metrics(t)) for i, t, *_ in edge_rows)
    assert Counter((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept) and r.size == "clash"


def test_overlapping_windows(spark):
    rows = [(0, "a a a a a a"), (1, "a b c d e f a b c d e"), (2, "a b c d e " * 3), (3, "a b c d a b c d")]
    got = rulecascade.text_metrics(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_repeat_words for r in got} == {i: metrics(t)[4] for i, t in rows}


def test_order_changes_the_work_not_the_verdict(edges):
    judged = rulecascade.text_metrics(edges)
    rules = rulecascade.default_rules()
    one = rulecascade.apply_cascade(judged, rules).select((F.col("failed_rule").isNull()).alias("k")).collect()
    two = rulecascade.apply_cascade(judged, rules[::-1]).select((F.col("failed_rule").isNull()).alias("k")).collect()
    assert one == two


def test_plan_puts_rejection_per_cost_first(spark):
    df = spark.createDataFrame([(i, "word " * (3 if i % 2 else 50)) for i in range(200)], "doc_id long, text string")
    order = rulecascade.plan_cascade(df, rulecascade.default_rules())
    gain = [share / max(cost, 1e-12) for _, cost, share in order]
    assert gain == sorted(gain, reverse=True) and order[-1][2] == 0


def test_empty(empty):
    assert rulecascade.quality(empty).count() == 0


def test_no_python_in_the_plan(edges):
    plan = rulecascade.quality(edges)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
