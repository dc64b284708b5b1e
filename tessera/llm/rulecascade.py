"""Quality rules as a short-circuit cascade (native DataFrame functions only).

``text_metrics`` gives the metrics of a text as columns; ``Rule`` rejects a
document by a boolean expression over them; ``plan_cascade`` measures every
rule's cost and rejection rate on a bounded sample and orders the rules by
rejection per cost; ``apply_cascade`` runs them in that order as one ``CASE
WHEN`` chain, so that a later rule is evaluated only for rows that all earlier
ones let through.  The order changes the work, never the verdict.

Defined results: a null or empty text has no words and all metrics are 0; a
rule whose expression is null does not reject; repeated rows and ties are
judged row by row; an empty table gives an empty result (and the rules keep
their given order); other columns are carried through, and input columns named
like a result are replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored

SPACES = "[ \\t-\\r]+"
WORD = "[^ \\t-\\r]"
SYMBOLS = "[#*$%&|<>]"
#: windows of this many words are compared for repeats
WINDOW = 5
#: rows at most in the sample that orders the rules
SAMPLE_ROWS = 2_000


@dataclass(frozen=True)
class Rule:
    """``rejects``: boolean Column over the metric columns named in ``needs``."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[], Column]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with value computed once, not once per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def _window_hashes(words: Column) -> Column:
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(
        F.size(words) >= WINDOW,
        _let(
            hashed,
            lambda h: F.transform(
                F.sequence(F.lit(0), F.size(h) - WINDOW),
                lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]),
            ),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _covered(hashes: Column) -> Column:
    """Words lying in a window whose hash occurs twice or more: the windows
    sorted by hash, those equal to a neighbour, then the union of their spans."""
    by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = _let(
        by_hash,
        lambda s: F.transform(
            F.filter(
                F.transform(
                    s,
                    lambda e, j: F.struct(
                        (
                            F.coalesce(e["h"] == F.get(s, j - 1)["h"], F.lit(False))
                            | F.coalesce(e["h"] == F.get(s, j + 1)["h"], F.lit(False))
                        ).alias("t"),
                        e["i"].alias("i"),
                    ),
                ),
                lambda e: e["t"],
            ),
            lambda e: e["i"],
        ),
    )
    return _let(
        F.sort_array(twice),
        lambda p: F.aggregate(
            F.transform(p, lambda v, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - v, F.lit(WINDOW)))),
            F.lit(0),
            lambda a, b: a + b,
        ),
    )


def text_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines and
    n_repeat_words (all long).  Lines count only with a word in them."""
    t = F.coalesce(F.col(text), F.lit(""))
    metric = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    base = df.drop(*[c for c in df.columns if c in metric])
    split = base.withColumns(
        {
            "__words": words_of(F.col(text)),
            "__lines": F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD)),
        }
    )
    hashed = split.withColumn("__win", _window_hashes(F.col("__words")))
    repeats = F.size(F.array_distinct("__win")) < F.size("__win")
    return hashed.select(
        *base.columns,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(repeats, _covered(F.col("__win"))).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def default_rules() -> list[Rule]:
    c = F.col
    return [
        Rule("few_words", ("n_words",), lambda: c("n_words") < 10),
        Rule("repeats", ("n_words", "n_repeat_words"), lambda: 100 * c("n_repeat_words") > 20 * c("n_words")),
        Rule("symbols", ("n_words", "n_symbols"), lambda: 100 * c("n_symbols") > 30 * c("n_words")),
        Rule("word_length", ("n_words", "word_chars"), lambda: (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 20 * c("n_words"))),
        Rule("dup_lines", ("n_lines", "n_dup_lines"), lambda: (c("n_lines") >= 4) & (2 * c("n_dup_lines") > c("n_lines"))),
    ]


#: the rules that every document must pass before the method's verdict counts
BASE_RULES = ("few_words", "repeats")


def plan_cascade(df: DataFrame, rules: list[Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, seconds per sampled row, rejected share), best first.

    The sample is spread over all of ``df`` and holds about ``sample_rows``
    rows; each rule runs alone over it, from the raw text, so its cost includes
    the metrics it needs.  Ties keep the given order."""
    total = df.count()
    if not total:
        return [(r, 0.0, 0.0) for r in rules]
    some = stored(df.select(text).sample(False, min(1.0, sample_rows / total), 17), "cascade-sample")
    n = max(1, some.count())
    took = []
    for r in rules:
        one = text_metrics(some, text).select(F.sum(F.coalesce(r.rejects(), F.lit(False)).cast("int")).alias("n"))
        one.first()  # compiles
        t = time.perf_counter()
        bad = one.first()["n"] or 0
        took.append((r, (time.perf_counter() - t) / n, bad / n))
    return sorted(took, key=lambda x: -x[2] / max(x[1], 1e-12))


def apply_cascade(df: DataFrame, ordered: list[Rule], verdict: str = "failed_rule") -> DataFrame:
    """Adds ``verdict``: the name of the first rule, in this order, that
    rejects the row, null if none does."""
    chain = F.lit(None).cast("string")
    for r in reversed(ordered):
        chain = F.when(F.coalesce(r.rejects(), F.lit(False)), F.lit(r.name)).otherwise(chain)
    return df.withColumn(verdict, chain)


def quality(df: DataFrame, text: str = "text") -> DataFrame:
    """Metrics, ``base_failed`` and ``kept`` for every row of ``df``."""
    rules = default_rules()
    judged = text_metrics(df, text)
    base = [r for r in rules if r.name in BASE_RULES]
    order = [r for r, _, _ in plan_cascade(df, [r for r in rules if r.name not in BASE_RULES], text)]
    failed = F.lit(False)
    for r in base:
        failed = failed | F.coalesce(r.rejects(), F.lit(False))
    judged = apply_cascade(judged.withColumn("base_failed", failed), order)
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("failed_rule").isNull())
