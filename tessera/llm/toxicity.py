"""Toxicity by a counterfactual-regularised classifier.

A logistic model over the words of a text, their prefixes and their character
n-grams (present or not).  It is fitted on a bounded sample of labelled rows:
features that occur in toxic rows clearly more often than in others are kept, and
their weights, none below 0, minimise the log loss plus ``PENALTY`` times the squared score
change over counterfactual pairs: labelled texts whose identity terms are swapped
for others of the same kind, and labelled texts with a term put in front and then
swapped.  So a term for a group moves the score no more than "people" does.

Defined results: a null or empty text, and every row if there is nothing to learn
from, gets the score of a text without features; repeated rows give equal rows;
labels that are null are not used; an empty table gives an empty result; other
columns are carried through, and input columns named like a result are replaced.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import drop_stored, pieces, ready, stored

#: bound of the training sample: rows a label, and bytes a text
SAMPLE_ROWS, SAMPLE_BYTES = 1_200, 20_000
MAX_FEATURES = 1_000
#: weight of the squared score changes, and of the squared weights
PENALTY, RIDGE = 1.0, 1e-4
THRESHOLD = 0.7
STEPS = 500
#: powers of the label odds tried by cross-validation, folds, and the share of
#: false positives allowed there
POWERS, FOLDS, FALSE_POSITIVES = tuple(k / 8 for k in range(2, 9)), 3, 0.01
#: log-likelihood ratio from which a feature is kept
SIGNIFICANT = 20.0
#: words in a worker's cache at most
CACHE_WORDS = 200_000
#: terms that name groups neutrally, by kind; "people" stands for no group
IDENTITY = (
    ("women", "men", "girls", "boys", "people"),
    ("woman", "man", "girl", "boy", "person"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "religious"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "people"),
    ("black", "white", "asian", "latino", "arab", "african", "european", "local"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "married"),
    ("immigrants", "refugees", "natives", "foreigners", "people"),
    ("disabled", "blind", "deaf", "old", "young", "healthy"),
    # German
    ("frauen", "männer", "mädchen", "jungen", "menschen"),
    ("frau", "mann", "mensch"),
    ("christlich", "muslimisch", "jüdisch", "hinduistisch", "buddhistisch", "atheistisch", "religiös"),
    ("christen", "muslime", "juden", "hinduisten", "buddhisten", "atheisten", "leute"),
    ("schwarze", "weiße", "asiatische", "arabische", "afrikanische", "europäische", "örtliche"),
    ("schwule", "heterosexuelle", "lesbische", "bisexuelle", "transsexuelle", "verheiratete"),
    ("einwanderer", "flüchtlinge", "einheimische", "ausländer", "leute"),
    ("behinderte", "blinde", "taube", "alte", "junge", "gesunde"),
    # French
    ("femmes", "hommes", "filles", "garçons", "gens"),
    ("femme", "homme", "fille", "garçon", "personne"),
    ("chrétien", "musulman", "juif", "hindou", "bouddhiste", "athée", "religieux"),
    ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées", "gens"),
    ("noirs", "blancs", "asiatiques", "arabes", "africains", "européens", "locaux"),
    ("homosexuels", "hétérosexuels", "lesbiennes", "bisexuels", "transgenres", "mariés"),
    ("immigrés", "réfugiés", "autochtones", "étrangers", "gens"),
    ("handicapés", "aveugles", "sourds", "vieux", "jeunes"),
    # Spanish
    ("mujeres", "hombres", "niñas", "niños", "gente"),
    ("mujer", "hombre", "niña", "niño", "persona"),
    ("cristiano", "musulmán", "judío", "hindú", "budista", "ateo", "religioso"),
    ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos", "gente"),
    ("negros", "blancos", "asiáticos", "latinos", "árabes", "africanos", "europeos"),
    ("homosexuales", "heterosexuales", "lesbianas", "bisexuales", "transexuales", "casados"),
    ("inmigrantes", "refugiados", "nativos", "extranjeros", "gente"),
    ("discapacitados", "ciegos", "sordos", "viejos", "jóvenes"),
)
_SWAP = {t: kind[(i + 1) % len(kind)] for kind in IDENTITY for i, t in reversed(list(enumerate(kind)))}
_TERM = re.compile(r"\b(" + "|".join(sorted(_SWAP, key=len, reverse=True)) + r")\b", re.IGNORECASE)
_EDGE = string.punctuation + "\u00a1\u00ab\u00bb\u00bf\u2013\u2014\u2018\u2019\u201c\u201d\u201e\u2026"
_SHORTEST = 4
_HASHES = 1 << 20


def word_features(token: str, roots: frozenset[str] | None = None) -> tuple[str, ...]:
    """The features of a token between white space; none of its n-grams if
    ``roots`` is given and holds no shortest one of them."""
    w = token.lower().strip(_EDGE)
    if len(w) < 2:
        return ()
    marked = f"^{w}$"
    short = [marked[i : i + _SHORTEST] for i in range(len(marked) - _SHORTEST + 1)]
    if roots is not None and roots.isdisjoint(short):
        return (f"={w}",)
    grams = [marked[i : i + n] for n in (5, 6) for i in range(len(marked) - n + 1)]
    return (f"={w}", *short, *grams)


def swapped(text: str) -> str | None:
    """The text with every identity term swapped, None without one."""
    out, n = _TERM.subn(lambda m: _SWAP[m[0].lower()], text)
    return out if n else None


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -3.0

    def scorer(self):
        """Texts -> scores, with a bounded cache of words' known features."""
        cache: dict[str, tuple[str, ...]] = {}
        known = self.weights
        roots = frozenset(f[:_SHORTEST] for f in known if f[0] != "=")

        def score(texts: list[str | None]) -> list[float]:
            if len(cache) > CACHE_WORDS:
                cache.clear()
            z = []
            for t in texts:
                words = set(t.split()) if t else set()
                for w in words.difference(cache):
                    cache[w] = tuple([f for f in word_features(w, roots) if f in known])
                found = {f for w in words for f in cache[w]}
                z.append(self.bias + sum([known[f] for f in sorted(found)]))
            return (1 / (1 + np.exp(-np.clip(z, -50, 50)))).tolist()

        return score


def _ratio(c, o, n1: int, n0: int):
    """Log-likelihood ratio of the shares c / n1 and o / n0 against one share,
    0 unless the first is clearly larger."""
    c, o = np.asarray(c, float), np.asarray(o, float)
    share = np.clip((c + o) / (n1 + n0), 1e-12, 1 - 1e-12)
    g = np.zeros_like(c)
    for k, n, p in ((c, n1, share), (o, n0, share), (n1 - c, n1, 1 - share), (n0 - o, n0, 1 - share)):
        g += 2 * k * np.log(np.maximum(k, 1e-12) / (n * p))
    return np.where(c * n0 > 4 * o * n1, g, 0)


def choose_features(texts: list[str], toxic: np.ndarray) -> list[str]:
    """Features whose share among toxic texts is clearly larger.  They are first
    counted by hash, and by name only where a hash is promising, so that memory
    holds no n-gram table."""
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    words = [sorted(set(t.split())) for t in texts]
    codes: dict[str, np.ndarray] = {}
    counts = np.zeros((2, _HASHES), np.int32)
    for own, y in zip(words, toxic):
        for w in own:
            if w not in codes:
                codes[w] = np.array([zlib.crc32(f.encode()) % _HASHES for f in word_features(w)], np.int32)
        if own:
            counts[int(y), np.unique(np.concatenate([codes[w] for w in own]))] += 1
    good = _ratio(counts[1], counts[0], n1, n0) > SIGNIFICANT
    names = {w: tuple(f for f, k in zip(word_features(w), c) if good[k]) for w, c in codes.items() if good[c].any()}
    del codes
    inside, outside = Counter(), Counter()
    for own, y in zip(words, toxic):
        (inside if y else outside).update({f for w in own for f in names.get(w, ())})
    found = [(-float(g), f) for f in inside if (g := _ratio(inside[f], outside[f], n1, n0)) > SIGNIFICANT]
    return [f for _, f in sorted(found)[:MAX_FEATURES]]


def choose_power(texts: list[str], toxic: list[int], penalty: float = PENALTY, rate: float | None = None) -> float:
    """The power of the label odds that finds most toxic texts from THRESHOLD on
    with at most FALSE_POSITIVES of the others, over FOLDS folds by a hash of the
    text; the power of fewest false positives if none keeps to that.  The share of
    false positives counts with one standard error added, as the best of several
    shares looks better than it is."""
    y = np.array(toxic, bool)
    fold = np.array([zlib.crc32(t.encode()) // 7 % FOLDS for t in texts], np.int64)
    hits = np.zeros((len(POWERS), len(texts)), bool)
    for k in range(FOLDS):
        inside, at = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        models = _models([texts[i] for i in inside], y[inside], penalty, rate, POWERS)
        for row, m in zip(hits, models):
            row[at] = np.array(m.scorer()([texts[i] for i in at])) >= THRESHOLD
    found = (hits & y).sum(1) / max(1, y.sum())
    wrong = (hits & ~y).sum(1) / max(1, (~y).sum())
    fine = wrong + np.sqrt(wrong * (1 - wrong) / max(1, (~y).sum())) <= FALSE_POSITIVES
    best = max(range(len(POWERS)), key=lambda i: (fine[i], found[i] if fine[i] else -wrong[i], -wrong[i], POWERS[i]))
    return POWERS[best]


def train(texts: list[str], toxic: list[int], penalty: float = PENALTY, rate: float | None = None) -> Model:
    """rate: the share of toxic rows among all labelled rows, if the sample's
    is another."""
    y = np.array(toxic, bool)
    if not y.any() or y.all():
        return Model()
    return _models(texts, y, penalty, rate, (choose_power(texts, toxic, penalty, rate),))[0]


def _models(texts: list[str], y: np.ndarray, penalty: float, rate: float | None, powers: tuple[float, ...]) -> list[Model]:
    """The model of each power of the label odds."""
    if not y.any() or y.all():
        return [Model() for _ in powers]
    names = choose_features(texts, y)
    if not names:
        return [Model() for _ in powers]
    at = {f: i for i, f in enumerate(names)}
    roots = frozenset(f[:_SHORTEST] for f in names if f[0] != "=")

    columns: dict[str, list[int]] = {}

    def matrix(rows: list[str]) -> np.ndarray:
        x = np.zeros((len(rows), len(names)), np.float32)
        for i, t in enumerate(rows):
            own = set(t.split())
            for w in own.difference(columns):
                columns[w] = [at[f] for f in word_features(w, roots) if f in at]
            x[i, [k for w in own for k in columns[w]]] = 1
        return x

    x = matrix(texts)
    pairs = [(t, s) for t in texts if (s := swapped(t))]
    terms = sorted(_SWAP)
    for i, t in enumerate(texts[: len(terms) * 4]):
        pairs.append((f"{terms[i % len(terms)]} {t}", f"{_SWAP[terms[i % len(terms)]]} {t}"))
    d = matrix([a for a, _ in pairs]) - matrix([b for _, b in pairs])
    d = d[np.abs(d).any(1)]
    return [_descend(names, x, d, y, penalty, max(rate or y.mean(), 1e-6), p) for p in powers]


def _descend(names: list[str], x: np.ndarray, d: np.ndarray, y: np.ndarray, penalty: float, rate: float, power: float) -> Model:
    """Accelerated gradient steps.  The labels weigh between alike (power 0) and
    as they occur (power 1)."""
    odds = (rate / max(1 - rate, 1e-6)) ** power
    rate = odds / (1 + odds)
    share = np.where(y, rate / y.sum(), (1 - rate) / (~y).sum()).astype(np.float32)
    w, b = np.zeros(len(names), np.float32), 0.0
    step = 4 / (1 + (x**2).sum(1).max() + 8 * penalty * ((d**2).sum(1).max() if len(d) else 0))
    vw, vb, pw, pb = w.copy(), b, w.copy(), b
    for k in range(STEPS):
        g = share * (1 / (1 + np.exp(-np.clip(x @ vw + vb, -30, 30))) - y)
        gw = x.T @ g + RIDGE * vw
        if len(d):
            gw += penalty * 2 * (d.T @ (d @ vw)) / len(d)
        w, b = np.maximum(vw - step * gw, 0), vb - step * float(g.sum())
        momentum = k / (k + 3)
        vw, vb, pw, pb = w + momentum * (w - pw), b + momentum * (b - pb), w, b
    return Model({f: float(v) for f, v in zip(names, w) if abs(v) > 1e-4}, b)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", key: str = "doc_id") -> Model:
    """The model of about SAMPLE_ROWS rows of either label, spread over all rows
    of ``docs`` that ``labels`` marks by a hash of the text.  The rows are drawn by
    hash and length; only the drawn ones' texts are fetched."""
    print_ = F.xxhash64(F.lit(7), F.col(text))
    size = F.octet_length(text)
    marked = docs.where((size <= SAMPLE_BYTES) & (size > 0)).select(key, print_.alias("__print"))
    usable = marked.join(labels.where(F.col(label).isin(0, 1)).select(key, label), key)
    usable = stored(usable, "toxic-labelled")
    counts = {r[0]: r[1] for r in usable.groupBy(label).count().collect()}
    if len(counts) < 2:
        return Model()
    draw = F.pmod(F.col("__print"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col(label) == 1, min(1.0, SAMPLE_ROWS / counts[1])).otherwise(min(1.0, SAMPLE_ROWS / counts[0]))
    # bounded: equal texts share a draw and count once
    drawn = stored(usable.where(draw < share).dropDuplicates(["__print"]).limit(4 * SAMPLE_ROWS), "toxic-drawn")
    texts = docs.select(key, text, print_.alias("__print")).join(F.broadcast(drawn), [key, "__print"])
    some = texts.select(text, label).dropDuplicates([text]).collect()
    drop_stored(usable, drawn)
    some.sort()
    return train([r[0] for r in some], [r[1] for r in some], rate=counts[1] / (counts[0] + counts[1]))


def classify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds score (0 to 1) and predicted (1 from THRESHOLD on)."""
    spark = ready(df.sparkSession)
    df = df.drop("score", "predicted")
    shared = spark.sparkContext.broadcast(model)  # size: MAX_FEATURES
    at = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for b in pieces(batches, text, 2 << 20):
            s = score(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64()), pa.array([int(v >= THRESHOLD) for v in s], pa.int32())], names=schema.names)

    return df.mapInArrow(run, schema)
