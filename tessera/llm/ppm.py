"""Language ID by prediction by partial matching.

Each language has a context tree over bytes of order 0 to ``ORDER``, counted on
a bounded sample of labelled texts and then frozen.  A byte costs, in the
longest context that the tree has, -log2(count / (total + distinct)) if it was
seen there, else the escape -log2(distinct / (total + distinct)) plus its cost
in the next shorter context; below order 0 every byte costs 8 bits.  The code
length of a text is the sum over all its bytes, and the language with the
shortest one is predicted.

Because the statistics are frozen, the costs of all languages are resolved once
into one row per context node, and scoring is two table look-ups per byte.

Defined results: a null text or one without letters is ``und`` with score 0;
ties go to the language that comes first by code point; repeated rows give equal
rows; an empty table gives an empty result; with nothing to learn from, every
row is ``und``; other columns are carried through, and input columns named like
a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import pieces, ready

ORDER = 3
#: bound of the training sample: documents a language, and bytes a document
TRAIN_DOCS, TRAIN_BYTES = 300, 20_000
#: languages at most, and bound of the resolved table (float32 cells)
MAX_LANGUAGES, MAX_CELLS = 256, 16_000_000
UND = "und"
_LETTER = regex.compile(r"\p{L}")
#: bytes scored at once with up to four languages, fewer with more: the working
#: arrays hold about 24 bytes a byte and 12 a byte and language
_BLOCK = 1 << 17
_PAD = b"\n" * ORDER  # what comes before a text


@dataclass(frozen=True)
class Model:
    """``symbol``: byte -> symbol (0: never seen); ``node``: row of the deepest
    node, by the ORDER symbols before; ``cost``: bits[row * symbols + symbol,
    language]."""

    languages: list[str]
    symbol: np.ndarray
    node: np.ndarray
    cost: np.ndarray
    symbols: int

    def block(self) -> int:
        return max(1, _BLOCK * 4 // max(4, len(self.languages)))

    def bits(self, raw: bytes) -> np.ndarray:
        """Code length of one text in every language."""
        flat = np.frombuffer(_PAD + raw, np.uint8)
        total = np.zeros(len(self.languages))
        block = self.block()
        for lo in range(ORDER, len(flat), block):
            hi = min(lo + block, len(flat))
            total += self._costs(flat[lo - ORDER : hi]).sum(0, dtype=np.float64)
        return total

    def _costs(self, flat: np.ndarray) -> np.ndarray:
        """Cost rows of flat[ORDER:]."""
        s = self.symbol[flat]
        n = len(s) - ORDER
        context = s[:n].copy()
        for k in range(1, ORDER):
            context *= self.symbols
            context += s[k : n + k]
        cell = self.node[context]
        cell *= self.symbols
        cell += s[ORDER:]
        return self.cost.take(cell, axis=0)

    def bits_of_many(self, texts: list[bytes]) -> np.ndarray:
        """Code lengths, a row for each text."""
        out, block = np.zeros((len(texts), len(self.languages))), self.block()
        some: list[int] = []  # texts that are scored together
        size = 0
        for i, t in enumerate(texts):
            if len(t) > block:
                out[i] = self.bits(t)
            elif t:
                if size + len(t) > block:
                    out[some] = self._bits_together([texts[k] for k in some])
                    some, size = [], 0
                some.append(i)
                size += len(t) + ORDER
        if some:
            out[some] = self._bits_together([texts[k] for k in some])
        return out

    def _bits_together(self, texts: list[bytes]) -> np.ndarray:
        flat = np.frombuffer(_PAD + _PAD.join(texts), np.uint8)
        size = np.array([len(t) for t in texts])
        start = np.r_[0, np.cumsum(size[:-1] + ORDER)]
        cost = self._costs(flat)
        cut = np.stack([start, start + size], 1).ravel()
        # the last end lies one past the rows
        return np.add.reduceat(np.vstack([cost, np.zeros_like(cost[:1])]), cut, axis=0, dtype=np.float64)[::2]


def train(samples: dict[str, list[bytes]], max_cells: int = MAX_CELLS) -> Model:
    """The frozen model of sampled texts by language."""
    languages = sorted(samples)
    flats = [np.frombuffer(b"".join(_PAD + t for t in samples[k]), np.uint8) for k in languages]
    # text bytes only: what is predicted never lies in the padding
    inside = [np.concatenate([np.r_[np.zeros(ORDER, bool), np.ones(len(t), bool)] for t in samples[k]] or [np.zeros(0, bool)]) for k in languages]
    seen = np.unique(np.concatenate([*flats, np.frombuffer(_PAD, np.uint8)]))
    symbol = np.zeros(256, np.int64)
    symbol[seen] = np.arange(1, len(seen) + 1)
    a, n_lang = len(seen) + 1, len(languages)
    # node[] of the contexts of order d; cost[] of all rows so far
    node = np.zeros(1, np.int64)
    cost = np.full((1, a, n_lang), 8.0)
    made = 0
    for d in range(ORDER + 1):
        grams = []
        for flat, ok in zip(flats, inside):
            s = symbol[flat]
            at = np.flatnonzero(ok)
            g = np.zeros(len(at), np.int64)
            for k in range(d, -1, -1):
                g = g * a + s[at - k]
            grams.append(np.unique(g, return_counts=True))
        contexts, total = _totals(grams, a)
        room = max_cells // (a * n_lang) - made
        if d and len(contexts) > room:  # the most frequent contexts become nodes
            kept = np.sort(np.argsort(-total, kind="stable")[: max(room, 0)])
            contexts = contexts[kept]
        # parents: the rows of order d - 1 of the same context without its first symbol
        parent = node[contexts % max(1, a ** (d - 1))] if d else np.zeros(len(contexts), np.int64)
        base = cost[parent] if d else np.repeat(cost, len(contexts), 0)
        new = base.copy()
        for lang, (g, count) in enumerate(grams):
            ctx, sym = g // a, g % a
            at = np.searchsorted(contexts, ctx)
            ok = (at < len(contexts)) & (contexts[np.minimum(at, max(len(contexts) - 1, 0))] == ctx) if len(contexts) else np.zeros(len(ctx), bool)
            at, sym, count = at[ok], sym[ok], count[ok]
            sums = np.bincount(at, count, len(contexts))
            kinds = np.bincount(at, minlength=len(contexts))
            has = kinds > 0
            new[has, :, lang] += -np.log2(kinds[has] / (sums[has] + kinds[has]))[:, None]
            new[at, sym, lang] = -np.log2(count / (sums[at] + kinds[at]))
        if d == 0:
            cost, node, made = new, np.zeros(1, np.int64), 1
        else:
            wider = np.tile(node, a)  # a longer context falls back to the shorter one's row
            wider[contexts] = made + np.arange(len(contexts))
            cost, node, made = np.concatenate([cost, new]), wider, made + len(contexts)
    return Model(languages, symbol, node, cost.reshape(-1, n_lang).astype(np.float32), a)


def _totals(grams: list, a: int) -> tuple[np.ndarray, np.ndarray]:
    ctx = np.concatenate([g // a for g, _ in grams]) if grams else np.zeros(0, np.int64)
    n = np.concatenate([c for _, c in grams]) if grams else np.zeros(0, np.int64)
    contexts, at = np.unique(ctx, return_inverse=True)
    return contexts, np.bincount(at, n, len(contexts)) if len(contexts) else np.zeros(0)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in the held-out fold (a null id
    counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


def sample_texts(labelled: DataFrame, label: str, text: str, docs: int = TRAIN_DOCS, size: int = TRAIN_BYTES) -> dict[str, list[bytes]]:
    """About ``docs`` whole texts of up to ``size`` bytes for each label,
    spread over all rows by a hash of the text; at most 2 * docs each."""
    usable = labelled.where(F.col(label).isNotNull() & (F.octet_length(text) <= size) & (F.octet_length(text) > 0))
    counts = {r[0]: r[1] for r in usable.groupBy(label).count().orderBy(F.desc("count"), label).limit(MAX_LANGUAGES).collect()}
    if not counts:
        return {}
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, docs / n)))])
    draw = F.pmod(F.xxhash64(F.lit(8), F.col(text)), F.lit(1 << 30)) / float(1 << 30)
    some = usable.where(draw < share[F.col(label)]).select(label, text)
    out: dict[str, list[bytes]] = {k: [] for k in counts}
    # bounded: about docs * size bytes a label; equal texts share a draw, so limit
    for k, t in some.dropDuplicates([label, text]).limit(2 * docs * len(counts)).collect():
        out[k].append(t.encode())
    return {k: sorted(v) for k, v in out.items() if v}


def identify(df: DataFrame, model: Model | None, text: str = "text", *, keep_text: bool = True) -> DataFrame:
    """Adds lang_pred and score (the share of the best language if all are
    equally likely beforehand); without ``keep_text`` the texts don't come back."""
    spark = ready(df.sparkSession)
    df = df.drop("lang_pred", "score")
    shared = spark.sparkContext.broadcast(model)  # size: MAX_CELLS and symbols ** ORDER
    at = df.columns.index(text)
    kept = [i for i in range(len(df.columns)) if keep_text or i != at]
    schema = T.StructType([*(df.schema.fields[i] for i in kept), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in pieces(batches, text, 1 << 20):
            texts = b.column(at).to_pylist()
            pred, score = [UND] * len(texts), np.zeros(len(texts))
            some = [i for i, t in enumerate(texts) if t and m is not None and _LETTER.search(t)]
            if some:
                bits = m.bits_of_many([texts[i].encode() for i in some])
                best = bits.argmin(1)
                more = np.minimum(bits - bits.min(1)[:, None], 1000)
                score[some] = 1 / np.exp2(-more).sum(1)
                for i, k in zip(some, best.tolist()):
                    pred[i] = m.languages[k]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), pa.array(pred), pa.array(score)], names=schema.names)

    return df.mapInArrow(run, schema)


def fit(labelled: DataFrame, label: str = "lang", text: str = "text") -> Model | None:
    """The model of a bounded sample of the labelled rows."""
    samples = sample_texts(labelled, label, text)
    return train(samples) if samples else None
