"""BPE encoding and decoding by batched numpy merge rounds.

The symbols of many words lie in one flat array.  A round looks up all
neighbouring pairs by binary search over the sorted pair keys of the
vocabulary, takes the lowest rank of each word and merges its occurrences from
left to right; words without a known pair are done and leave the array.  Words
are encoded once per worker and then kept in a bounded cache.

The text rules are those of the word-level vocabulary file: special tokens are
cut out first, then NFC, white space collapsed, lower case per character,
pieces by the file's pattern, bytes as printable characters, and a word-end
mark on the last symbol.  White space never lies in a piece, so every chunk
between white space is encoded on its own.  The file has no decoder: decoding
joins the tokens with one space.

Defined results: a null text is an empty one and gives no ids; an empty id list
decodes to an empty text; repeated rows give equal rows; an empty table gives an
empty result; other columns are carried through, and input columns named like a
result are replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import ready

#: chunks in a worker's cache at most; it starts anew beyond that
CACHE_CHUNKS = 200_000
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPLIT = re.compile(f"[{WHITE}]+")
_ODD = re.compile("[\x1c-\x1f]")  # white space to str.split(), not to the pattern
_NO_RANK = np.iinfo(np.int64).max


def printable_bytes() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies:
    printable bytes stand for themselves, the rest follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    at = {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}
    return [chr(at[b]) for b in range(256)]


class Vocabulary:
    """A word-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = split.replace("\\s", WHITE)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        chars = printable_bytes()
        self.byte_id = np.array([vocab[c] for c in chars], np.int64)
        self.last_byte_id = np.array([vocab[c + end] for c in chars], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.size = len(self.tokens)
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order, made[order]


def merge_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all (non-empty) words one after another, and where each
    word's ids end."""
    sizes = np.array([len(w) for w in words], np.int64)
    raw = np.frombuffer(b"".join(words), np.uint8)
    sym = v.byte_id[raw]
    ends = np.cumsum(sizes)
    sym[ends - 1] = v.last_byte_id[raw[ends - 1]]
    word = np.repeat(np.arange(len(words)), sizes)
    done_sym, done_word = [], []
    while len(sym):
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        rank = np.full(len(sym), _NO_RANK)  # of the pair that begins here
        inner = np.flatnonzero(word[1:] == word[:-1])
        key = sym[inner] * v.size + sym[inner + 1]
        at = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
        known = v.keys[at] == key
        rank[inner[known]] = v.rank[at[known]]
        made = np.zeros(len(sym), np.int64)
        made[inner[known]] = v.made[at[known]]
        lowest = np.minimum.reduceat(rank, starts)
        lengths = np.diff(np.r_[starts, len(sym)])
        low = np.repeat(lowest, lengths)
        over = low == _NO_RANK
        if over.any():
            done_sym.append(sym[over])
            done_word.append(word[over])
        take = (rank == low) & ~over
        # a run of takes is one symbol repeated: every second one merges
        pos = np.flatnonzero(take)
        if len(pos):
            first = np.r_[True, np.diff(pos) != 1]
            run = np.maximum.accumulate(np.where(first, np.arange(len(pos)), 0))
            pos = pos[(np.arange(len(pos)) - run) % 2 == 0]
            sym[pos] = made[pos]
        keep = ~over
        keep[pos + 1] = False
        sym, word = sym[keep], word[keep]
    sym, word = np.concatenate(done_sym), np.concatenate(done_word)
    order = np.argsort(word, kind="stable")
    return sym[order], np.cumsum(np.bincount(word, minlength=len(words)))


class Encoder:
    """Encodes texts, with a bounded cache of chunks between white space:
    chunk -> (number of ids, decimal ids joined, decoded tokens joined).  A full
    cache becomes the old one; what is seen again moves to the new one."""

    def __init__(self, v: Vocabulary):
        self.v, self.cache, self.old = v, {}, {}
        self.id_text = [str(i) for i in range(v.size)]
        self.find = regex.compile(v.pattern).findall
        self.cut = re.compile("(" + "|".join(map(re.escape, v.special)) + ")").split if v.special else lambda x: [x]

    def pieces(self, chunk: str) -> list[str | int]:
        """The chunk's words; a special token as its id."""
        if chunk.isalpha() and chunk.isascii():
            return [chunk.lower()]
        out: list[str | int] = []
        for part in self.cut(chunk) if any(x in chunk for x in self.v.special) else [chunk]:
            if part in self.v.special:
                out.append(self.v.special[part])
            elif part:
                # per character: no final sigma
                out += self.find(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return out

    def learn(self, chunks: set[str]) -> None:
        cut = {c: self.pieces(c) for c in chunks}
        words = list({w for p in cut.values() for w in p if isinstance(w, str)})
        own = {i: (1, self.id_text[i], self.v.tokens[i]) for i in self.v.special.values()}
        if words:
            flat, ends = merge_words([w.encode("utf-8", "surrogatepass") for w in words], self.v)
            ids = [self.id_text[i] for i in flat.tolist()]
            tokens = [self.v.tokens[i] for i in flat.tolist()]
            start = 0
            for w, end in zip(words, ends.tolist()):
                own[w] = (end - start, " ".join(ids[start:end]), " ".join(tokens[start:end]))
                start = end
        for c, p in cut.items():
            if len(p) == 1:
                self.cache[c] = own[p[0]]
            else:
                got = [own[w] for w in p]
                self.cache[c] = (sum([g[0] for g in got]), " ".join([g[1] for g in got]), " ".join([g[2] for g in got]))

    def chunks(self, texts: list[str]) -> list[list[str]]:
        """The texts' chunks; all are in the cache afterwards."""
        cut = [t.split() if not _ODD.search(t) else [c for c in _SPLIT.split(t) if c] for t in texts]
        if len(self.cache) > CACHE_CHUNKS:
            self.cache, self.old = {}, self.cache
        new = set().union(*cut).difference(self.cache)
        if seen := new.intersection(self.old):
            self.cache.update({c: self.old[c] for c in seen})
            new -= seen
        if new:
            self.learn(new)
        return cut


def _groups(texts: list[str | None], limit: int = 2 << 20) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t or "")
        size += len(t or "")
        if size > limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def _mapped(df: DataFrame, path: str, text: str, fields: list[T.StructField], row) -> DataFrame:
    """``df`` with ``row(encoder, chunks) -> values of fields`` added."""
    spark = ready(df.sparkSession)
    names = [f.name for f in fields]
    df = df.drop(*[c for c in df.columns if c in names and c != text])
    shared = spark.sparkContext.broadcast(Vocabulary(path))  # size: the vocabulary file's
    out_schema = T.StructType([*[f for f in df.schema.fields if f.name not in names], *fields])
    kinds = [pa.int64() if isinstance(f.dataType, T.LongType) else pa.list_(pa.int32()) if isinstance(f.dataType, T.ArrayType) else pa.string() for f in fields]
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(shared.value)
        for b in batches:
            rows = [row(enc, c) for g in _groups(b.column(at).to_pylist()) for c in enc.chunks(g)]
            cols = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            carried = [(n, b.column(i)) for i, n in enumerate(b.schema.names) if n not in names]
            yield pa.RecordBatch.from_arrays([c for _, c in carried] + cols, names=[n for n, _ in carried] + names)

    return df.mapInArrow(run, out_schema)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the token ids of every whole text."""

    def row(enc, chunks):
        return ([int(i) for c in chunks for i in enc.cache[c][1].split()],)

    return _mapped(df, path, text, [T.StructField(ids, T.ArrayType(T.IntegerType()))], row)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Adds the decoded text of every id list (null: empty); ids that are not
    in the vocabulary are left out."""
    spark = ready(df.sparkSession)
    tokens = spark.sparkContext.broadcast(Vocabulary(path).tokens)
    df = df.drop(*[c for c in df.columns if c == text])
    at = df.columns.index(ids)

    def run(batches):
        tok = tokens.value
        for b in batches:
            out = [" ".join([tok[i] for i in r or [] if i is not None and 0 <= i < len(tok) and tok[i]]) for r in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, text])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(text, T.StringType())]))


def encode_decode_digests(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Encodes and decodes every whole text and adds n_tokens, ids_sha256 (of
    the decimal ids joined by one space) and decoded_sha256."""

    def sha(parts: list[str]) -> str:
        return hashlib.sha256(" ".join(parts).encode("utf-8", "surrogatepass")).hexdigest()

    def row(enc, chunks):
        got = [x for c in chunks if (x := enc.cache[c])[0]]
        return sum([x[0] for x in got]), sha([x[1] for x in got]), sha([x[2] for x in got])

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return _mapped(df, path, text, fields, row)

