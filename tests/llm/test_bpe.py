import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "<|endoftext|>hi<|startoftext|> x", "Σίσυφος ΟΔΟΣ İstanbul", "aaaaaaaaaaaaa bbbb aaaa", "it's we'll I'd 12345 ²½ Ⅷ",
    "é ́a \x1cabc\x1d", "日本語テキスト 한국어 🙂🙂 👩‍👩‍👧", "a\xa0b　c\x85d​d", "don't!!! ??? ...'s 's't", "x" * 3000,
    "KÅ Å ﬁ ẞ ŉ ǰ", "<|ENDOFTEXT|> <|endoftext|", "﻿hi\x00\x01 ᠎ z", "नमस्ते दुनिया", "Hello\r\n\tWorld  ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_round_trip_matches_the_library(spark, edges, library):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string").unionByName(edges.select("doc_id", "text"))
    coded = bpe.decode(bpe.encode(df, PATH).withColumnRenamed("text", "original"), PATH)
    for r in coded.collect():
        want = library.encode(r.original or "", add_special_tokens=False).ids
        assert list(r.ids) == want
        assert r.text == library.decode(want, skip_special_tokens=False)


def test_digests(spark, clashing, library):
    got = bpe.encode_decode_digests(clashing.withColumnRenamed("size", "n_tokens"), PATH).collect()
    for r in got:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.kept == "clash"
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_documents(spark, library):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for r in bpe.encode_decode_digests(rows, PATH).collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_the_cache_is_bounded(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 5)
    enc = bpe.Encoder(bpe.Vocabulary(PATH))
    for t in ["one two three four", "five six seven one", "one eight", "two five nine ten eleven"] * 3:
        got = [int(i) for c in enc.chunks([t])[0] for i in enc.cache[c][1].split()]
        assert got == library.encode(t, add_special_tokens=False).ids
        assert len(enc.cache) + len(enc.old) <= 24


def test_empty(empty):
    assert bpe.encode(empty, PATH).count() == 0 and bpe.encode_decode_digests(empty, PATH).count() == 0


def test_decode_odd_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [-1, 0, None, 10**6])], "doc_id long, ids array<int>")
    assert [r.text for r in bpe.decode(df, PATH).orderBy("doc_id").collect()] == ["", "", "!"]
