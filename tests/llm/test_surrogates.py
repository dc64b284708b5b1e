import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import surrogates as s

KEY = b"test key"


def luhn(digits):
    return s._with_check_digit(digits) == digits


def test_formats_and_coreference():
    text = "Mail Ann.B@mail.example.com or ANN.B@Mail.Example.com; +1 (988) 555-2485, +1 988-555-2485; 4111 1111 1111 1111 and 4111111111111111; 42.144.35.254"
    new, found = s.replaced(text, KEY, {})
    assert [f.kind for f in found] == ["email", "email", "phone", "phone", "card", "card", "ip"]
    again = s.find(new)
    assert [f.kind for f in again] == [f.kind for f in found]
    assert again[0].normal == again[1].normal and again[2].normal == again[3].normal and again[4].normal == again[5].normal
    for a, b in zip(found, again):
        assert a.normal != b.normal
        assert re.sub(r"\w", "x", text[a.start : a.end]) == re.sub(r"\w", "x", new[b.start : b.end])
    assert luhn(again[4].normal) and new[again[1].start : again[1].end].startswith(new[again[0].start : again[0].end][:3].upper())
    assert all(0 <= int(o) <= 255 for o in again[6].normal.split("."))


def test_names_keep_gender_and_script():
    new, _ = s.replaced("Mrs Anna Miller met John Smith. Smith and Иван Петров left; Miller stayed.", KEY, {})
    m = re.fullmatch(r"Mrs (\w+) (\w+) met (\w+) (\w+)\. (\w+) and (\w+) (\w+) left; (\w+) stayed\.", new)
    assert m[1] in s.GIVEN["f", "latin"] and m[3] in s.GIVEN["m", "latin"] and m[6] in s.GIVEN["m", "cyrillic"]
    assert m[4] == m[5] and m[2] == m[8] and m[2] != m[4] and s.script(m[7]) == "cyrillic"
    assert (m[1], m[2], m[3], m[4]) != ("Anna", "Miller", "John", "Smith")
    given = s.GIVEN["f", "latin"]
    assert len({s.surrogate(KEY, "given", n) for n in given}) == len(given)


@pytest.mark.parametrize("text", ["(John Smith)", '"Anna Miller', "Name:John Smith", "(Mr. Brown)", "by\u00abFrau Weber\u00bb", "(Иван Петров)"])
def test_punctuated_names_are_found(text):
    found = s.find(text)
    assert found and found[-1].kind == "surname"
    assert text[found[-1].start : found[-1].end] not in s.replaced(text, KEY, {})[0]


@pytest.mark.parametrize("mention", ["ASIA" + "Q7" * 8, "ASIA" + "Q" * 16, "AKIA" + "Q" * 16])
def test_access_keys_are_found(mention):
    new, found = s.replaced(f"key {mention}.", KEY, {})
    assert [(f.kind, f.normal) for f in found] == [("awskey", mention)]
    assert mention not in new and new.startswith("key " + mention[:4])


def test_gates_let_every_match_through():
    """What the patterns match in a text of one mention, find() finds."""
    mentions = ["a@b.example", "pwd:abcdefg", "token = abcdefg", "AKIA" + "A" * 16, "ASIA" + "Z" * 16, "DE89370400440532013000", "123-45-6789", "1.2.3.4", "4111111111111111", "555-123-4567", "+4930123456"]
    for m in mentions:
        assert {k for k, _, p in s._PATTERNS if p.search(m)} >= {f.kind for f in s.find(m)} != set()
    for lead in [*s.TITLES, *(f"{t}." for t in s.TITLES), *s._NAME_OF]:
        for text in (f"{lead} Wxyz", f"({lead} Wxyz", f"x:{lead} Wxyz"):
            assert bool(s._PERSON.search(text)) == any(f.kind == "surname" for f in s.find(text)) == True  # noqa: E712


def test_another_key_gives_other_surrogates():
    assert s.replaced("a@b.example.com", KEY, {})[0] != s.replaced("a@b.example.com", b"other", {})[0]


def test_plain_text_stays():
    text = "Version 1.2.3.4.5, pi 3.14159265, on 2020-01-02 at 12:30. Anna went home. a@b"
    assert s.replaced(text, KEY, {}) == (text, [])


def test_very_long_texts_take_linear_time():
    for t in ("a" * 300_000 + "@", "1 " * 100_000, "1-" * 100_000, "+1" * 100_000, "Mr A" * 50_000):
        s.find(t)


def test_collisions_are_resolved(spark, monkeypatch):
    """Surnames drawn from very few syllables collide; none may after resolve()."""
    monkeypatch.setitem(s.SYLLABLES, "latin", ["ba", "la", "na"])
    names = [f"name{c}{d}" for c in "abcdefg" for d in "uvwxyz"] + ["bala", "nana", "banala"]
    df = spark.createDataFrame([("surname", n) for n in names], "kind string, normal string")
    monkeypatch.setattr(s, "_with_surrogates", _here(spark))
    got = s.resolve(df, KEY).collect()
    assert sorted(r.normal for r in got) == sorted(names)
    assert len({r.new for r in got}) == len(names) and not {r.new for r in got} & set(names)
    assert any(r.attempt for r in got)


def _here(spark):
    """As _with_surrogates, in the driver, where the syllables are patched."""

    def run(entities, key):
        rows = [(*r, s.surrogate(key, r.kind, r.normal, r.attempt)) for r in entities.collect()]
        return spark.createDataFrame(rows, "kind string, normal string, attempt int, new string")

    return run


def test_moved_entities_reach_their_documents(spark, monkeypatch):
    rows = [(1, "call 555-123-4567 now"), (2, "or 555-123-4567"), (3, "and 555-987-6543")]
    real = s.resolve
    monkeypatch.setattr(s, "resolve", lambda e, k: real(e, k).withColumn("attempt", F.when(F.col("normal") == "5551234567", 3).otherwise(F.col("attempt"))))
    got = {r.doc_id: r.text for r in s.surrogates(spark.createDataFrame(rows, "doc_id long, text string"), KEY).collect()}
    want = s.render("phone", "555-123-4567", s.surrogate(KEY, "phone", "5551234567", 3))
    assert got[1] == f"call {want} now" and got[2] == f"or {want}" and got[3] != rows[2][1]


@pytest.mark.parametrize("kind,norm", [("ip", "1.2.3.4"), ("secret", "abc123"), ("ssn", "123456789"), ("card", "4111111111111111"), ("iban", "DE89370400440532013000"), ("awskey", "AKIA" + "A" * 16)])
def test_later_attempts_differ(kind, norm):
    assert len({s.surrogate(KEY, kind, norm, k) for k in range(12)}) > 8


def test_edges(clashing, edge_rows, empty):
    got = s.surrogates(clashing, KEY).collect()
    assert sorted([(r.doc_id, r.text) for r in got], key=str) == sorted([(i, t) for i, t, *_ in edge_rows], key=str)
    assert all(r.n_entities == 0 and r.kept == "clash" for r in got)
    assert s.surrogates(empty, KEY).count() == 0
