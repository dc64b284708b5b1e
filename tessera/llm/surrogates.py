"""PII surrogates: detected entities get keyed, type-consistent replacements.

An entity is (type, normal form): an e-mail address in lower case, the digits of a
phone or card number, a surname.  Its surrogate comes from HMAC-SHA256 under the
caller's key: letters become letters of the same script, digits digits; prefixes
that carry the type stay (the sign and country digit of a phone number, the first
card digit and a valid check digit, the top-level domain, octets in range).  A
given name becomes another of the same gender and script by a keyed permutation of
its list, a surname is built from syllables of its script.  A mention is rendered
in its own format, so the same number written in two ways, or the same address in
two cases, stays the same entity.

Collisions: surrogates of all distinct entities are compared with each other and
with all originals of their type; all but one of a group, and those that equal an
original, take their next surrogate, until none collides.  The few that moved reach
their documents by a join, all others are computed in place.

Defined results: a null text stays null and an empty one empty, with no entities;
overlapping finds go to the earlier, then to the longer; repeated rows give equal
rows; rows of equal id share their moved entities; an empty table gives an empty
result; other columns are carried through, and input columns named like a result
are replaced.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import pieces, ready, stored, union_all

MAX_ATTEMPTS = 64
#: from this attempt on, kinds with few values of a format leave it
WIDE = 8
#: given names by (gender, script)
GIVEN = {
    ("f", "latin"): "Anna Maria Emma Julia Laura Sophie Claire Elena Carmen Lucia Sarah Emily Katharina Isabel Camille Margaret".split(),
    ("m", "latin"): "John Peter Thomas Michael Paul Carlos Pierre Hans David Daniel James Robert Stefan Miguel Antoine William".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана".split(),
    ("m", "cyrillic"): "Иван Пётр Сергей Дмитрий Алексей Андрей Николай Владимир".split(),
}
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Señor Señora Господин Госпожа".split()
SYLLABLES = {
    "latin": "ba ber dan del far gel har kan kel lan lor mar mel nor pel ran rus sal ten ver".split(),
    "cyrillic": "ба бер ван гор дан ков лан мар нев ров сал тов".split(),
    "greek": "βα γα δελ καν λορ μαρ νικ παν ρουσ σαλ τεν".split(),
}
_ALPHABET = {"latin": string.ascii_lowercase, "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
_NAME_OF = {n: (k, i) for k, names in GIVEN.items() for i, n in enumerate(names)}
#: every match of _PERSON starts with one of these
_LEAD = re.compile(rf"(?:{'|'.join([*TITLES, *_NAME_OF])})[. ]")
_CAP = r"[A-ZÀ-ÖØ-ÞΑ-ΩА-ЯЁ][^\W\d_]+(?:-[A-ZÀ-ÖØ-ÞΑ-ΩА-ЯЁ][^\W\d_]+)?"
_PERSON = re.compile(
    rf"\b(?:(?:{'|'.join(TITLES)})\.? (?:(?P<g1>{'|'.join(_NAME_OF)}) )?(?P<s1>{_CAP})|(?P<g2>{'|'.join(_NAME_OF)}) (?P<s2>{_CAP}))"
)
#: type, strings of which every match holds one, pattern; the entity is group v or all
_PATTERNS = (
    ("email", ("@",), re.compile(r"(?<![\w.%+-])[\w.%+-]++@[\w-]++(?:\.[\w-]++)+")),
    ("secret", ("=", ":"), re.compile(r"(?i)\b(?:password|passwd|pwd|token|secret|api[_-]?key)\b\s{0,3}[=:]\s{0,3}[\"']?(?P<v>[^\s\"']{6,})")),
    ("awskey", ("KIA", "SIA"), re.compile(r"\bA[KS]IA[A-Z0-9]{16}\b")),
    ("iban", (), re.compile(r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b")),
    ("ssn", ("-",), re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("ip", (".",), re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)")),
    ("card", (), re.compile(r"(?<![\w+-])[3-6]\d{3}(?:[ -]?\d){9,15}(?![\w-])")),
    ("phone", (), re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{3})[ .-]?\d{3}[ .-]\d{4}(?!\w)|(?<!\w)\+\d(?:[ ().-]{0,2}\d){7,13}(?!\w)")),
)
#: types whose matches may hold no digit
_DIGITLESS = frozenset(("email", "secret", "awskey"))
_HEX = re.compile(r"[0-9a-f]+")
_DIGIT = re.compile(r"\d")


@dataclass(frozen=True)
class Found:
    start: int
    end: int
    kind: str
    normal: str


def script(word: str) -> str:
    c = word[:1].lower()
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" else "latin"


def find(text: str) -> list[Found]:
    """The entities of a text, in order, without overlaps."""
    out: list[Found] = []
    digits = _DIGIT.search(text)
    for kind, signs, pattern in _PATTERNS:
        if (not digits and kind not in _DIGITLESS) or (signs and not any(c in text for c in signs)):
            continue
        for m in pattern.finditer(text):
            lo, hi = m.span("v") if kind == "secret" else m.span()
            out.append(Found(lo, hi, kind, normal(kind, text[lo:hi])))
    if _LEAD.search(text):
        surnames = set()
        for m in _PERSON.finditer(text):
            for g in ("g1", "g2"):
                if m[g]:
                    out.append(Found(*m.span(g), "given", m[g]))
            for s in ("s1", "s2"):
                if m[s]:
                    surnames.add(m[s])
        if surnames:  # also where they stand alone
            for m in re.finditer(rf"\b(?:{'|'.join(map(re.escape, sorted(surnames, key=len, reverse=True)))})\b", text):
                out.append(Found(*m.span(), "surname", m[0].lower()))
    out.sort(key=lambda f: (f.start, -f.end))
    kept, end = [], 0
    for f in out:
        if f.start >= end:
            kept.append(f)
            end = f.end
    return kept


def normal(kind: str, mention: str) -> str:
    if kind in ("phone", "card", "ssn"):
        return ("+" if mention[0] == "+" else "") + "".join(c for c in mention if c.isdigit())
    return mention.lower() if kind in ("email", "surname") else mention


def _stream(key: bytes, *parts: str) -> Iterator[int]:
    block = 0
    while True:
        yield from hmac.new(key, "\x1f".join([*parts, str(block)]).encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
        block += 1


def _like(c: str, draw: int) -> str:
    """A character of the same kind, case and script."""
    if c.isdigit():
        return str(draw % 10)
    if not c.isalpha():
        return c
    alphabet = _ALPHABET[script(c)]
    new = alphabet[draw % len(alphabet)]
    return new.upper() if c.isupper() else new


def _with_check_digit(digits: str) -> str:
    """The last digit set so that the Luhn sum holds."""
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(int(c) for c in reversed(digits[:-1])))
    return digits[:-1] + str(-total % 10)


def surrogate(key: bytes, kind: str, norm: str, attempt: int = 0) -> str:
    """The attempt-th surrogate of an entity, as a normal form."""
    s = _stream(key, kind, norm, str(attempt))
    if kind == "given":
        (gender, of), at = _NAME_OF[norm]
        names = GIVEN[gender, of]
        order = sorted(names, key=lambda n: hmac.new(key, f"given\x1f{n}".encode(), hashlib.sha256).digest())
        return order[(order.index(names[at]) + 1) % len(order)]
    if kind == "surname":
        parts = SYLLABLES[script(norm)]
        return "".join(parts[next(s) % len(parts)] for _ in range(2 + next(s) % 2 + attempt // 2))
    if kind == "email":
        cut = norm.rindex(".")
        return "".join(_like(c, next(s)) for c in norm[:cut]) + norm[cut:]
    if kind == "ip":
        return ".".join(_octet(len(o) if attempt < WIDE else 0, s) for o in norm.split("."))
    if kind == "card":
        new = norm[0] + "".join(_like(c, next(s)) for c in norm[1:])
        return _with_check_digit(new) if _with_check_digit(norm) == norm else new
    if kind == "phone":
        keep = 2 if norm[0] == "+" else 0
        return norm[:keep] + "".join(_like(c, next(s)) for c in norm[keep:])
    keep = 4 if kind in ("awskey", "iban") else 0
    if kind == "secret" and _HEX.fullmatch(norm):
        new = "".join("0123456789abcdef"[next(s) % 16] for _ in norm)
    else:
        new = norm[:keep] + "".join(_like(c, next(s)) for c in norm[keep:])
    return new + "".join(_like("0", next(s)) for _ in range(attempt - WIDE + 1 if kind == "secret" else 0))


def _octet(size: int, s: Iterator[int]) -> str:
    low, high = {0: (0, 255), 1: (0, 9), 2: (10, 99), 3: (100, 255)}[size]
    return str(low + next(s) % (high - low + 1))


def render(kind: str, mention: str, new: str) -> str:
    """The surrogate in the mention's format."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(c for c in new if c.isdigit())
        return "".join(next(digits) if c.isdigit() else c for c in mention)
    if kind == "email":
        return "".join(n.upper() if o.isupper() else n for o, n in zip(mention, new))
    if kind == "surname":
        return new.upper() if mention.isupper() else new.capitalize()
    return new


def replaced(text: str, key: bytes, moved: dict[tuple[str, str], int]) -> tuple[str, list[Found]]:
    """The text with surrogates, and what was found."""
    found = find(text)
    out, end = [], 0
    for f in found:
        out += [text[end : f.start], render(f.kind, text[f.start : f.end], surrogate(key, f.kind, f.normal, moved.get((f.kind, f.normal), 0)))]
        end = f.end
    return "".join([*out, text[end:]]), found


# ---------------------------------------------------------------------- Spark


def mentions(docs: DataFrame) -> DataFrame:
    """(doc_id, kind, normal): the distinct entities of each document row."""
    ready(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    schema = T.StructType([docs.schema["doc_id"], T.StructField("kind", T.StringType()), T.StructField("normal", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            at, kind, norm = [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                for k, n in sorted({(f.kind, f.normal) for f in find(t)}) if t else ():
                    at.append(i), kind.append(k), norm.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int32())), pa.array(kind, pa.string()), pa.array(norm, pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)


def _with_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    schema = T.StructType([*entities.schema.fields, T.StructField("new", T.StringType())])

    def run(batches):
        for b in batches:
            kind, norm, attempt = (b.column(n).to_pylist() for n in ("kind", "normal", "attempt"))
            new = [surrogate(key, k, n, a) for k, n, a in zip(kind, norm, attempt)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(new, pa.string())], names=schema.names)

    return entities.mapInArrow(run, schema)


def resolve(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, normal, attempt, new) with no surrogate twice and none that is an
    original of its kind.  Given names are permuted and can't collide."""
    originals = entities.select("kind", F.col("normal").alias("new"))
    todo, settled = entities.withColumn("attempt", F.lit(0)), []
    for _ in range(MAX_ATTEMPTS):
        tried = stored(_with_surrogates(todo, key), "pii-tried")
        bad = tried.where("kind != 'given'").join(originals, ["kind", "new"], "left_semi")
        if settled:
            bad = bad.unionByName(tried.join(union_all(settled).select("kind", "new"), ["kind", "new"], "left_semi").select(*bad.columns))
        first = tried.groupBy("kind", "new").agg(F.min("normal").alias("__first"))
        later = tried.join(first, ["kind", "new"]).where("normal != __first").select(*bad.columns)
        bad = stored(bad.unionByName(later).select("kind", "normal").distinct(), "pii-moved")
        settled.append(tried.join(bad, ["kind", "normal"], "left_anti"))
        if bad.isEmpty():
            break
        todo = tried.join(bad, ["kind", "normal"], "left_semi").select("kind", "normal", (F.col("attempt") + 1).alias("attempt"))
    else:
        raise ValueError(f"surrogates still collide after {MAX_ATTEMPTS} attempts")
    return union_all(settled)


def surrogates(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with surrogates in ``text``, and n_entities."""
    ready(docs.sparkSession)
    docs = docs.drop("n_entities", "__moved", "__doc")
    seen = stored(mentions(docs), "pii-mentions")
    moved = stored(resolve(seen.select("kind", "normal").distinct(), key).where("attempt > 0"), "pii-map")
    fields = [*docs.schema.fields, T.StructField("n_entities", T.LongType())]
    if not moved.isEmpty():
        per = seen.join(moved, ["kind", "normal"]).groupBy(F.col("doc_id").alias("__doc")).agg(F.collect_set(F.struct("kind", "normal", "attempt")).alias("__moved"))
        docs = docs.join(per, F.col("doc_id").eqNullSafe(F.col("__doc")), "left").drop("__doc")
    at = docs.columns.index("text")
    joined = "__moved" in docs.columns
    width = len(fields) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            moved_ = b.column(width).to_pylist() if joined else [None] * b.num_rows
            texts, counts = [], []
            for t, m in zip(b.column(at).to_pylist(), moved_):
                new, found = replaced(t, key, {(x["kind"], x["normal"]): x["attempt"] for x in m or ()}) if t else (t, [])
                texts.append(new), counts.append(len(found))
            cols = [*b.columns[:at], pa.array(texts, pa.string()), *b.columns[at + 1 : width], pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return docs.mapInArrow(run, T.StructType(fields))
