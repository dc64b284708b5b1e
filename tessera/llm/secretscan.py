"""Secret scans with corpus-wide ownership frequency.

A scan proposes candidates: assignments, access keys and hex strings (the base
kinds), and tokens of known formats or of mixed character classes (the further
kinds).  Each candidate's value is hashed, and the hashes are counted over the
whole corpus by distinct owners and distinct repositories of each owner.  A value
that many owners hold was copied from an example; one that few hold and that
looks drawn at random is a live credential of its owners.

Base spans are always reported; a span of a further kind is reported if its
verdict is ``owned``.

Defined results: a null or empty text has no spans; a null owner, or repository,
counts as one; rows that repeat an id are rows of their own; a further candidate
that overlaps a base span or a match of a further kind listed earlier is left
out; an empty table gives an empty result; other columns but the text are
carried through, and input columns named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import join_split, pieces, ready, stored, text_bytes

#: owners from which on a value counts as widely copied
COPIED_OWNERS = 3
#: distinct characters that a value of mixed classes has at least
MIXED_CHARS = 12

BASE = ("assign", "access", "hex")
# Public formats of tokens, and words of made-up values.
ASSIGN = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
FURTHER = {
    "github": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "stripe": r"[sr]k_live_[A-Za-z0-9]{16,}",
    "slack": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "google": r"AIza[A-Za-z0-9_-]{35,}",
    "jwt": r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "key": r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]+",
    "url": r"[a-z][a-z0-9+.-]{1,20}://[^\x00-\x20/:@]+:[^\x00-\x20/:@]+@",
    "bearer": r"[Bb]earer\x20+[A-Za-z0-9._~+/-]{16,}=*",
    "mixed": r"[A-Za-z0-9+/_-]+",
}
MADE_UP = ("example", "changeme", "placeholder", "dummy", "sample", "xxxx", "your_", "00000000", "12345678")
# End of the fixed values.
KINDS = (*BASE, *FURTHER)
VERDICTS = ("copied", "made_up", "owned")
#: the shortest match of a kind (of the value, for an assignment)
SHORTEST = {"assign": 6, "access": 20, "hex": 24, "mixed": 20}
#: what every match of a kind contains; kinds not named here lie in a run of 20 or
#: more of the characters of ``mixed``
_NEEDS = {"assign": "", "slack": "xox", "jwt": "eyJ", "key": "PRIVATE KEY-----", "url": "://", "bearer": "earer"}
_KEYWORD = ("passw", "secret", "token", "api")

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_PATTERN = {k: re.compile(p) for k, p in {"access": ACCESS, "hex": HEX, **FURTHER}.items()}
_RUN = np.zeros(256, bool)
_RUN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]] = True


def _mixed(value: str) -> bool:
    chars = set(value)
    kinds = (any("a" <= c <= "z" for c in chars), any("A" <= c <= "Z" for c in chars), any("0" <= c <= "9" for c in chars))
    return len(chars) >= MIXED_CHARS and all(kinds)


def _matches(kind: str, text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, value), leftmost and non-overlapping; failing ones dropped."""
    least = SHORTEST.get(kind, 0)
    if kind == "assign":
        yield from ((m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= least)
    else:
        for m in _PATTERN[kind].finditer(text):
            if m.end() - m.start() >= least and (kind != "mixed" or _mixed(m[0])):
                yield m.start(), m.end(), m[0]


def candidates(text: str, runs: bool = True) -> list[tuple[int, int, int, str]]:
    """(kind's place in KINDS, start, end, value); ``runs``: whether the text may
    have a run of 20 characters of the class of ``mixed``."""
    found: list[tuple[int, int, int, str]] = []
    taken: list[tuple[int, int]] = []  # base spans, and matches of earlier further kinds
    low = None
    for k, kind in enumerate(KINDS):
        if kind == "assign":
            if "=" not in text and ":" not in text:
                continue
            low = text.lower()
            if not any(w in low for w in _KEYWORD):
                continue
        elif kind in _NEEDS:
            if _NEEDS[kind] not in text:
                continue
        elif not runs:
            continue
        own = list(_matches(kind, text))
        if kind in BASE:
            found += [(k, *m) for m in own]
        elif own:
            edge = np.array(sorted(taken), np.int64).reshape(-1, 2)
            reach = np.maximum.accumulate(edge[:, 1]) if len(edge) else edge[:, 1]
            for m in own:
                before = int(np.searchsorted(edge[:, 0], m[1]))  # spans that start before this one ends
                if not before or reach[before - 1] <= m[0]:
                    found.append((k, *m))
        taken += [m[:2] for m in own]
    return found


def _with_runs(raw: np.ndarray, off: np.ndarray, least: int = 20) -> np.ndarray:
    """Whether each text has a run of that many characters of ``mixed``'s class
    (one across two texts counts for both)."""
    inside = np.r_[False, _RUN[raw], False]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, stop = edge[::2], edge[1::2]
    long = stop - start >= least
    start, stop = start[long], stop[long]
    return np.searchsorted(start, off[1:]) > np.searchsorted(stop, off[:-1], side="right")


_FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.IntegerType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("value", T.BinaryType()),
            T.StructField("made_up", T.BooleanType()),
        ]
    )
)


def propose(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, and ``found``: candidates with the
    128-bit hash of their value."""
    ready(docs.sparkSession)
    keep = [c for c in docs.columns if c not in (text, "found")]
    docs = docs.select(*keep, text)
    schema = T.StructType([*docs.drop(text).schema.fields, T.StructField("found", _FOUND)])
    struct = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.binary()), ("made_up", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text, 2 << 20):
            runs = _with_runs(*text_bytes(b.column(len(keep))))
            out = []
            for t, r in zip(b.column(len(keep)).to_pylist(), runs.tolist()):
                rows = []
                for kind, start, end, value in candidates(t, r) if t else ():
                    low = value.lower()
                    digest = hashlib.blake2b(value.encode(), digest_size=16).digest()
                    rows.append({"kind": kind, "start": start, "end": end, "value": digest, "made_up": any(w in low for w in MADE_UP)})
                out.append(rows)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(out, pa.list_(struct))], names=schema.names)

    return docs.mapInArrow(run, schema)


def ownership(uses: DataFrame) -> DataFrame:
    """value, n_owners, n_repos (of all owners together) and n_uses of the
    candidates ``uses`` (value, owner, repo), counted in three steps, each summed
    in the tasks first."""
    per = uses.groupBy("value", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    per = per.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"))
    return per.groupBy("value").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"), F.sum("n").alias("n_uses"))


def scan(docs: DataFrame, owner: str = "source", repo: str = "doc_id", copied: int = COPIED_OWNERS) -> DataFrame:
    """The columns of ``docs`` but the text, and ``found``, sorted by start and
    kind: (start, kind_no, end, kind, verdict, n_owners, n_repos).  verdict:
    ``copied`` from ``copied`` owners on, else ``made_up`` for values with a word of
    MADE_UP, else ``owned``."""
    own = F.monotonically_increasing_id()  # written once, so that it stays
    rows = stored(propose(docs).withColumn("__row", own), "secret-rows")
    uses = rows.select("__row", F.col(owner).alias("owner"), F.col(repo).alias("repo"), F.explode("found").alias("f"))
    uses = stored(uses.select("__row", "owner", "repo", "f.*"), "secret-uses")
    counts = stored(ownership(uses.select("value", "owner", "repo")), "secret-owners")
    judged = join_split(uses.drop("owner", "repo"), counts, "value", "n_uses", uses.count())
    verdict = F.when(F.col("n_owners") >= copied, "copied").when(F.col("made_up"), "made_up").otherwise("owned")
    kind = F.get(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    one = F.struct("start", F.col("kind").alias("kind_no"), "end", kind.alias("kind"), verdict.alias("verdict"), "n_owners", "n_repos")
    # a document's own candidates
    per = judged.groupBy("__row").agg(F.sort_array(F.collect_list(one)).alias("found"))
    out = rows.drop("found").join(per, "__row", "left").drop("__row")
    return out.withColumn("found", F.coalesce("found", F.array().cast(per.schema["found"].dataType)))


def listed(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base(found: str) -> Column:
    return F.filter(found, lambda s: s["kind_no"] < len(BASE))


def reported(found: str) -> Column:
    return F.filter(found, lambda s: (s["kind_no"] < len(BASE)) | (s["verdict"] == "owned"))


def count_of(found: str, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def with_verdict(found: str, verdict: str) -> Column:
    return F.size(F.filter(found, lambda s: s["verdict"] == verdict)).cast("long")
