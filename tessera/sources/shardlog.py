"""The manifest of a TFRecord folder: which shards form its current version.

``{root}/_manifest/{job}/{task}.json`` lists the shards that one task wrote, a JSON
line each: path, split, records, bytes, digest.  ``{root}/_manifest/{n}.json`` is
one commit: the parts it publishes, the epoch they belong to, whether it
replaces what was there, and whether it is pending.  The version is what the
commits say in order: a replacing commit drops all before it, a later commit of
an epoch drops that epoch's earlier one.  Pending commits are no part of it, but
can be read by their epoch, so that a ledger over several outputs decides; ``show``
makes them part of it.  A commit is one small file put in place by a rename, so a
writer that dies at any step leaves the previous version or the new one, never a
mixture; shards that no commit names are not part of the version.  There is one
writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs

FOLDER = "_manifest"


@dataclass(frozen=True)
class Shard:
    path: str  # relative to the root
    split: str
    records: int
    bytes: int
    digest: str


@dataclass(frozen=True)
class Part:
    """The shards of one task: the file that lists them, and their sizes."""

    name: str
    sizes: tuple[int, ...]
    records: int


@dataclass(frozen=True)
class Commit:
    number: int
    epoch: str
    replaces: bool
    pending: bool
    parts: tuple[Part, ...]


def _files(fs: pafs.FileSystem, folder: str) -> list[str]:
    try:
        found = fs.get_file_info(pafs.FileSelector(folder))
    except FileNotFoundError:
        return []
    return sorted(f.path for f in found if f.type == pafs.FileType.File)


def _read(fs: pafs.FileSystem, path: str) -> str:
    with fs.open_input_stream(path) as f:
        return f.read().decode()


def _write(fs: pafs.FileSystem, path: str, text: str) -> None:
    """Put in place by a rename: readers see all of the file or none."""
    folder, name = path.rsplit("/", 1)
    fs.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex[:8]}"
    with fs.open_output_stream(draft) as f:
        f.write(text.encode())
    fs.move(draft, path)


def write_part(fs: pafs.FileSystem, base: str, job: str, task: str, shards: list[Shard]) -> Part:
    name = f"{job}/{task}.json"
    _write(fs, f"{base}/{FOLDER}/{name}", "".join(json.dumps(s.__dict__) + "\n" for s in shards))
    return Part(name, tuple(s.bytes for s in shards), sum(s.records for s in shards))


def read_part(fs: pafs.FileSystem, base: str, part: str) -> list[Shard]:
    return [Shard(**json.loads(line)) for line in _read(fs, f"{base}/{FOLDER}/{part}").splitlines()]


def commits(fs: pafs.FileSystem, base: str) -> Iterator[Commit]:
    for path in _files(fs, f"{base}/{FOLDER}"):
        name = path.rsplit("/", 1)[1]
        if name.startswith("."):
            continue
        c = json.loads(_read(fs, path))
        parts = tuple(Part(p["name"], tuple(p["sizes"]), p["records"]) for p in c["parts"])
        yield Commit(int(name.split(".")[0]), c["epoch"], c["replaces"], c["pending"], parts)


def current(fs: pafs.FileSystem, base: str, epochs: list[str] | None = None) -> dict[str, Commit] | None:
    """The commit of each epoch of the version, or of the given epochs, pending or
    not; None without a manifest."""
    version: dict[str, Commit] | None = None
    for c in commits(fs, base):
        version = {} if version is None else version
        if epochs is None and not c.pending:
            version = {} if c.replaces else version
            version.pop(c.epoch, None)
            version[c.epoch] = c
        elif epochs is not None and c.epoch in epochs:
            version[c.epoch] = c
    return version


def add(fs: pafs.FileSystem, base: str, epoch: str, replaces: bool, parts: list[Part], pending: bool = False) -> int:
    """Publish ``parts`` as ``epoch``: the one step that changes the version."""
    number = max((c.number for c in commits(fs, base)), default=0) + 1
    path = f"{base}/{FOLDER}/{number:012d}.json"
    told = [{"name": p.name, "sizes": list(p.sizes), "records": p.records} for p in parts]
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        raise FileExistsError(f"another writer committed {path}")
    _write(fs, path, json.dumps({"epoch": epoch, "replaces": replaces, "pending": pending, "parts": told}))
    return number


def show(fs: pafs.FileSystem, base: str, epoch: str, replaces: bool) -> None:
    """Make a pending epoch part of the version, or all of it; nothing if it is."""
    if epoch in (current(fs, base) or {}):
        return
    for c in (current(fs, base, [epoch]) or {}).values():
        add(fs, base, epoch, replaces, list(c.parts))
