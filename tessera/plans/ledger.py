"""The ledger of a record table: which epochs are published.

An epoch is one run's or one micro-batch's share of every output: listing,
records, rejects, shards and batch ids.  Each output of an epoch is written under
the epoch's own name (``{table}/epoch={epoch}``, or the shard manifest's epoch),
replacing whatever a try before left there.  When all are complete, one small
file in ``{records}/_ledger`` publishes the epoch; readers take published epochs
only.  So an epoch that fails between any two outputs is simply written again, and
nothing of it shows before all of it is there.

A full run's entry replaces all entries before it; an epoch is published once.
There is one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER, LISTING = "_ledger", "_listing"


@dataclass(frozen=True)
class Entry:
    number: int
    epoch: str
    replaces: bool
    #: records by split
    records: dict[str, int] = field(default_factory=dict)


class Ledger:
    """The ledger of the record table at ``records_path``."""

    def __init__(self, spark: SparkSession, records_path: str):
        self.spark, self.root = spark, records_path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def _text(self, path: str) -> str:
        f = self._fs.open(self._path(path))
        try:
            return bytes(f.readAllBytes()).decode()
        finally:
            f.close()

    def entries(self) -> list[Entry]:
        """From the last full run on, in order."""
        out: list[Entry] = []
        for name in self._names(f"{self.root}/{FOLDER}"):
            if name.endswith(".json") and not name.startswith("."):
                e = Entry(**json.loads(self._text(f"{self.root}/{FOLDER}/{name}")))
                out = [e] if e.replaces else [*out, e]
        return out

    def published(self) -> list[str]:
        return [e.epoch for e in self.entries()]

    def counts(self) -> dict[str, int]:
        """Published records by split."""
        total: Counter = Counter()
        for e in self.entries():
            total.update(e.records)
        return dict(total)

    def publish(self, epoch: str, records: dict[str, int], *, replaces: bool = False) -> None:
        """Put in place by a rename: the one step that makes the epoch visible."""
        known = [n for n in self._names(f"{self.root}/{FOLDER}") if not n.startswith(".")]
        number = max((int(n.split(".")[0]) for n in known), default=0) + 1
        final = f"{self.root}/{FOLDER}/{number:012d}.json"
        draft = f"{self.root}/{FOLDER}/.{number:012d}-{uuid.uuid4().hex[:8]}"
        entry = Entry(number, epoch, replaces, records)
        f = self._fs.create(self._path(draft), True)
        try:
            f.write(bytearray(json.dumps(entry.__dict__).encode()))
        finally:
            f.close()
        if self._fs.exists(self._path(final)) or not self._fs.rename(self._path(draft), self._path(final)):
            raise FileExistsError(f"another writer published {final}")

    def folder(self, table: str, epoch: str) -> str:
        return f"{table.rstrip('/')}/epoch={epoch}"

    def read(self, table: str, schema: str | None = None) -> DataFrame | None:
        """The published rows of one of the tables, without the epoch; None if no
        epoch has any.  Without a schema, it is that of the epochs with records."""
        entries = [e for e in self.entries() if schema or sum(e.records.values())]
        paths = [self.folder(table, e.epoch) for e in entries]
        paths = [p for p in paths if self._fs.exists(self._path(p))]
        if not paths:
            return None
        r = self.spark.read.option("basePath", table)
        return (r.schema(schema + ", epoch string") if schema else r).parquet(*paths).drop("epoch")

    def drop_unpublished(self, *tables: str) -> None:
        """Delete the folders of epochs that a full run replaced, and of tries that
        came to nothing: a name for each epoch."""
        keep = {f"epoch={e}" for e in self.published()}
        for table in tables:
            for name in self._names(table):
                if name.startswith("epoch=") and name not in keep:
                    self._fs.delete(self._path(f"{table}/{name}"), True)


def has_ledger(spark: SparkSession, records_path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{records_path.rstrip('/')}/{FOLDER}")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def split_counts(records: DataFrame) -> dict[str, int]:
    """Rows by split: a number for each of the few splits."""
    return {r[0]: r[1] for r in records.groupBy("split").agg(F.count(F.lit(1))).collect()}
