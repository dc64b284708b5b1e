"""Stateless seeded randomness as Catalyst expressions.

A draw is a pure function of (seed, row key, name): the first 32 bits of
md5 over ``seed|key...|name`` scaled to [0, 1).  Recomputing a partition
after an executor loss, or evaluating the plan twice (Parquet write and
example write), yields the same numbers.  DuckDB computes the same value
with ``md5`` + a hex cast, which is what the SQL oracle uses.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _as_col(x) -> Column:
    return x.cast("string") if isinstance(x, Column) else F.lit(str(x))


def md5_uniform(seed: int, *parts) -> Column:
    """u in [0, 1) from md5(concat_ws('|', seed, parts...))."""
    key = F.concat_ws("|", F.lit(str(seed)), *[_as_col(p) for p in parts])
    hi32 = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return hi32.cast("double") / F.lit(TWO_32)


def uniform_between(u: Column, lo: float, hi: float) -> Column:
    return F.lit(float(lo)) + u * F.lit(float(hi) - float(lo))


def row_hash_key(seed: int, *parts) -> Column:
    """Full md5 hex string, used as a shuffle order key (batching)."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[_as_col(p) for p in parts]))
