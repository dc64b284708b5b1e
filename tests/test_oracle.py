"""Every registered query against its DuckDB SQL on the smallest tables."""

import math
import os
import sys

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))

from oracle_check import as_frame  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canon(df):
    cols = sorted(df.columns)

    def norm(v):
        if v is None or v is pd.NA:
            return None
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6) + 0.0
        if hasattr(v, "item"):
            return norm(v.item())
        return v

    return sorted((tuple(norm(r[c]) for c in cols) for r in df[cols].to_dict("records")), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    sp = as_frame(E.queries()[name](spark, SF_SMALL))
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(sp) >= 0
        return
    dd = con.execute(sql).fetchdf()
    assert sorted(sp.columns) == sorted(dd.columns)
    assert len(sp) == len(dd)
    assert canon(sp) == canon(dd)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["image_path", "augmentation_index", "split", "label", "pos", "value"]
