"""Every query with SQL gives the SQL's rows on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "scripts"))

from oracle_check import TABLES, as_frame, canon  # noqa: E402

from tessera.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got, want = as_frame(queries.QUERIES[name](spark, SF)), con.execute(queries.SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)


def test_all_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
