"""The queries that SQL can express, against DuckDB on the same files; and what is registered."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from gaceta.llm import oracle, queries
from tests.conftest import SF

QUERIES, ORACLE = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path).removesuffix('.parquet')} as select * from '{path}'")
    return con


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert QUERIES.keys() | {"pipeline"} <= entry.queries().keys()
    assert ORACLE.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    mine = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    assert mine == sorted(cursor.fetchall(), key=repr)
    assert mine
