"""Every registered query against its SQL twin, run by DuckDB on the same files."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from gaceta.contract import oracle, queries
from tests.conftest import SF

QUERIES, ORACLE = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry.queries().keys()


def test_entry(spark):
    assert entry.entry(spark).columns == ["year", "month", "rank", "term", "n"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    mine = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    assert mine == sorted(cursor.fetchall(), key=repr)
    assert mine
