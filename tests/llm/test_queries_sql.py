"""Queries with SQL against that SQL, on the same tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from orderloom.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return db


def test_registered():
    assert set(SQL) <= set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    actual = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)
    assert actual == expected
    assert actual
