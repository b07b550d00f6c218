"""Every registered query against its SQL on the same tables."""


import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return db


def test_every_query_has_its_sql():
    assert set(contract.QUERIES) == set(contract.SQL)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", list(contract.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    actual = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    result = duck.execute(contract.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)
    assert actual == expected
    assert actual, "a query over the test tables returns rows"


def test_order_of_top_products(spark):
    revenue = [r["revenue"] for r in contract.queries()["top_products"](spark, SF_DIR).collect()]
    assert revenue == sorted(revenue, reverse=True)
    top = contract.queries()["top_products_k"](spark, SF_DIR).collect()
    assert [r["revenue"] for r in top] == revenue[:10]


def test_fact_grain_and_payment_invariants(spark):
    fact = contract.queries()["fact_orders"](spark, SF_DIR)
    assert fact.count() == fact.select("order_id", "product_id").distinct().count() == 5942
    ref = contract.queries()["total_revenue_ref"](spark, SF_DIR).first()[0]
    assert str(ref) == "9091662705.08"
    # Every order with a payment has an item here, so nothing is lost or repeated.
    assert str(contract.queries()["total_revenue"](spark, SF_DIR).first()[0]) == "317364757.31"
