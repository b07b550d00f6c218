"""Queries against their SQL where one order holds a third of all lines."""

import duckdb
import pytest

import __spark_entry__ as contract
from tests.test_contract import SF_DIR, TABLES

NAMES = [
    "fact_orders",
    "fact_orders_ref",
    "order_items_join",
    "payment_windows",
    "silver_order_items",
    "late_items_pending",
    "fact_merge",
]


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        source = f"SELECT * FROM '{SF_DIR}/{name}.parquet'"
        if name == "lineitem":
            source = f"""SELECT * EXCLUDE (n)
                REPLACE (CASE WHEN n % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey)
                FROM (SELECT *, row_number() OVER () AS n FROM '{SF_DIR}/lineitem.parquet')"""
        duckdb.execute(f"COPY ({source}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_hot_order(spark, skewed_dir, name):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = contract.queries()[name](spark, skewed_dir)
        columns = sorted(df.columns)
        actual = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{skewed_dir}/{table}.parquet'")
    result = db.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)
    assert actual == expected
