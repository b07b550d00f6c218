"""Children meet their orders and are chosen from in one exchange, and lie as a batch does once they are staged."""

import datetime as dt
import re
from decimal import Decimal
from pathlib import Path

import pytest

from orderloom.plans import runs, silver
from orderloom.sinks import parquet
from orderloom.sources.roles import Roles
from tests.conftest import rows
from tests.test_silver import D1, D2, at, deliver, item, items, load_items, load_orders, order

LONG = "0123456789abcdef0123456789abcdef"


def exchanges(df):
    """How often rows are exchanged by a key of orders."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return len(re.findall(r"Exchange hashpartitioning\([^)]*\border_id", plan))


@pytest.fixture
def joins_exchange(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_a_first_load_of_children_is_written_once(spark, lake, monkeypatch):
    written = []
    plain = parquet.write_in_place
    monkeypatch.setattr(silver, "write_in_place", lambda df, path, *c: (written.append(path), plain(df, path, *c)))
    load_orders(spark, lake, [order("a", at(2017)), order("b", at(2018))], [])
    written.clear()
    assert load_items(spark, lake, [item("a", 1), item("x", 1)], [item("b", 1, D1), item("y", 2, D1)]) == [0]
    assert [Path(p).name for p in written] == ["dated"]
    stored = silver.read_silver(spark, lake, silver.ORDER_ITEMS)
    assert rows(stored, "order_id", "order_item_id", "partition_year") == [("a", 1, 2017), ("b", 1, 2018)]
    # The waiting ones are not among the batch's files, which the warehouse's stream takes.
    assert {p.name for p in Path(f"{lake}/silver/order_items/batch_id=0").glob("part*")} == {
        "partition_year=2017", "partition_year=2018"
    }
    waiting = silver.pending(spark, lake, silver.ORDER_ITEMS)
    assert rows(waiting, "order_id", "order_item_id") == [("x", 1), ("y", 2)]
    load_orders(spark, lake, [], [order("x", at(2019), D2)])
    load_items(spark, lake, [], [])
    stored = silver.read_silver(spark, lake, silver.ORDER_ITEMS)
    assert rows(stored, "order_id") == [("a",), ("b",), ("x",)]


def test_children_are_exchanged_once_for_their_order_and_their_choice(spark, lake, monkeypatch, joins_exchange):
    plans = []
    plain = parquet.write_in_place
    monkeypatch.setattr(silver, "write_in_place", lambda df, path, *c: (plans.append(exchanges(df)), plain(df, path, *c)))
    load_orders(spark, lake, [order("a", at(2017))], [])
    plans.clear()
    history, daily = [item("a", 1), item("a", 2)], [item("a", 1, D2, "3.00"), item("a", 1, D1, "2.00")]
    load_items(spark, lake, history, daily)
    # One for the children, one for the orders.
    assert plans == [2]
    stored = silver.read_silver(spark, lake, silver.ORDER_ITEMS)
    assert rows(stored, "order_item_id", "price") == [(1, Decimal("3.00")), (2, Decimal("1.00"))]


def test_latest_items_beside_their_orders_take_one_exchange_a_side(spark, lake, joins_exchange):
    load_orders(spark, lake, [order("a", at(2017)), order("b", at(2018))], [])
    load_items(spark, lake, [item("a", 1), item("b", 1)], [])
    load_items(spark, lake, [], [item("a", 1, D1, "5.00")])
    names = spark.createDataFrame([("a", "A"), ("c", "C")], "order_id string, name string")
    found = silver.read_silver(spark, lake, silver.ORDER_ITEMS, of_orders=names)
    assert rows(found, "order_id", "price", "name") == [("a", Decimal("5.00"), "A")]
    assert exchanges(found) == 2


def test_keys_of_any_form_come_back_from_versions(spark, lake):
    load_orders(spark, lake, [order("a", at(2017))], [])
    texts = [LONG, "ABCD", "", "p", None]
    given = [(n,) for n in range(len(texts))]
    made = [("a", n, text, "s", None, Decimal("1.00"), Decimal("0.00")) for (n,), text in zip(given, texts)]
    daily = [(*row[:5], Decimal("2.00"), row[6], D1) for row in made[:3]]
    history = items(spark, *[(*row, None) for row in made]).drop("ingestion_date")
    silver.load(spark, lake, silver.ORDER_ITEMS, history, deliver(spark, lake, silver.ORDER_ITEMS, items(spark)))
    silver.load(spark, lake, silver.ORDER_ITEMS, history, deliver(spark, lake, silver.ORDER_ITEMS, items(spark, *daily)))
    stored = silver.read_silver(spark, lake, silver.ORDER_ITEMS)
    assert {r.order_item_id: r.product_id for r in stored.collect()} == dict(enumerate(texts))
    assert stored.where("batch_id = 1").count() == 3
    runs.load_warehouse_table(spark, lake, silver.ORDER_ITEMS)
    loaded = runs.read_warehouse(spark, lake, "order_items")
    assert {r.order_item_id: r.product_id for r in loaded.collect()} == dict(enumerate(texts))


def test_payments_of_several_ranges_are_summed_once(spark, tmp_path):
    lines = [("1", "A", 1999, "1.10"), ("1", "N", 2000, "2.20"), ("1", "N", 2001, "3.30"), ("2", "R", 2001, "4.40")]
    made = [(int(k), flag, dt.datetime(year, 1, 1), Decimal(price)) for k, flag, year, price in lines]
    schema = "l_orderkey long, l_returnflag string, l_shipdate timestamp_ntz, l_extendedprice decimal(12,2)"
    spark.createDataFrame(made, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    roles = Roles(spark, str(tmp_path))
    history, daily = roles.payments_between(None, "2000-01-01"), roles.payments_between("2000-01-01", None)
    columns = ["order_id", "payment_sequential", "payment_value", "ingestion_date"]
    assert rows(history, *columns) == [("1", 1, Decimal("1.10"), None)]
    assert rows(daily, *columns) == [
        ("1", 2, Decimal("5.50"), dt.date(2000, 1, 1)), ("2", 1, Decimal("4.40"), dt.date(2001, 1, 1))
    ]
    for part in (history, daily):
        assert "Exchange" not in part._jdf.queryExecution().executedPlan().toString()
