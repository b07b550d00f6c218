import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.plans import runs, silver
from orderloom.sinks.folders import complete
from tests.conftest import rows

D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def at(year):
    return dt.datetime(year, 6, 1)


def order(order_id, when, day=None, status="s"):
    return (order_id, "c", status, when, None, None, None, None, day)


def item(order_id, number, day=None, price="1.00"):
    return (order_id, number, "p", "s", None, Decimal(price), Decimal("0.00"), day)


def payment(order_id, sequence, value, day=None):
    return (order_id, sequence, "voucher", 1, Decimal(value), day)


def frame(spark, schema, *values):
    return spark.createDataFrame(list(values), schema)


def orders(spark, *values):
    return frame(spark, schemas.DAILY_ORDERS, *values)


def items(spark, *values):
    return frame(spark, schemas.DAILY_ORDER_ITEMS, *values)


def deliver(spark, lake, table, df):
    """One more file in the table's folder of daily deliveries."""
    if not df.isEmpty():
        df.coalesce(1).write.mode("append").parquet(f"{lake}/daily/{table.name}")
    return f"{lake}/daily/{table.name}"


def load_table(spark, lake, table, history, daily):
    return silver.load(spark, lake, table, history, deliver(spark, lake, table, daily))


def load_orders(spark, lake, history, daily):
    history = orders(spark, *history).drop("ingestion_date")
    return load_table(spark, lake, silver.ORDERS, history, orders(spark, *daily))


def load_items(spark, lake, history, daily):
    history = items(spark, *history).drop("ingestion_date")
    return load_table(spark, lake, silver.ORDER_ITEMS, history, items(spark, *daily))


def stored_orders(spark, lake, *columns):
    return rows(silver.read_silver(spark, lake, silver.ORDERS), *columns)


def stored_items(spark, lake, *columns):
    return rows(silver.read_silver(spark, lake, silver.ORDER_ITEMS), *columns)


def test_history_loads_without_a_daily_delivery(spark, lake):
    assert load_orders(spark, lake, [order("a", at(2017))], []) == [0]
    assert stored_orders(spark, lake, "order_id", "order_purchase_year", "partition_year") == [
        ("a", 2017, 2017)
    ]
    # Undated rows do not make the next run a first load again.
    assert load_orders(spark, lake, [order("a", at(2017))], []) == []
    assert load_orders(spark, lake, [order("a", at(2017))], [order("b", at(2018), D1)]) == [1]
    assert stored_orders(spark, lake, "order_id") == [("a",), ("b",)]


def test_history_text_times_meet_daily_timestamps(spark, lake):
    history = orders(spark, order("a", at(2017))).drop("ingestion_date")
    history = history.withColumns(
        {
            "order_purchase_timestamp": F.lit("2017-06-01 00:00:00"),
            "order_approved_at": F.lit("not yet"),
            "year": F.lit(2017),
        }
    )
    load_table(spark, lake, silver.ORDERS, history, orders(spark, order("b", at(2018), D1)))
    assert stored_orders(spark, lake, "order_id", "order_purchase_timestamp", "order_approved_at") == [
        ("a", at(2017), None),
        ("b", at(2018), None),
    ]


def test_an_undated_newer_copy_does_not_remove_an_order(spark, lake):
    load_orders(spark, lake, [order("a", None), order("b", at(2017))], [])
    assert stored_orders(spark, lake, "order_id") == [("b",)]
    load_orders(spark, lake, [], [order("x", at(2018), D1), order("x", None, D2)])
    load_orders(spark, lake, [], [order("b", None, D3)])
    assert stored_orders(spark, lake, "order_id", "ingestion_date") == [("b", None), ("x", D1)]


def test_later_versions_of_a_key_are_kept_and_the_latest_is_read(spark, lake):
    daily = [order("a", at(2018), D1, "old"), order("a", at(2018), D2, "new")]
    load_orders(spark, lake, [order("a", at(2018), status="history")], daily)
    columns = ["order_id", "order_status", "ingestion_date", "batch_id"]
    assert stored_orders(spark, lake, *columns) == [("a", "new", D2, 0)]
    # Unchanged: nothing is written, whatever its date.
    assert load_orders(spark, lake, [], [order("a", at(2018), D3, "new")]) == []
    assert load_orders(spark, lake, [], [order("a", at(2018), D3, "sent"), order("b", at(2019), D3)]) == [1]
    assert stored_orders(spark, lake, *columns) == [("a", "sent", D3, 1), ("b", "s", D3, 1)]
    # Back to an earlier content is a change, too.
    assert load_orders(spark, lake, [], [order("a", at(2018), D3, "new")]) == [2]
    assert stored_orders(spark, lake, *columns)[0] == ("a", "new", D3, 2)
    # An older version is kept but not read.
    assert load_orders(spark, lake, [], [order("a", at(2018), D1, "late")]) == [3]
    assert stored_orders(spark, lake, *columns)[0] == ("a", "new", D3, 2)


def test_late_and_undated_deliveries_load(spark, lake):
    load_orders(spark, lake, [], [order("a", at(2018), D3)])
    late = [order("b", at(2018), D1), order("c", at(2018), None), order("d", at(2018), D3)]
    assert load_orders(spark, lake, [], late) == [1]
    assert stored_orders(spark, lake, "order_id") == [("a",), ("b",), ("c",), ("d",)]


def test_files_are_taken_once_and_in_batches_of_a_given_number(spark, lake):
    for n in range(4):
        daily = deliver(spark, lake, silver.ORDERS, orders(spark, order(f"o{n}", at(2018), D1)))
    history = orders(spark).drop("ingestion_date")
    assert silver.load(spark, lake, silver.ORDERS, history, daily, files_per_batch=2) == [0, 1]
    assert silver.load(spark, lake, silver.ORDERS, history, daily) == []
    assert len(stored_orders(spark, lake, "order_id")) == 4


def test_children_wait_for_their_order(spark, lake):
    load_orders(spark, lake, [order("a", at(2017))], [])
    load_items(spark, lake, [item("a", 1), item("late", 1)], [item("late", 2, D1), item("never", 1, D1)])
    assert stored_items(spark, lake, "order_id", "order_item_id") == [("a", 1)]
    waiting = silver.pending(spark, lake, silver.ORDER_ITEMS)
    assert rows(waiting, "order_id", "order_item_id") == [("late", 1), ("late", 2), ("never", 1)]

    # The order arrives later; an item of a stored order arrives later too.
    load_orders(spark, lake, [], [order("late", at(2018), D2)])
    load_items(spark, lake, [], [item("a", 2, D2)])
    assert stored_items(spark, lake, "order_id", "order_item_id", "order_purchase_year", "batch_id") == [
        ("a", 1, 2017, 0),
        ("a", 2, 2017, 1),
        ("late", 1, 2018, 1),
        ("late", 2, 2018, 1),
    ]
    assert rows(silver.pending(spark, lake, silver.ORDER_ITEMS), "order_id") == [("never",)]


def test_only_waiting_children_lie_apart(spark, lake):
    load_orders(spark, lake, [order("a", at(2017))], [])
    load_items(spark, lake, [], [item("late", 1, D1), item("a", 1, D1)])
    assert load_items(spark, lake, [], []) == []
    assert load_items(spark, lake, [], [item("a", 2, D2)]) == [1]
    assert spark.read.parquet(f"{lake}/silver/order_items").where("order_id = 'late'").isEmpty()
    assert rows(silver.pending(spark, lake, silver.ORDER_ITEMS), "order_id") == [("late",)]
    load_orders(spark, lake, [], [order("late", at(2018), D2)])
    # No new file is needed for what was waiting.
    assert load_items(spark, lake, [], []) == [2]
    assert silver.pending(spark, lake, silver.ORDER_ITEMS).isEmpty()
    assert load_items(spark, lake, [], []) == []


def test_children_load_when_no_order_was_ever_loaded(spark, lake):
    load_items(spark, lake, [item("a", 1)], [])
    assert silver.read_silver(spark, lake, silver.ORDER_ITEMS).isEmpty()
    load_orders(spark, lake, [order("a", at(2017))], [])
    load_items(spark, lake, [], [])
    assert stored_items(spark, lake, "order_id") == [("a",)]


def test_children_follow_an_order_that_moves(spark, lake):
    load_orders(spark, lake, [order("a", at(2017)), order("b", at(2017))], [])
    load_items(spark, lake, [item("a", 1), item("b", 1)], [])
    load_orders(spark, lake, [], [order("a", at(2019), D1), order("b", at(2017), D1, "sent")])
    assert load_items(spark, lake, [], []) == [1]
    columns = ["order_id", "order_purchase_timestamp", "partition_year", "batch_id"]
    assert stored_items(spark, lake, *columns) == [
        ("a", at(2019), 2019, 1),
        ("b", at(2017), 2017, 0),
    ]


def test_payments_keep_one_row_per_sequence(spark, lake):
    load_orders(spark, lake, [order("a", at(2017))], [])
    payments = frame(
        spark,
        schemas.DAILY_PAYMENTS,
        payment("a", 1, "4.00", D1),
        payment("a", 1, "4.00", D2),
        payment("a", 2, "11.00", D1),
    )
    history = payments.where("false").drop("ingestion_date")
    load_table(spark, lake, silver.PAYMENTS, history, payments)
    stored = silver.read_silver(spark, lake, silver.PAYMENTS)
    assert rows(stored, "payment_sequential", "ingestion_date") == [(1, D2), (2, D1)]


def test_an_interrupted_batch_is_written_again(spark, lake, monkeypatch):
    load_orders(spark, lake, [order("a", at(2017))], [])
    with monkeypatch.context() as patch:
        patch.setattr(silver, "move", lambda *args: 1 / 0)
        with pytest.raises(Exception):
            load_orders(spark, lake, [], [order("b", at(2018), D1)])
    # Half-written files are not visible, and the repeated run replaces them.
    assert stored_orders(spark, lake, "order_id") == [("a",)]
    assert load_orders(spark, lake, [], [order("c", at(2018), D2)]) == [1, 2]
    assert stored_orders(spark, lake, "order_id") == [("a",), ("b",), ("c",)]
    assert complete(spark, f"{lake}/silver/orders", "batch_id") == [0, 1, 2]


def test_a_batch_stored_before_a_crash_is_not_stored_twice(spark, lake, monkeypatch):
    load_orders(spark, lake, [order("a", at(2017))], [])
    plain = silver.move

    def move_and_fail(*args):
        plain(*args)
        raise RuntimeError("lost after the batch was in place")

    with monkeypatch.context() as patch:
        patch.setattr(silver, "move", move_and_fail)
        with pytest.raises(Exception):
            load_orders(spark, lake, [], [order("b", at(2018), D1)])
    assert load_orders(spark, lake, [], []) == []
    assert stored_orders(spark, lake, "order_id", "batch_id") == [("a", 0), ("b", 1)]


def test_a_second_load_takes_few_jobs(spark, lake):
    load_orders(spark, lake, [order("a", at(2017))], [])
    load_items(spark, lake, [], [item("a", 1, D1)])
    daily = deliver(spark, lake, silver.ORDER_ITEMS, items(spark, item("a", 2, D2), item("x", 1, D2)))
    history = items(spark).drop("ingestion_date")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    silver.load(spark, lake, silver.ORDER_ITEMS, history, daily)
    assert len(tracker.getJobIdsForGroup(None)) - before < 40


def test_changes_reach_the_dimensions(spark, lake):
    def product(price, day, weight=1):
        return ("p", "c", 1, 1, 1, weight, 1.0, 1.0, 1.0, Decimal(price), 1, 1.0, day)

    def refresh():
        # The customers' stream has nothing to take yet.
        spark.createDataFrame([], runs._stored("customers")).write.mode("append").parquet(
            runs.warehouse_path(lake, "customers")
        )
        runs.refresh_dimensions(spark, lake)
        shown = rows(runs.dimension(spark, lake, "products"), "product_id", "price")
        return shown, complete(spark, f"{lake}/gold/dim_products", "gen")

    history = frame(spark, schemas.DAILY_PRODUCTS, product("1.00", None)).drop("ingestion_date")
    # A change, nothing new, a later version, an older one that arrives late, a change on the same day.
    for day, price, weight, gens in (
        (D1, "1.00", 1, 1),
        (D2, "2.00", 1, 2),
        (D2, "2.00", 1, 2),
        (D3, "2.00", 5, 3),
        (D1, "7.00", 5, 3),
        (D3, "3.00", 5, 4),
    ):
        daily = frame(spark, schemas.DAILY_PRODUCTS, product(price, day, weight))
        load_table(spark, lake, silver.PRODUCTS, history, daily)
        runs.load_warehouse_table(spark, lake, silver.PRODUCTS)
        shown = "2.00" if price == "7.00" else price
        assert (day, *refresh()) == (day, [("p", Decimal(shown))], list(range(gens)))


@pytest.mark.parametrize("table", [silver.PRODUCTS, silver.CUSTOMERS], ids=lambda t: t.name)
def test_flat_tables_fill_columns_history_lacks(spark, lake, table):
    key = table.keys[0]
    misspelled = {new: old for old, new in table.renames.items()}
    empty = spark.createDataFrame([], table.daily)
    history = spark.createDataFrame([("k1",)], f"{key} STRING").withColumns(
        {old: F.lit(7) for old in misspelled.values()}
    )
    load_table(spark, lake, table, history, empty)
    stored = silver.read_silver(spark, lake, table)
    assert stored.drop("batch_id").columns == table.silver.names
    first = stored.first().asDict()
    assert first[key] == "k1" and first["ingestion_date"] is None
    assert all(first[name] == 7 for name in misspelled)
