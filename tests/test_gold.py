import datetime as dt
import re
from decimal import Decimal as D
from pathlib import Path

import pytest

from orderloom import schemas
from orderloom.plans import analytics, fact_store, gold
from tests.conftest import rows

T0 = dt.datetime(2018, 3, 1, 12)


def tables(spark, orders, items, payments):
    return (
        spark.createDataFrame(
            [(o, "c", when, str(when.year)) for o, when in orders],
            "order_id STRING, customer_id STRING, order_purchase_timestamp TIMESTAMP,"
            " order_purchase_year STRING",
        ),
        spark.createDataFrame(
            [(o, n, p, s, T0, D(price), D("1.00"), None) for o, n, p, s, price in items],
            schemas.DAILY_ORDER_ITEMS,
        ),
        spark.createDataFrame(
            [(o, n, kind, inst, D(v), None) for o, n, kind, inst, v in payments],
            schemas.DAILY_PAYMENTS,
        ),
    )


@pytest.fixture
def fan_out(spark):
    """One order with two items and two payments; others lack one side or the other."""
    return tables(
        spark,
        [("o1", T0), ("no_items", T0), ("no_payments", T0)],
        [
            ("o1", 1, "p1", "s", "5.00"),
            ("o1", 2, "p2", "s", "8.00"),
            ("no_payments", 1, "p1", "s", "1.00"),
            ("no_order", 1, "p1", "s", "1.00"),
        ],
        [
            ("o1", 1, "boleto", 3, "4.00"),
            ("o1", 2, "voucher", 1, "11.00"),
            ("no_items", 1, "boleto", 1, "9.00"),
        ],
    )


def test_payments_count_once_per_order_row(fan_out):
    fact = gold.fact_orders(*fan_out)
    assert fact.schema.names == schemas.FACT_ORDERS.names
    assert rows(fact, "order_id", "product_id", "payment_value", "payment_type", "payment_installments") == [
        ("o1", "p1", D("15.00"), "voucher", 3),
        ("o1", "p2", D("15.00"), "voucher", 3),
    ]


def test_reference_fact_multiplies_payments_by_items(fan_out):
    fact = gold.fact_orders_ref(*fan_out)
    assert rows(fact, "product_id", "payment_value") == [("p1", D("30.00")), ("p2", D("30.00"))]
    assert rows(analytics.total_revenue_ref(fact)) == [(D("60.00"),)]
    assert rows(analytics.total_revenue(gold.fact_orders(*fan_out))) == [(D("15.00"),)]


def test_reference_fact_equals_the_window_query_with_repeated_orders(spark, fan_out):
    orders, items, payments = fan_out
    orders = orders.unionByName(orders)
    for name, df in (("o", orders), ("i", items), ("p", payments)):
        df.createOrReplaceTempView(f"ref_{name}")
    window = spark.sql(
        """SELECT order_id, product_id, CAST(paid AS DECIMAL(28,2)) paid, kind FROM (
             SELECT ref_o.order_id, product_id,
                    SUM(payment_value) OVER (PARTITION BY ref_o.order_id) paid,
                    MAX(payment_type) OVER (PARTITION BY ref_o.order_id) kind,
                    ROW_NUMBER() OVER (PARTITION BY ref_o.order_id, product_id
                                       ORDER BY order_purchase_timestamp DESC) rn
             FROM ref_o JOIN ref_i ON ref_o.order_id = ref_i.order_id
             JOIN ref_p ON ref_o.order_id = ref_p.order_id) WHERE rn = 1"""
    )
    fact = gold.fact_orders_ref(orders, items, payments)
    assert rows(fact, "order_id", "product_id", "payment_value", "payment_type") == rows(window)


def test_fan_out_counts_equal_the_join(spark, fan_out):
    orders, items, payments = fan_out
    out = gold.join_fan_out(orders, items, payments)
    assert rows(out) == [("o1", 2, 2, 4, D("26.00"), D("30.00"))]


@pytest.mark.parametrize("parts", [1, 5])
def test_repeated_product_keeps_the_first_item(spark, parts):
    orders, items, payments = tables(
        spark,
        [("o1", T0)],
        [("o1", 2, "p", "a", "1.00"), ("o1", 1, "p", "b", "7.00"), ("o1", 1, "p", "a", "9.00")],
        [("o1", 1, "boleto", 1, "17.00")],
    )
    fact = gold.fact_orders(orders, items.repartition(parts, "price"), payments)
    assert rows(fact, "product_id", "price") == [("p", D("9.00"))]


def test_repair_restores_the_grain(spark):
    values = [
        ("o", "c", "p", T0, "2018", D("2.00"), D("0.00"), D("5.00"), "x", 1),
        ("o", "c", "p", dt.datetime(2019, 1, 1), "2019", D("3.00"), D("0.00"), D("5.00"), "x", 1),
        ("o", "c", "q", T0, "2018", D("1.00"), D("0.00"), D("5.00"), "x", 1),
    ]
    fact = spark.createDataFrame(values, schemas.FACT_ORDERS)
    assert rows(gold.repaired(fact), "product_id", "price") == [("p", D("3.00")), ("q", D("1.00"))]


def test_dimensions_take_the_latest_row(spark):
    day = dt.date(2024, 1, 1)
    customers = spark.createDataFrame(
        [
            ("c1", "u", None, None, None, None, "01", "old", "S", None),
            ("c1", "u", "F", "L", "e", "p", "01", "new", "S", day),
        ],
        schemas.SILVER_CUSTOMERS,
    )
    assert rows(gold.dim_customers(customers)) == [("c1", "new", "S", "F", "L", "e", "p")]
    products = spark.createDataFrame([], schemas.SILVER_PRODUCTS)
    assert gold.dim_products(products).columns == schemas.DIM_PRODUCTS


def test_reports(spark, fan_out):
    orders, items, payments = fan_out
    fact = gold.fact_orders(*fan_out)
    ranked = [tuple(r) for r in analytics.top_products(fact).collect()]
    assert ranked == [("p2", D("8.00")), ("p1", D("5.00"))]
    assert analytics.top_products(fact, k=1).collect()[0]["product_id"] == "p2"
    totals = analytics.order_payment_total(items).where("order_id = 'o1'")
    assert rows(totals) == [("o1", D("15.00"))]


def test_changed_orders_prune_by_year_only_when_known(spark, lake):
    kind = "order_id STRING, order_purchase_year STRING"
    table = spark.createDataFrame([("a", "2017"), ("b", "2018"), ("c", None)], kind)
    found = lambda changed, path: rows(gold.of_changed_orders([table], changed, f"{lake}/{path}")[0])
    assert found(spark.createDataFrame([("b", "2018"), ("b", "2018")], kind), "1") == [("b", "2018")]
    changed = spark.createDataFrame([("b", "2018"), ("c", None)], kind)
    assert found(changed, "2") == [("b", "2018"), ("c", None)]
    assert found(changed.select("order_id"), "3") == [("b", "2018"), ("c", None)]
    # Rows under a year that the order has left are found by the order's other versions.
    orders = spark.createDataFrame([("a", "2017"), ("a", "2019")], kind)
    payments = spark.createDataFrame([("a", "2017"), ("z", "2017")], kind)
    changed = spark.createDataFrame([("a", "2019")], kind)
    assert rows(gold.of_changed_orders([orders, payments], changed, f"{lake}/4")[1]) == [("a", "2017")]


# --- merge ---------------------------------------------------------------------------------


def fact_row(order_id, product_id, when, price, paid="1.00", kind="x", installments=1):
    price = None if price is None else D(price)
    return (
        order_id, "c", product_id, when, str(when.year), price, D("0.00"), D(paid), kind, installments
    )


def facts(spark, *values):
    return spark.createDataFrame(list(values), schemas.FACT_ORDERS)


JAN, FEB = dt.datetime(2018, 1, 5), dt.datetime(2018, 2, 5)


def test_merge_updates_inserts_and_keeps_the_rest(spark, lake):
    first = facts(
        spark,
        fact_row("a", "p", JAN, "1.00"),
        fact_row("b", "p", JAN, "2.00"),
        fact_row("c", "p", FEB, "3.00"),
    )
    fact_store.merge_fact(spark, lake, first, 0)
    # "a" is updated with a NULL, "c" comes with another purchase month, "d" is new.
    batch = facts(
        spark,
        fact_row("a", "p", JAN, None, "9.00", "y", 2),
        fact_row("c", "p", dt.datetime(2019, 7, 1), "4.00"),
        fact_row("d", "p", FEB, "5.00"),
        fact_row("e", None, FEB, "6.00"),
    )
    for batch_id in (1, 2):  # the second time changes nothing
        fact_store.merge_fact(spark, lake, batch, batch_id)
        stored = fact_store.read_fact(spark, lake)
        assert rows(stored, "order_id", "price", "payment_value", "order_purchase_timestamp") == [
            ("a", None, D("9.00"), JAN),
            ("b", D("2.00"), D("1.00"), JAN),
            ("c", D("4.00"), D("1.00"), FEB),
            ("d", D("5.00"), D("1.00"), FEB),
        ]
        rejects = spark.read.parquet(f"{lake}/rejects/batch_id={batch_id}")
        assert rows(rejects, "order_id", "product_id") == [("e", None)]


def test_whole_orders_replace_what_is_stored_of_them(spark, lake):
    first = [fact_row("a", "p", JAN, "1.00"), fact_row("a", "q", JAN, "2.00"), fact_row("b", "p", JAN, "3.00")]
    fact_store.merge_fact(spark, lake, facts(spark, *first), 0)
    changed = spark.createDataFrame([("a",), ("gone",)], "order_id STRING")
    batch = facts(spark, fact_row("a", "p", FEB, "4.00"))
    columns = ["order_purchase_timestamp", *schemas.FACT_MEASURES]
    fact_store.merge_fact(spark, lake, batch, 1, of_orders=changed, update=columns)
    stored = fact_store.read_fact(spark, lake)
    assert rows(stored, "order_id", "product_id", "order_purchase_timestamp", "price") == [
        ("a", "p", FEB, D("4.00")),
        ("b", "p", JAN, D("3.00")),
    ]
    # The last row of a bucket may go, too.
    fact_store.merge_fact(spark, lake, batch.where("false"), 2, of_orders=changed)
    assert rows(fact_store.read_fact(spark, lake), "order_id") == [("b",)]


def written(root, kind):
    """Files and bytes of each generation of a kind, beside checksums and markers."""
    found = {}
    for file in Path(root).glob(f"{kind}/generation=*/**/*.parquet"):
        generation = int(re.search(r"generation=(\d+)", str(file))[1])
        files, size = found.get(generation, (0, 0))
        found[generation] = (files + 1, size + file.stat().st_size)
    return found


def test_a_merge_writes_in_proportion_to_what_changed(spark, lake):
    days = [JAN, dt.datetime(2019, 3, 1), dt.datetime(2020, 3, 1)]
    many = [fact_row(f"o{i}", f"p{i % 7}", days[i % 3], f"{i}.00") for i in range(6000)]
    fact_store.merge_fact(spark, lake, facts(spark, *many), 0, buckets=8)
    assert set(written(lake, "base")) == {0}
    expected = {f"o{i}": D(f"{i}.00") for i in range(6000)}
    sizes = []
    for batch_id, changed in ((1, range(7, 8)), (2, range(1000, 1600))):
        batch = facts(spark, *[fact_row(f"o{i}", f"p{i % 7}", FEB, "0.50") for i in changed])
        ids = batch.select("order_id")
        columns = [c for c in schemas.FACT_ORDERS.names if c not in schemas.FACT_KEYS]
        fact_store.merge_fact(spark, lake, batch, batch_id, of_orders=ids, update=columns)
        expected |= {f"o{i}": D("0.50") for i in changed}
        files, size = written(lake, "delta")[batch_id]
        assert files <= 8
        sizes.append(size)
        assert set(written(lake, "base")) == {0}
        assert dict(rows(fact_store.read_fact(spark, lake), "order_id", "price")) == expected
    base = written(lake, "base")[0][1]
    assert sizes[0] < base / 10 and sizes[1] < base / 3


def test_a_report_opens_the_years_it_asks_for(spark, lake):
    many = [fact_row(f"o{i}", "p", dt.datetime(2017 + i % 3, 1, 5), "1.00") for i in range(60)]
    fact_store.merge_fact(spark, lake, facts(spark, *many), 0, buckets=2)
    fact_store.merge_fact(spark, lake, facts(spark, fact_row("o1", "p", JAN, "5.00")), 1)
    report = fact_store.read_fact(spark, lake).where("order_purchase_year = '2018'")
    assert report.count() == 20
    plan = report._jdf.queryExecution().executedPlan().toString()
    base = next(line for line in plan.splitlines() if "Bucketed" in line and "order_purchase_year" in line)
    assert re.search(r"PartitionFilters: \[[^]]*order_purchase_year[^]]* = 2018", base)


def test_reading_does_not_exchange_the_base(spark, lake):
    many = [fact_row(f"o{i}", "p", JAN, "1.00") for i in range(60)]
    fact_store.merge_fact(spark, lake, facts(spark, *many), 0, buckets=4)
    fact_store.merge_fact(spark, lake, facts(spark, fact_row("o1", "p", JAN, "5.00")), 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fact_store.read_fact(spark, lake)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    base = next(n for n, line in enumerate(lines) if "Bucketed: true" in line)
    join = max(n for n, line in enumerate(lines[:base]) if "Join" in line)
    assert not any("Exchange" in line for line in lines[join:base])


@pytest.mark.parametrize("most", [1, 3, 100])
def test_many_merges_equal_one_table(spark, lake, monkeypatch, most):
    """Deltas become one, and a base, without a change to what is read."""
    monkeypatch.setattr(fact_store, "MOST_DELTAS", most)
    monkeypatch.setattr(fact_store, "BASE_PART", 2)
    expected = {}
    for n in range(7):
        changed = [f"o{i}" for i in range(n, 24, 7)] if n else [f"o{i}" for i in range(24)]
        kept = changed[::2]
        batch = facts(spark, *[fact_row(o, "p", JAN, f"{n}.00") for o in kept])
        ids = spark.createDataFrame([(o,) for o in changed], "order_id STRING")
        fact_store.merge_fact(spark, lake, batch, n, of_orders=ids, buckets=2)
        expected = {o: p for o, p in expected.items() if o not in changed} | {o: D(f"{n}.00") for o in kept}
        assert dict(rows(fact_store.read_fact(spark, lake), "order_id", "price")) == expected
    pointer = fact_store._pointer(spark, lake)
    assert len(fact_store._of_kind(pointer, "delta")) <= most
    # What does not count any more has gone, but for the last merge's leavings.
    counted = {(r["kind"] == "base" or r["buckets"] > 0, r["generation"]) for r in pointer}
    on_disk = {(kind == "base", g) for kind in ("base", "delta") for g in written(lake, kind)}
    assert on_disk <= counted


def test_readers_see_the_old_fact_or_the_new_one(spark, lake, monkeypatch):
    many = [fact_row(f"o{i}", "p", JAN, "1.00") for i in range(20)]
    fact_store.merge_fact(spark, lake, facts(spark, *many), 0, buckets=4)
    before = fact_store.read_fact(spark, lake)
    counts = []
    plain = fact_store.publish

    def publish(df, root):
        # All data is written; nothing is replaced yet.
        counts.append((fact_store.read_fact(spark, lake).count(), before.count()))
        return plain(df, root)

    monkeypatch.setattr(fact_store, "publish", publish)
    again = [fact_row(f"o{i}", "p", JAN, "2.00") for i in range(20)]
    fact_store.merge_fact(spark, lake, facts(spark, *again, fact_row("new", "p", JAN, "2.00")), 1)
    assert counts == [(20, 20)]
    assert before.count() == 20 and fact_store.read_fact(spark, lake).count() == 21


def test_an_interrupted_merge_is_written_again(spark, lake, monkeypatch):
    fact_store.merge_fact(spark, lake, facts(spark, fact_row("a", "p", JAN, "1.00")), 0)
    batch = facts(spark, fact_row("a", "p", JAN, "8.00"), fact_row("b", "p", FEB, "2.00"))
    with monkeypatch.context() as patch:
        patch.setattr(fact_store, "publish", lambda df, root: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            fact_store.merge_fact(spark, lake, batch, 1)
    assert rows(fact_store.read_fact(spark, lake), "order_id", "price") == [("a", D("1.00"))]
    fact_store.merge_fact(spark, lake, batch, 1)
    assert rows(fact_store.read_fact(spark, lake), "order_id", "price") == [("a", D("8.00")), ("b", D("2.00"))]


def test_the_stored_fact_is_repaired_in_place(spark, lake, monkeypatch):
    repeated = [
        fact_row("a", "p", JAN, "1.00"),
        fact_row("a", "p", FEB, "2.00"),
        fact_row("a", "q", FEB, "4.00"),
        *[fact_row(f"o{i}", "p", JAN, "3.00") for i in range(20)],
    ]
    fact_store.merge_fact(spark, lake, facts(spark, *repeated), 0)
    fact_store.repair_fact(spark, lake)
    stored = fact_store.read_fact(spark, lake).where("order_id = 'a'")
    assert rows(stored, "product_id", "price") == [("p", D("2.00")), ("q", D("4.00"))]
    assert fact_store.read_fact(spark, lake).count() == 22
    files = fact_store.read_fact(spark, lake).inputFiles()

    # A certified generation is not read again, and what a merge knows to be unique needs no repair.
    checked = []
    plain = fact_store._counting
    monkeypatch.setattr(fact_store, "_counting", lambda *args: checked.append(args) or plain(*args))
    fact_store.repair_fact(spark, lake)
    assert not checked and fact_store.read_fact(spark, lake).inputFiles() == files
    checked.clear()
    ids = spark.createDataFrame([("o1",)], "order_id STRING")
    row = facts(spark, fact_row("o1", "p", JAN, "5.00"))
    columns = [c for c in schemas.FACT_ORDERS.names if c not in schemas.FACT_KEYS]
    fact_store.merge_fact(spark, lake, row, 1, of_orders=ids, update=columns, unique=True)
    checked.clear()
    fact_store.repair_fact(spark, lake)
    assert not checked
    # One that is not known to be unique is read alone.
    fact_store.merge_fact(spark, lake, row.union(row), 2, of_orders=ids, update=columns)
    fact_store.repair_fact(spark, lake)
    assert rows(fact_store.read_fact(spark, lake).where("order_id = 'o1'"), "price") == [(D("5.00"),)]
    assert fact_store.read_fact(spark, lake).count() == 22


def test_rows_without_a_purchase_time_are_merged_too(spark, lake):
    undated = facts(spark, ("a", "c", "p", None, None, D("1.00"), D("0.00"), D("1.00"), "x", 1))
    fact_store.merge_fact(spark, lake, undated, 0)
    fact_store.merge_fact(spark, lake, undated, 1)
    assert rows(fact_store.read_fact(spark, lake), "order_id", "order_purchase_timestamp") == [("a", None)]
