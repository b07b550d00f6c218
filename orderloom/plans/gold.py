"""Silver to gold: the order fact and its two dimensions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.keys import packed, unpacked
from orderloom.operators.dedup import keep_first, newest_first
from orderloom.operators.enrich import rows_of_keys
from orderloom.operators.skew import join_one_per_key
from orderloom.operators.versions import latest_versions
from orderloom.schemas import (
    DIM_CUSTOMERS,
    DIM_PRODUCTS,
    FACT_KEYS,
    FACT_ORDERS,
    MONEY_SUM,
    ORDER_YEAR,
)

ORDER_COLUMNS = ["order_id", "customer_id", "order_purchase_timestamp", "order_purchase_year"]
ITEM_COLUMNS = [
    "order_id",
    "order_item_id",
    "product_id",
    "seller_id",
    "shipping_limit_date",
    "price",
    "freight_value",
]
# Keys in hex, which are half as long on their way through an exchange.
LONG_KEYS = ["customer_id", "product_id"]


def _item_choice() -> list[Column]:
    """Which item row stands for a product that occurs twice in an order."""
    ties = ["order_item_id", "seller_id", "shipping_limit_date", "price"]
    return [F.col("order_purchase_timestamp").desc_nulls_last()] + [
        F.col(c).asc_nulls_last() for c in ties
    ]


# --- joins and measures ----------------------------------------------------------------


def order_lines(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with their items, one row per item."""
    return join_one_per_key(items.select(*ITEM_COLUMNS), orders.select(*ORDER_COLUMNS), ["order_id"])


def payment_totals(payments: DataFrame) -> DataFrame:
    """One row per order: what was paid, and the highest type and installment count."""
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").cast(MONEY_SUM).alias("payment_value"),
        F.max("payment_type").alias("payment_type"),
        F.max("payment_installments").alias("payment_installments"),
    )


def join_fan_out(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Size and sums of orders x items x payments per order, without building the pairs.

    Within an order every item meets every payment, so each side's sum is multiplied by the
    other side's row count.
    """
    order_rows = orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("order_rows"))
    item_side = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_rows"), F.sum("price").alias("price")
    )
    payment_side = payments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("payment_rows"), F.sum("payment_value").alias("paid")
    )
    joined = order_rows.join(item_side, "order_id").join(payment_side, "order_id")
    orders_items = F.col("order_rows") * F.col("item_rows")
    orders_payments = F.col("order_rows") * F.col("payment_rows")
    return joined.select(
        "order_id",
        "item_rows",
        "payment_rows",
        (orders_items * F.col("payment_rows")).alias("joined_rows"),
        (F.col("price") * orders_payments).cast(MONEY_SUM).alias("joined_price"),
        (F.col("paid") * orders_items).cast(MONEY_SUM).alias("joined_payment"),
    )


# --- the fact ----------------------------------------------------------------------------


def paid_lines(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    then: Callable[[DataFrame], DataFrame] = lambda lines: lines,
) -> DataFrame:
    """One row per item, with its order and the order's payments summed before the join."""
    heads = packed(orders.select(*ORDER_COLUMNS), *LONG_KEYS)
    paid_orders = heads.join(payment_totals(payments), "order_id")
    lines = packed(items.select(*ITEM_COLUMNS), *LONG_KEYS)
    return join_one_per_key(
        lines, paid_orders, ["order_id"], then=lambda joined: then(unpacked(joined, *LONG_KEYS))
    )


def _one_per_product(lines: DataFrame) -> DataFrame:
    return keep_first(lines, FACT_KEYS, _item_choice()).select(*FACT_ORDERS.names)


def fact_orders(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per order and product.

    All three inputs are exchanged once, on order_id; the choice of one item per product
    then needs no exchange of its own.
    """
    return paid_lines(orders, items, payments, then=_one_per_product)


def fact_orders_ref(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """The fact as a window sum over the multiplied rows gives it.

    Each payment then counts once per item (and per copy of the order row). The same value
    comes from the payment total times the row counts, with nothing multiplied out.
    """
    heads = orders.groupBy("order_id").agg(
        F.max(F.struct("order_purchase_timestamp", "customer_id", "order_purchase_year")).alias("h"),
        F.count(F.lit(1)).alias("order_rows"),
    )
    item_rows = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("item_rows"))
    measures = (
        heads.join(item_rows, "order_id")
        .join(payment_totals(payments), "order_id")
        .select(
            "order_id",
            "h.*",
            (F.col("payment_value") * (F.col("order_rows") * F.col("item_rows")))
            .cast(MONEY_SUM)
            .alias("payment_value"),
            "payment_type",
            "payment_installments",
        )
    )
    return join_one_per_key(
        items.select(*ITEM_COLUMNS), measures, ["order_id"], then=_one_per_product
    )


def repaired(fact: DataFrame) -> DataFrame:
    """Restore the fact's grain: one row per order and product, the latest purchase."""
    order = [F.col("order_purchase_timestamp").desc_nulls_last()] + [
        F.col(c).asc_nulls_last()
        for c in FACT_ORDERS.names
        if c not in FACT_KEYS and c != "order_purchase_timestamp"
    ]
    return keep_first(fact, FACT_KEYS, order).select(*FACT_ORDERS.names)


def of_changed_orders(
    tables: Sequence[DataFrame], changed: DataFrame, ids_path: str
) -> list[DataFrame]:
    """The tables' rows of the changed orders; the first table is the orders.

    Every measure depends on one order only, so recomputing these orders from the full
    tables gives what recomputing everything would. The ids are written out once: they serve
    each table, and their size is then known to the planner. Changes that carry their order's
    year confine the scans to those years, and to the years that any stored version of these
    orders has: an order that moved still has rows under the year it left.
    """
    columns = [c for c in ("order_id", ORDER_YEAR) if c in changed.columns]
    changed.select(*columns).distinct().write.mode("overwrite").option("compression", "zstd").parquet(ids_path)
    ids = changed.sparkSession.read.parquet(ids_path)
    if ORDER_YEAR in columns:
        stored = rows_of_keys(tables[0].select(*columns), ids, ["order_id"])
        # One value per year in the tables; as literals they prune partitions.
        found = ids.select(ORDER_YEAR).union(stored.select(ORDER_YEAR)).distinct()
        years = [row[0] for row in found.collect()]
        if None not in years:
            tables = [table.where(F.col(ORDER_YEAR).isin(years)) for table in tables]
    return [
        unpacked(rows_of_keys(packed(table, *LONG_KEYS), ids, ["order_id"]), *LONG_KEYS).select(*table.columns)
        for table in tables
    ]


# --- dimensions ----------------------------------------------------------------------------


def _latest(rows: DataFrame, key: str) -> DataFrame:
    if "batch_id" in rows.columns:
        return latest_versions(rows, [key])
    return keep_first(rows, [key], newest_first(rows.columns))


def dim_customers(customers: DataFrame) -> DataFrame:
    return _latest(customers, "customer_id").select(*DIM_CUSTOMERS)


def dim_products(products: DataFrame) -> DataFrame:
    return _latest(products, "product_id").select(*DIM_PRODUCTS)
