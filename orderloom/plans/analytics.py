"""Reports on the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.scalars import after_days
from orderloom.plans import fact_store, fact_totals
from orderloom.schemas import MONEY_TOTAL


def total_revenue_ref(fact: DataFrame) -> DataFrame:
    """Sum over fact rows: a payment counts once per product of its order."""
    return fact.agg(F.sum("payment_value").cast(MONEY_TOTAL).alias("total_revenue"))


def total_revenue(fact: DataFrame) -> DataFrame:
    """Each order's payment once."""
    per_order = fact.groupBy("order_id").agg(F.max("payment_value").alias("payment_value"))
    return total_revenue_ref(per_order)


def top_products(fact: DataFrame, k: int | None = None) -> DataFrame:
    """Revenue by product, highest first; with `k`, only that many."""
    revenue = fact.groupBy("product_id").agg(F.sum("price").cast(MONEY_TOTAL).alias("revenue"))
    return _ranked(revenue, k)


def _ranked(revenue: DataFrame, k: int | None) -> DataFrame:
    ranked = revenue.orderBy(F.col("revenue").desc(), F.col("product_id").asc())
    return ranked if k is None else ranked.limit(k)


def kept_revenue(spark: SparkSession, root: str) -> DataFrame:
    """`total_revenue` of a stored fact that keeps its totals; the fact is not read."""
    paid = fact_store.read_totals(spark, root, fact_totals.PAID)
    return paid.agg(F.sum("amount").cast(MONEY_TOTAL).alias("total_revenue"))


def kept_top_products(spark: SparkSession, root: str, k: int | None = None) -> DataFrame:
    """`top_products` of a stored fact that keeps its totals; the fact is not read."""
    products = fact_store.read_totals(spark, root, fact_totals.PRODUCT)
    return _ranked(products.select("product_id", F.col("amount").alias("revenue")), k)


def order_payment_total(items: DataFrame) -> DataFrame:
    """What an order's items cost with freight."""
    return items.groupBy("order_id").agg(
        F.round(F.sum(F.col("price") + F.col("freight_value")), 2)
        .cast(MONEY_TOTAL)
        .alias("payment_value")
    )


def shipping_limit(orders: DataFrame, days: int = 2) -> DataFrame:
    """Latest shipping time: a fixed number of days after approval."""
    return orders.select(
        "order_id",
        "order_approved_at",
        after_days(F.col("order_approved_at"), days).alias("shipping_limit_date"),
    )
