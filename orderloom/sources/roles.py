"""The order entities, taken from star-schema tables of the TPC-H kind.

customer -> customers, part -> products, orders -> orders, lineitem -> order items and
payments, events -> reviews. Rows dated before DAILY_START are history; later ones arrive
in daily deliveries whose load date is their own date.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.keys import (
    CUSTOMER_NAMESPACE,
    PRODUCT_NAMESPACE,
    surrogate_key,
    text_key,
)
from orderloom.functions.scalars import money
from orderloom.schemas import MONEY
from orderloom.session import new_folder
from orderloom.sinks.parquet import write_flat

DAILY_START = "2000-01-01"
SECOND_BATCH = "2001-01-01"


def _instant(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _daily_date(moment: Column) -> Column:
    return F.when(moment >= _instant(DAILY_START), moment.cast("date"))


class Roles:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}
        self._dated_payments: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # --- orders ---------------------------------------------------------------------

    def _orders(self, source: DataFrame) -> DataFrame:
        purchase = F.col("o_orderdate").cast("timestamp")
        no_time = F.lit(None).cast("timestamp")
        return source.select(
            _text("o_orderkey").alias("order_id"),
            surrogate_key(CUSTOMER_NAMESPACE, F.col("o_custkey")).alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            purchase.alias("order_purchase_timestamp"),
            (purchase + F.expr("INTERVAL 15 MINUTES")).alias("order_approved_at"),
            no_time.alias("order_delivered_carrier_date"),
            no_time.alias("order_delivered_customer_date"),
            no_time.alias("order_estimated_delivery_date"),
            _daily_date(F.col("o_orderdate")).alias("ingestion_date"),
        )

    def orders(self) -> DataFrame:
        return self._orders(self.table("orders"))

    def orders_between(self, start: str | None, end: str | None) -> DataFrame:
        return self._orders(_between(self.table("orders"), "o_orderdate", start, end))

    def warehouse_orders(self) -> DataFrame:
        return with_year_text(self.orders())

    # --- order items ----------------------------------------------------------------

    def _order_items(self, source: DataFrame) -> DataFrame:
        price = F.col("l_extendedprice").cast(MONEY)
        return source.select(
            _text("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            surrogate_key(PRODUCT_NAMESPACE, F.col("l_partkey")).alias("product_id"),
            _text("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").cast("timestamp").alias("shipping_limit_date"),
            price.alias("price"),
            money(price * F.col("l_tax").cast("decimal(4,2)")).alias("freight_value"),
            _daily_date(F.col("l_shipdate")).alias("ingestion_date"),
        )

    def order_items(self) -> DataFrame:
        return self._order_items(self.table("lineitem"))

    def order_items_between(self, start: str | None, end: str | None) -> DataFrame:
        return self._order_items(_between(self.table("lineitem"), "l_shipdate", start, end))

    # --- payments -------------------------------------------------------------------

    def payments(self, dated: bool = False) -> DataFrame:
        """One payment per order and return flag; when dated, by its first shipment.

        The three flags are summed side by side under one group key, so the rows are
        shuffled once and stay partitioned by order. Sums are of whole cents, as those of decimals take
        twice the room on their way.
        """
        flag = F.col("l_returnflag")
        cents = (F.col("l_extendedprice").cast(MONEY) * 100).cast("bigint")
        kinds = {
            "a": (flag == "A", "credit_card"),
            "n": (flag == "N", "boleto"),
            "r": (~flag.isin("A", "N"), "voucher"),
        }
        sums = []
        for name, (is_kind, _) in kinds.items():
            sums += [
                F.count_if(is_kind).cast("int").alias(f"{name}_count"),
                (F.sum(F.when(is_kind, cents)).cast("decimal(19,0)") * F.lit(Decimal("0.01"))).cast(MONEY).alias(f"{name}_value"),
            ]
            if dated:
                sums.append(F.min(F.when(is_kind, F.col("l_shipdate"))).alias(f"{name}_from"))
        by_order = self.table("lineitem").groupBy(_text("l_orderkey").alias("order_id")).agg(*sums)

        present = F.lit(0)
        rows = []
        for name, (_, payment_type) in kinds.items():
            count = F.col(f"{name}_count")
            present = present + F.when(count > 0, 1).otherwise(0)
            fields = [
                present.alias("payment_sequential"),
                F.lit(payment_type).alias("payment_type"),
                count.alias("payment_installments"),
                F.col(f"{name}_value").alias("payment_value"),
            ]
            if dated:
                fields.append(F.col(f"{name}_from").alias("paid_from"))
            rows.append(F.struct(*fields))
        return by_order.select("order_id", F.inline(F.array(*rows))).where(
            F.col("payment_installments") > 0
        )

    def payments_between(self, start: str | None, end: str | None) -> DataFrame:
        """Payments with their load date, within a range of it. The sums of all orders are made and written
        once, as history and deliveries are ranges of the same."""
        if self._dated_payments is None:
            path = new_folder(self.spark, "payments")
            write_flat(self.payments(dated=True), path)
            self._dated_payments = self.spark.read.parquet(path)
        return (
            _between(self._dated_payments, "paid_from", start, end)
            .withColumn("ingestion_date", _daily_date(F.col("paid_from")))
            .drop("paid_from")
        )

    # --- customers ------------------------------------------------------------------

    def _people(self) -> DataFrame:
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )

    def regions(self) -> DataFrame:
        """A source so small that a few pulls exhaust it."""
        return self.table("region").select(F.col("r_regionkey").cast("bigint").alias("id"))

    def users(self) -> DataFrame:
        """Customers as nested API records."""
        return self._people().select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("username"),
            F.col("c_mktsegment").alias("firstName"),
            F.col("c_name").alias("lastName"),
            F.concat(F.lower("c_name"), F.lit("@"), F.lower("n_name"), F.lit(".example")).alias(
                "email"
            ),
            F.col("c_acctbal").cast(MONEY).cast("string").alias("phone"),
            F.struct(
                F.col("n_name").alias("city"),
                F.col("r_name").alias("state"),
                F.lpad(_text("c_custkey"), 5, "0").alias("postalCode"),
            ).alias("address"),
        )

    def user_deliveries(self, start: str = DAILY_START, until: str | None = None) -> DataFrame:
        """A user record is delivered again on every date the customer ordered."""
        dates = (
            _between(self.table("orders"), "o_orderdate", start, until)
            .select(
                F.col("o_custkey").alias("id"),
                F.col("o_orderdate").cast("date").alias("ingestion_date"),
            )
            .distinct()
        )
        return self.users().join(dates, "id")

    def history_customers(self) -> DataFrame:
        return self._people().select(
            surrogate_key(CUSTOMER_NAMESPACE, F.col("c_custkey")).alias("customer_id"),
            text_key(F.col("c_name")).alias("customer_unique_id"),
            F.lpad(_text("c_custkey"), 5, "0").alias("customer_zip_code_prefix"),
            F.col("n_name").alias("customer_city"),
            F.col("r_name").alias("customer_state"),
        )

    # --- products -------------------------------------------------------------------

    def product_records(self) -> DataFrame:
        """Products as nested API records."""
        size = F.col("p_size")
        return self.table("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_type").alias("category"),
            F.col("p_name").alias("title"),
            F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("description"),
            F.split("p_name", " ").alias("images"),
            size.alias("weight"),
            F.struct(
                (size / 2).cast("double").alias("depth"),
                (size / 4).cast("double").alias("height"),
                (size * 2).cast("double").alias("width"),
            ).alias("dimensions"),
            F.col("p_retailprice").cast(MONEY).alias("price"),
        )

    def product_deliveries(self, start: str = DAILY_START, until: str | None = None) -> DataFrame:
        """A product record is delivered again for each year it shipped in."""
        per_year = (
            _between(self.table("lineitem"), "l_shipdate", start, until)
            .groupBy(F.col("l_partkey").alias("id"), F.year("l_shipdate").alias("shipped_year"))
            .agg(
                F.sum("l_quantity").cast("int").alias("stock"),
                (F.max("l_quantity") / 10).cast("double").alias("rating"),
                F.max("l_shipdate").cast("date").alias("ingestion_date"),
            )
            .drop("shipped_year")
        )
        return self.product_records().join(per_year, "id")

    def history_products(self) -> DataFrame:
        size = F.col("p_size")
        return self.table("part").select(
            surrogate_key(PRODUCT_NAMESPACE, F.col("p_partkey")).alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            F.length(F.concat_ws(" ", "p_name", "p_brand", "p_type")).alias(
                "product_description_lenght"
            ),
            F.size(F.split("p_name", " ")).alias("product_photos_qty"),
            size.alias("product_weight_g"),
            (size / 2).cast("double").alias("product_length_cm"),
            (size / 4).cast("double").alias("product_height_cm"),
            (size * 2).cast("double").alias("product_width_cm"),
        )

    # --- reviews --------------------------------------------------------------------

    def reviews(self) -> DataFrame:
        return self.table("events").select(
            _text("event_id").alias("review_id"),
            F.col("value").cast(MONEY).alias("review_score"),
            F.col("ts").cast("timestamp").alias("review_creation_date"),
        )


def _between(df: DataFrame, column: str, start: str | None, end: str | None) -> DataFrame:
    """Half-open range on the stored column, so that it reaches the scan."""
    if start is not None:
        df = df.where(F.col(column) >= _instant(start))
    if end is not None:
        df = df.where(F.col(column) < _instant(end))
    return df


def with_year_text(orders: DataFrame) -> DataFrame:
    return orders.withColumn(
        "order_purchase_year", F.year("order_purchase_timestamp").cast("string")
    )


def as_history(df: DataFrame, moment: str) -> DataFrame:
    """History as landed: no load date, but the path columns of its bronze layout."""
    return df.drop("ingestion_date").withColumns({"year": F.year(moment), "month": F.month(moment)})
