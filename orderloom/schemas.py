"""Table contracts. Column names and order are fixed values; types are ours for money."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(28, 2)
MONEY_TOTAL = T.DecimalType(38, 2)

_NAMES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "money": MONEY,
    "money_sum": MONEY_SUM,
    "boolean": T.BooleanType(),
    # Compares as the deliveries arrived.
    "delivery": T.StructType(
        [
            T.StructField("at", T.TimestampType()),
            T.StructField("pull", T.LongType()),
            T.StructField("name", T.StringType()),
        ]
    ),
}


def struct(*columns: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _NAMES[kind]) for name, kind in columns])


def extend(base: T.StructType, *columns: tuple[str, str]) -> T.StructType:
    return T.StructType(base.fields + struct(*columns).fields)


# --- daily (bronze) tables: what a day's delivery holds --------------------------------

DAILY_CUSTOMERS = struct(
    ("customer_id", "string"),
    ("customer_unique_id", "string"),
    ("first_name", "string"),
    ("last_name", "string"),
    ("email", "string"),
    ("phone", "string"),
    ("customer_zip_code_prefix", "string"),
    ("customer_city", "string"),
    ("customer_state", "string"),
    ("ingestion_date", "date"),
)

DAILY_PRODUCTS = struct(
    ("product_id", "string"),
    ("product_category_name", "string"),
    ("product_name_length", "int"),
    ("product_description_length", "int"),
    ("product_photos_qty", "int"),
    ("product_weight_g", "int"),
    ("product_length_cm", "double"),
    ("product_height_cm", "double"),
    ("product_width_cm", "double"),
    ("price", "money"),
    ("stock", "int"),
    ("rating", "double"),
    ("ingestion_date", "date"),
)

DAILY_ORDERS = struct(
    ("order_id", "string"),
    ("customer_id", "string"),
    ("order_status", "string"),
    ("order_purchase_timestamp", "timestamp"),
    ("order_approved_at", "timestamp"),
    ("order_delivered_carrier_date", "timestamp"),
    ("order_delivered_customer_date", "timestamp"),
    ("order_estimated_delivery_date", "timestamp"),
    ("ingestion_date", "date"),
)

DAILY_ORDER_ITEMS = struct(
    ("order_id", "string"),
    ("order_item_id", "int"),
    ("product_id", "string"),
    ("seller_id", "string"),
    ("shipping_limit_date", "timestamp"),
    ("price", "money"),
    ("freight_value", "money"),
    ("ingestion_date", "date"),
)

DAILY_PAYMENTS = struct(
    ("order_id", "string"),
    ("payment_sequential", "int"),
    ("payment_type", "string"),
    ("payment_installments", "int"),
    ("payment_value", "money"),
    ("ingestion_date", "date"),
)

# The year an order was placed; its items and payments carry the same.
ORDER_YEAR = "order_purchase_year"

# --- silver tables: daily columns plus what the load derives ---------------------------

SILVER_CUSTOMERS = DAILY_CUSTOMERS
SILVER_PRODUCTS = DAILY_PRODUCTS
SILVER_ORDERS = extend(DAILY_ORDERS, ("order_purchase_year", "int"))
SILVER_ORDER_ITEMS = extend(
    DAILY_ORDER_ITEMS, ("order_purchase_timestamp", "timestamp"), ("order_purchase_year", "int")
)
SILVER_PAYMENTS = extend(
    DAILY_PAYMENTS, ("order_purchase_timestamp", "timestamp"), ("order_purchase_year", "int")
)

# --- warehouse tables: typed targets of the by-name load --------------------------------


def retype(schema: T.StructType, **kinds: str) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, _NAMES[kinds[f.name]] if f.name in kinds else f.dataType) for f in schema]
    )


WAREHOUSE = {
    "customers": retype(SILVER_CUSTOMERS, customer_zip_code_prefix="int"),
    "orders": retype(SILVER_ORDERS, order_purchase_year="string"),
    "order_items": retype(SILVER_ORDER_ITEMS, order_purchase_year="string"),
    "products": SILVER_PRODUCTS,
    "payments": retype(SILVER_PAYMENTS, order_purchase_year="string"),
}

# --- gold --------------------------------------------------------------------------------

FACT_KEYS = ["order_id", "product_id"]
FACT_MEASURES = ["price", "freight_value", "payment_value", "payment_type", "payment_installments"]

FACT_ORDERS = struct(
    ("order_id", "string"),
    ("customer_id", "string"),
    ("product_id", "string"),
    ("order_purchase_timestamp", "timestamp"),
    ("order_purchase_year", "string"),
    ("price", "money"),
    ("freight_value", "money"),
    ("payment_value", "money_sum"),
    ("payment_type", "string"),
    ("payment_installments", "int"),
)

DIM_CUSTOMERS = [
    "customer_id",
    "customer_city",
    "customer_state",
    "first_name",
    "last_name",
    "email",
    "phone",
]
DIM_PRODUCTS = ["product_id", "product_category_name", "price", "rating", "stock"]
