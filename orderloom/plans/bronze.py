"""API records to daily tables."""

from __future__ import annotations

import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.keys import (
    CUSTOMER_NAMESPACE,
    PRODUCT_NAMESPACE,
    surrogate_key,
    text_key,
)
from orderloom.functions.scalars import list_length
from orderloom.schemas import DAILY_CUSTOMERS, DAILY_PRODUCTS, struct
from orderloom.session import run_together
from orderloom.sinks.parquet import write_flat, write_load_date
from orderloom.sinks.state import load_state, save_state
from orderloom.sources.paging import Cursor, PagedSource, advance, cursors_from, page, state_from
from orderloom.sources.routing import DatasetSpec

# Historical datasets. Time columns arrive as text; only the partition column is parsed.
# Dataset names and partition columns.
DATASETS = [
    DatasetSpec(
        "customers.csv",
        "customers",
        struct(
            ("customer_id", "string"),
            ("customer_unique_id", "string"),
            ("customer_zip_code_prefix", "string"),
            ("customer_city", "string"),
            ("customer_state", "string"),
        ),
    ),
    DatasetSpec(
        "orders.csv",
        "orders",
        struct(
            ("order_id", "string"),
            ("customer_id", "string"),
            ("order_status", "string"),
            ("order_purchase_timestamp", "string"),
            ("order_approved_at", "string"),
            ("order_delivered_carrier_date", "string"),
            ("order_delivered_customer_date", "string"),
            ("order_estimated_delivery_date", "string"),
        ),
        partition_column="order_purchase_timestamp",
    ),
    DatasetSpec(
        "order_items.csv",
        "order_items",
        struct(
            ("order_id", "string"),
            ("order_item_id", "int"),
            ("product_id", "string"),
            ("seller_id", "string"),
            ("shipping_limit_date", "string"),
            ("price", "money"),
            ("freight_value", "money"),
        ),
        partition_column="shipping_limit_date",
    ),
    DatasetSpec(
        "payments.csv",
        "payments",
        struct(
            ("order_id", "string"),
            ("payment_sequential", "int"),
            ("payment_type", "string"),
            ("payment_installments", "int"),
            ("payment_value", "money"),
        ),
    ),
    DatasetSpec(
        "products.csv",
        "products",
        struct(
            ("product_id", "string"),
            ("product_category_name", "string"),
            ("product_name_lenght", "int"),
            ("product_description_lenght", "int"),
            ("product_photos_qty", "int"),
            ("product_weight_g", "int"),
            ("product_length_cm", "double"),
            ("product_height_cm", "double"),
            ("product_width_cm", "double"),
        ),
    ),
    DatasetSpec(
        "reviews.csv",
        "reviews",
        struct(
            ("review_id", "string"),
            ("review_score", "money"),
            ("review_creation_date", "string"),
        ),
        partition_column="review_creation_date",
    ),
    DatasetSpec("geolocation.csv", "geolocation", excluded=True),
    DatasetSpec("sellers.csv", "sellers", excluded=True),
    DatasetSpec("category_translation.csv", "category_translation", excluded=True),
]

# Nested record layout as delivered by the API.
USER_RECORD = (
    "id BIGINT, username STRING, firstName STRING, lastName STRING, email STRING, phone STRING, "
    "address STRUCT<city: STRING, state: STRING, postalCode: STRING>"
)


def _contract(df: DataFrame, names: list[str]) -> DataFrame:
    """The contract's columns; the load date is kept when the records carry one."""
    return df.select(*[c for c in names if c != "ingestion_date" or c in df.columns])


def customers_from_users(users: DataFrame) -> DataFrame:
    named = users.withColumns(
        {
            "customer_id": surrogate_key(CUSTOMER_NAMESPACE, F.col("id")),
            "customer_unique_id": text_key(F.col("username")),
            "customer_city": F.col("address.city"),
            "customer_state": F.col("address.state"),
            "customer_zip_code_prefix": F.col("address.postalCode"),
            "first_name": F.col("firstName"),
            "last_name": F.col("lastName"),
        }
    )
    return _contract(named, DAILY_CUSTOMERS.names)


def products_from_records(records: DataFrame) -> DataFrame:
    named = records.withColumns(
        {
            "product_id": surrogate_key(PRODUCT_NAMESPACE, F.col("id")),
            "product_category_name": F.col("category"),
            "product_name_length": F.length("title"),
            "product_description_length": F.length("description"),
            "product_photos_qty": list_length(F.col("images")),
            "product_weight_g": F.col("weight"),
            "product_length_cm": F.col("dimensions.depth"),
            "product_height_cm": F.col("dimensions.height"),
            "product_width_cm": F.col("dimensions.width"),
        }
    )
    return _contract(named, DAILY_PRODUCTS.names)


def pull_pages(
    spark: SparkSession, sources: list[PagedSource], lake: str, day: datetime.date
) -> list[str]:
    """One run: land the next page of every source that is not exhausted.

    Returns the datasets that got a page. Each pull has a folder of its own under its day, named
    by the cursor's offset. The cursors are saved after all pages are written; a run that fails
    before that pulls the same pages again and replaces those folders only.
    """
    state_root = f"{lake}/control/cursors"
    start = state_from(spark, {s.name: Cursor(s.name) for s in sources})
    cursors = cursors_from(load_state(spark, state_root, start))

    def pull(source: PagedSource) -> Cursor | None:
        cursor = cursors.get(source.name, Cursor(source.name))
        rows = page(source, cursor)
        if rows is None:
            return None
        records = f"{lake}/bronze/pages/{source.name}"
        write_flat(rows, records)
        pulled = spark.read.schema(source.table.schema).parquet(records)
        target = f"{lake}/bronze/daily/{source.dataset}"
        write_load_date(source.transform(pulled), target, day, run=cursor.offset)
        return advance(source, cursor, pulled)

    moved = run_together(*[partial(pull, source) for source in sources])
    cursors |= {cursor.source: cursor for cursor in moved if cursor is not None}
    save_state(state_from(spark, cursors), state_root)
    return [source.dataset for source, cursor in zip(sources, moved) if cursor is not None]
