"""One run of everything: silver, then the typed warehouse tables, then gold."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom.functions.keys import packed, unpacked
from orderloom.operators.versions import latest_versions
from orderloom.plans import silver
from orderloom.schemas import DIM_CUSTOMERS, DIM_PRODUCTS, ORDER_YEAR, WAREHOUSE, extend
from orderloom.session import for_many_steps, run_together
from orderloom.sources.deliveries import DELIVERY
from orderloom.streaming.autoload import autoload, read_rejects
from orderloom.streaming.dimension import read_dimension, refresh_dimension
from orderloom.streaming.fact import refresh_fact
from orderloom.streaming.retention import Archive

ENTITIES = [silver.PRODUCTS, silver.CUSTOMERS, silver.ORDERS]
CHILDREN = [silver.ORDER_ITEMS, silver.PAYMENTS]
DIMENSIONS = {"products": DIM_PRODUCTS, "customers": DIM_CUSTOMERS}
TABLES = {table.name: table for table in [*ENTITIES, *CHILDREN]}

# The history of each silver table, and the folder its daily deliveries arrive in, by name.
Feeds = dict[str, tuple[DataFrame, str]]


def load_silver(
    spark: SparkSession,
    lake: str,
    feeds: Feeds,
    files_per_batch: int | None = None,
    archive: Archive | None = None,
) -> None:
    """All five tables; items and payments need the stored orders, so they come second."""

    def load(table: silver.SilverTable) -> None:
        kept = None if archive is None else archive.below(table.name)
        silver.load(spark, lake, table, *feeds[table.name], files_per_batch, kept)

    for group in (ENTITIES, CHILDREN):
        run_together(*[partial(load, table) for table in group])


def _stored(name: str) -> T.StructType:
    """A warehouse table keeps its versions, told apart by delivery and batch."""
    return extend(WAREHOUSE[name], (DELIVERY, "delivery"), ("batch_id", "int"))


def load_warehouse_table(
    spark: SparkSession, lake: str, table: silver.SilverTable, files_per_batch: int | None = None
) -> StreamingQuery:
    """New silver files of one table into its warehouse table, unfit values beside their rows."""
    return autoload(
        spark,
        f"{lake}/silver/{table.name}",
        table.stored,
        _stored(table.name),
        warehouse_path(lake, table.name),
        f"{lake}/checkpoints/{table.name}",
        partition_by=ORDER_YEAR if table.dated else None,
        files_per_batch=files_per_batch,
        rejects=True,
    )


def warehouse_rejects(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """The values that did not fit a warehouse table, with their silver files."""
    return read_rejects(spark, warehouse_path(lake, name))


def warehouse_path(lake: str, name: str) -> str:
    return f"{lake}/warehouse/{name}"


def _versions(spark: SparkSession, lake: str, name: str) -> DataFrame:
    return spark.read.schema(_stored(name)).parquet(warehouse_path(lake, name))


def read_warehouse(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """The latest version of each key."""
    long_keys = [key for key in silver.LONG_KEYS if key not in TABLES[name].keys]
    latest = latest_versions(packed(_versions(spark, lake, name), *long_keys), TABLES[name].keys)
    return unpacked(latest, *long_keys).select(*WAREHOUSE[name].names)


def refresh_gold(
    spark: SparkSession,
    lake: str,
    files_per_batch: int | None = None,
    fact_buckets: int | None = None,
) -> None:
    """Merge what changed into the fact and the dimensions."""
    changing = {
        name: (warehouse_path(lake, name), _stored(name))
        for name in ("orders", "order_items", "payments")
    }
    root, work = f"{lake}/gold/fact_orders", f"{lake}/work/fact_orders"
    refresh_fact(spark, changing, root, work, files_per_batch, fact_buckets)
    refresh_dimensions(spark, lake, files_per_batch)


def refresh_dimensions(
    spark: SparkSession, lake: str, files_per_batch: int | None = None
) -> None:
    """Append the rows of changed products and customers to their dimensions."""

    def refresh(name: str) -> None:
        refresh_dimension(
            spark,
            warehouse_path(lake, name),
            _stored(name),
            TABLES[name].keys[0],
            DIMENSIONS[name],
            f"{lake}/gold/dim_{name}",
            f"{lake}/work/dim_{name}",
            files_per_batch,
        )

    run_together(*[partial(refresh, name) for name in DIMENSIONS])


def dimension(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """The stored dimension of products or customers."""
    root = f"{lake}/gold/dim_{name}"
    return read_dimension(spark, root, _stored(name), TABLES[name].keys[0], DIMENSIONS[name])


def run(
    spark: SparkSession,
    lake: str,
    feeds: Feeds,
    files_per_batch: int | None = None,
    fact_buckets: int | None = None,
    archive: Archive | None = None,
) -> None:
    with for_many_steps(spark):
        load_silver(spark, lake, feeds, files_per_batch, archive)
        run_together(
            *[partial(load_warehouse_table, spark, lake, t, files_per_batch) for t in TABLES.values()]
        )
        refresh_gold(spark, lake, files_per_batch, fact_buckets)
