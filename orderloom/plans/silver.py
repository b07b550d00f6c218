"""Bronze to silver: one incremental load for all five tables.

The daily deliveries are a stream of files: its checkpoint knows which files were taken, so rows
load whatever their date, late and undated ones too. A run writes one folder `batch_id=<n>` per
batch of files, which appears when it is complete. A stored key that is delivered again with other
content gets a further version; readers take the latest one, by load date and, of one date, by
delivery. Which delivery came later its files tell, so one run over two deliveries keeps what two
runs keep. An unchanged delivery writes nothing.

Dated tables are partitioned by purchase year inside a batch. Items and payments without a known
order wait in a log of their own, in which a load appends rows and removal marks. When an
order moves to another purchase time, its stored items and payments get a version with the new one.

A load meets stored rows by key only: it compares the rows of its own keys, before any of them are sorted. Of a
large table these come from an index in buckets of the key (`key_index`), which a load does not shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import schemas
from orderloom.functions.keys import packed, unpacked
from orderloom.operators.align import conform
from orderloom.operators.dedup import keep_first, newest_first
from orderloom.operators.enrich import rows_of_keys, with_order_time, with_purchase_year
from orderloom.operators.skew import join_one_per_key
from orderloom.operators.versions import latest_versions, new_versions
from orderloom.plans import key_index
from orderloom.sinks import keyed_log
from orderloom.sinks.folders import complete, current, drop, ensure, exists, move, publish
from orderloom.sinks.parquet import write_flat, write_in_place
from orderloom.sources.deliveries import DELIVERY, FILE, WRITTEN, with_delivery, with_files
from orderloom.streaming import retention
from orderloom.streaming.files import new_files

# Keys in hex, which are half as long on their way through an exchange.
LONG_KEYS = ["customer_id", "product_id"]
# The last batch of orders that a table's children met.
MET = schemas.struct(("orders_batch", "int"))
# The folder in which Spark writes the rows without a year.
UNDATED = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class SilverTable:
    name: str
    daily: T.StructType
    silver: T.StructType
    keys: list[str]
    renames: dict[str, str] = field(default_factory=dict)
    dated: bool = False
    child_of_orders: bool = False

    @property
    def arriving(self) -> T.StructType:
        return schemas.extend(self.daily, (DELIVERY, "delivery"))

    @property
    def stored(self) -> T.StructType:
        paths = [("partition_year", "int")] if self.dated else []
        return schemas.extend(self.silver, (DELIVERY, "delivery"), *paths, ("batch_id", "int"))

    @property
    def bucket_key(self) -> str:
        """The column whose values hold all versions of a key, and all children of an order."""
        return "order_id" if self.dated else self.keys[0]


PRODUCTS = SilverTable(
    "products",
    schemas.DAILY_PRODUCTS,
    schemas.SILVER_PRODUCTS,
    ["product_id"],
    # The history misspells these columns.
    renames={
        "product_name_lenght": "product_name_length",
        "product_description_lenght": "product_description_length",
    },
)
CUSTOMERS = SilverTable(
    "customers", schemas.DAILY_CUSTOMERS, schemas.SILVER_CUSTOMERS, ["customer_id"]
)
ORDERS = SilverTable(
    "orders", schemas.DAILY_ORDERS, schemas.SILVER_ORDERS, ["order_id"], dated=True
)
ORDER_ITEMS = SilverTable(
    "order_items",
    schemas.DAILY_ORDER_ITEMS,
    schemas.SILVER_ORDER_ITEMS,
    ["order_id", "order_item_id"],
    dated=True,
    child_of_orders=True,
)
PAYMENTS = SilverTable(
    "payments",
    schemas.DAILY_PAYMENTS,
    schemas.SILVER_PAYMENTS,
    ["order_id", "payment_sequential"],
    dated=True,
    child_of_orders=True,
)


def _root(lake: str, table: SilverTable) -> str:
    return f"{lake}/silver/{table.name}"


def _batches(spark: SparkSession, lake: str, table: SilverTable) -> list[int]:
    return complete(spark, _root(lake, table), "batch_id")


def _stored(
    spark: SparkSession, lake: str, table: SilverTable, after: int = -1
) -> DataFrame:
    """All versions of all complete batches after a given one."""
    root = _root(lake, table)
    done = [n for n in _batches(spark, lake, table) if n > after]
    if not done:
        return spark.createDataFrame([], table.stored)
    folders = [f"{root}/batch_id={n}" for n in done]
    return spark.read.schema(table.stored).option("basePath", root).parquet(*folders)


def read_silver(
    spark: SparkSession, lake: str, table: SilverTable, of_orders: DataFrame | None = None
) -> DataFrame:
    """The latest version of each key; with `of_orders`, which holds an order_id once, those of its orders, beside
    its columns: all versions meet their order first, as they are then chosen from without another exchange."""
    rows = _stored(spark, lake, table)
    long_keys = [name for name in LONG_KEYS if name not in table.keys]
    # Within one batch a key occurs once.
    several = len(_batches(spark, lake, table)) > 1

    def latest(versions: DataFrame) -> DataFrame:
        return unpacked(latest_versions(versions, table.keys) if several else versions, *long_keys)

    rows = packed(rows, *long_keys)
    found = latest(rows) if of_orders is None else join_one_per_key(rows, of_orders, ["order_id"], then=latest)
    return found.drop(DELIVERY)


def _versions(
    spark: SparkSession, lake: str, table: SilverTable, of: DataFrame | None = None
) -> DataFrame:
    """The index of all stored versions; with `of`, those that share its column, the bucket key."""
    index = key_index.of_table(lake, table)
    return index.read(spark, lambda after: _stored(spark, lake, table, after), of)


def _waiting_root(lake: str, table: SilverTable) -> str:
    return f"{lake}/waiting/{table.name}"


def _waiting(
    spark: SparkSession, lake: str, table: SilverTable, of: DataFrame | None = None
) -> DataFrame:
    return keyed_log.read(spark, _waiting_root(lake, table), table.arriving, table.keys, of)


def pending(spark: SparkSession, lake: str, table: SilverTable) -> DataFrame:
    """Children still without an order."""
    return _waiting(spark, lake, table).drop(DELIVERY)


def _one_per_key(rows: DataFrame, table: SilverTable) -> DataFrame:
    return keep_first(rows, table.keys, newest_first(table.daily.names, delivery=DELIVERY))


def _order_ids(rows: DataFrame) -> DataFrame:
    return rows.select("order_id").distinct()


def _moved_children(
    spark: SparkSession, lake: str, table: SilverTable, met: int
) -> DataFrame:
    """Stored children whose order has another purchase time since they met it."""
    columns = ["order_id", "order_purchase_timestamp", "ingestion_date", DELIVERY, "batch_id"]
    recent = _stored(spark, lake, ORDERS, after=met).select(*columns)
    versions = _versions(spark, lake, ORDERS, of=_order_ids(recent))
    was = latest_versions(versions.where(F.col("batch_id") <= met), ORDERS.keys)
    now = latest_versions(versions, ORDERS.keys).select("order_id", "order_purchase_timestamp")
    moved = was.select("order_id", F.col("order_purchase_timestamp").alias("_was")).join(now, "order_id")
    moved = moved.where("order_purchase_timestamp <> _was").select("order_id", F.year("_was").alias("_year"))
    # The latest version of a child lies under the year its order had; as literals the years prune.
    years = [row[0] for row in moved.select("_year").distinct().collect()]
    stored = _stored(spark, lake, table).where(F.col("partition_year").isin(years))
    children = rows_of_keys(stored, moved, ["order_id"])
    return latest_versions(children, table.keys).select(*table.arriving.names)


def _met(spark: SparkSession, lake: str, table: SilverTable) -> int | None:
    saved = current(spark, f"{lake}/control/met/{table.name}", MET)
    return None if saved is None else saved.first()["orders_batch"]


def _meet_orders(
    spark: SparkSession, lake: str, table: SilverTable, incoming: DataFrame, work: str
) -> tuple[DataFrame, DataFrame | None]:
    """Children with the time of their order, those without one included, and those of them that
    have waited before; written out once, by year.

    Of several copies of a child (delivered, waiting, stored under an order that moved) the one
    of the latest date and delivery counts. It is chosen after the join, where an order's rows lie together.
    """
    met, first_load = _met(spark, lake, table), not _batches(spark, lake, table)
    order_batches = _batches(spark, lake, ORDERS)
    has_new_orders = bool(order_batches) and (met is None or order_batches[-1] > met)
    rows, waited = incoming.select(*table.arriving.names), None
    if not keyed_log.is_empty(spark, _waiting_root(lake, table)):
        touched_ids = None
        if met is not None:
            new_orders = _order_ids(_stored(spark, lake, ORDERS, after=met))
            touched_ids = _order_ids(incoming).union(new_orders).distinct()
        write_flat(_waiting(spark, lake, table, of=touched_ids), f"{work}/waited", "zstd")
        waited = spark.read.schema(table.arriving).parquet(f"{work}/waited")
        rows = rows.unionByName(waited)
    if met is not None and has_new_orders and not first_load:
        rows = rows.unionByName(_moved_children(spark, lake, table, met))
    versions = _versions(spark, lake, ORDERS, of=None if first_load else _order_ids(rows))
    orders = versions if len(order_batches) < 2 else latest_versions(versions, ORDERS.keys)

    def chosen(joined: DataFrame) -> DataFrame:
        return _one_per_key(unpacked(joined, *LONG_KEYS), table)

    _write_dated(with_order_time(packed(rows, *LONG_KEYS), orders, then=chosen), f"{work}/dated", table)
    return spark.read.schema(table.stored).parquet(f"{work}/dated").drop("batch_id"), waited


def _write_dated(rows: DataFrame, path: str, table: SilverTable) -> None:
    write_in_place(rows.select(*table.silver.names, DELIVERY, "partition_year"), path, "partition_year")


def _write_batch(
    spark: SparkSession, root: str, table: SilverTable, rows: DataFrame, batch_id: int
) -> list[int]:
    """Write beside the batches, then move into place: readers and streams see whole batches."""
    unfinished = f"{root}/_unfinished"
    if table.dated:
        _write_dated(rows, unfinished, table)
    else:
        write_flat(rows.select(*table.silver.names, DELIVERY), unfinished)
    if batch_id and spark.read.schema(table.silver).parquet(unfinished).isEmpty():
        drop(spark, unfinished)
        return []
    move(spark, unfinished, f"{root}/batch_id={batch_id}")
    return [batch_id]


def _set_apart(spark: SparkSession, dated: str, target: str, table: SilverTable) -> DataFrame:
    """Move the staged children without an order out of a folder; the moved rows."""
    undated = f"{dated}/partition_year={UNDATED}"
    if not exists(spark, undated):
        return spark.createDataFrame([], table.arriving)
    ensure(spark, target.rsplit("/", 1)[0])
    move(spark, undated, target)
    return spark.read.schema(table.arriving).parquet(target)


def _store(
    spark: SparkSession, lake: str, table: SilverTable, incoming: DataFrame, work: str
) -> list[int]:
    """Store what is new in a batch of rows; the batch number, if there was anything."""
    root, done = _root(lake, table), _batches(spark, lake, table)
    if table.child_of_orders:
        order_batches = _batches(spark, lake, ORDERS)
        dated, waited = _meet_orders(spark, lake, table, incoming, work)
        rows = dated.where(F.col("partition_year").isNotNull())
        still = dated.where(F.col("partition_year").isNull()).select(*table.arriving.names)
    elif table.dated:
        # An undated copy must not stand in for a dated one, so it goes before the choice.
        dated = with_purchase_year(incoming).where(F.col("partition_year").isNotNull())
        rows = _one_per_key(dated, table)
    else:
        rows = _one_per_key(incoming, table)
    if done:
        versions = _versions(spark, lake, table, of=rows.select(table.bucket_key).distinct())
        rows = new_versions(rows, versions, table.keys, table.silver.names, LONG_KEYS)
    if table.child_of_orders and not done:
        # All that has an order is new, and lies as a batch does: it is not written again.
        still = _set_apart(spark, f"{work}/dated", f"{work}/undated", table)
        move(spark, f"{work}/dated", f"{root}/batch_id=0")
        written = [0]
    else:
        written = _write_batch(spark, root, table, rows, done[-1] + 1 if done else 0)
    key_index.of_table(lake, table).fold_if_due(
        spark, _batches(spark, lake, table), root, lambda after: _stored(spark, lake, table, after)
    )
    if table.child_of_orders:
        added, gone = still, still.where("false").select(*table.keys)
        if waited is not None:
            added, gone = still.subtract(waited), waited.subtract(still).select(*table.keys)
        keyed_log.append(spark, _waiting_root(lake, table), table.arriving, table.keys, added, gone)
        met = order_batches[-1] if order_batches else None
        state = spark.createDataFrame([(met,)], MET)
        publish(state.coalesce(1), f"{lake}/control/met/{table.name}")
        for staged in ("waited", "dated", "undated"):
            drop(spark, f"{work}/{staged}")
    return written


def _has_orders_to_meet(spark: SparkSession, lake: str, table: SilverTable) -> bool:
    if not table.child_of_orders:
        return False
    batches, met = _batches(spark, lake, ORDERS), _met(spark, lake, table)
    return bool(batches) and (met is None or batches[-1] > met)


def load(
    spark: SparkSession,
    lake: str,
    table: SilverTable,
    history: DataFrame,
    daily: str,
    files_per_batch: int | None = None,
    archive: retention.Archive | None = None,
) -> list[int]:
    """Load the history once and the files that are new in the folder `daily`.

    Returns the numbers of the batches written. A crash repeats the batch of files it
    interrupted, and rows that were stored by then are not new any more. With an archive, the files
    of committed batches move there, and the checkpoint is replaced from time to time.
    """
    work = f"{lake}/work/silver/{table.name}"
    checkpoints = f"{work}/checkpoint"
    rolled = retention.roll_of(spark, checkpoints)
    written: list[int] = []

    def store(incoming: DataFrame) -> None:
        if not _batches(spark, lake, table):
            renamed = history.withColumnsRenamed(table.renames)
            incoming = conform(renamed, table.arriving).unionByName(incoming)
        written.extend(_store(spark, lake, table, incoming, work))

    taken: list[int] = []
    names: list[str] = []

    def take(batch: DataFrame, epoch: int) -> None:
        # Read once: what follows uses it several times, on the caller's session.
        write_flat(batch, f"{work}/files", "zstd")
        rows = spark.read.schema(batch.schema).parquet(f"{work}/files")
        store(with_delivery(rows).select(*table.arriving.names))
        if archive is not None:
            # One name per file of the batch, which the stream has listed.
            names.extend(r[FILE] for r in rows.select(FILE).distinct().toLocalIterator())
        drop(spark, f"{work}/files")
        taken.append(epoch)

    ensure(spark, daily)
    files = with_files(new_files(spark, daily, table.daily, files_per_batch))
    query = (
        # Without what the names of folders would add.
        files.select(*table.daily.names, FILE, WRITTEN)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", retention.checkpoint(checkpoints, rolled))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    first_load = not _batches(spark, lake, table)
    if not taken and (first_load or _has_orders_to_meet(spark, lake, table)):
        store(spark.createDataFrame([], table.arriving))
    if archive is not None and taken:
        retention.put_away(spark, daily, names, f"{archive.root}/{rolled}-{taken[-1]}")
        if taken[-1] + 1 >= archive.roll_after:
            retention.roll(spark, checkpoints, rolled)
    return written
