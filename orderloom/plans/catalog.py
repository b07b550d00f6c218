"""The registered queries. Each takes (spark, sf_dir) and runs over whole tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from decimal import Decimal
from functools import partial, reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.functions.scalars import lenient_timestamp
from orderloom.operators import marks
from orderloom.operators.align import align_union, bad_values, conform
from orderloom.operators.dedup import keep_first, newest_first
from orderloom.operators.groups import with_group_measures
from orderloom.plans import analytics, bronze, fact_store, gold, runs, silver
from orderloom.session import for_many_steps, new_folder, prepare, run_together
from orderloom.sinks.folders import current, publish
from orderloom.sinks.parquet import (
    write_flat,
    write_load_date,
    write_partitioned,
)
from orderloom.sources.files import (
    read_json,
    read_parquet_dir,
    read_parquet_or_none,
)
from orderloom.sources.paging import PRODUCTS_PER_RUN, USERS_PER_RUN, PagedSource
from orderloom.sources.roles import (
    DAILY_START,
    SECOND_BATCH,
    Roles,
    as_history,
    with_year_text,
)
from orderloom.sources.routing import DatasetSpec, land, malformed_path, route
from orderloom.streaming.changes import on_change
from orderloom.streaming.fact import refresh_fact
from orderloom.streaming.retention import Archive

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Callable[[SparkSession, Roles], DataFrame]) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark, sf_dir)
        return function(spark, Roles(spark, sf_dir))

    QUERIES[function.__name__] = run
    return run


# --- bronze --------------------------------------------------------------------------------


@query
def csv_roundtrip_customers(spark, roles):
    lake = new_folder(spark, "csv")
    spec = route("customers.csv", bronze.DATASETS)
    roles.history_customers().write.csv(f"{lake}/source/{spec.file}", header=True)
    return spark.read.parquet(land(spark, spec, f"{lake}/source", f"{lake}/bronze"))


@query
def csv_malformed_rows(spark, roles):
    """Orders as CSV, of which some rows lack their last field or have one too many."""
    lake = new_folder(spark, "malformed")
    kind = F.col("o_orderkey") % 11
    fields = [F.col(c).cast("string") for c in ("o_orderkey", "o_custkey")]
    status = F.when(kind == 0, F.lit(None)).otherwise(F.col("o_orderstatus"))
    extra = F.when(kind == 1, F.lit("extra"))
    lines = roles.table("orders").select(F.concat_ws(",", *fields, status, extra).alias("order_id,customer_id,status"))
    # The lines as they are, below their header: nothing is quoted or split.
    lines.write.csv(f"{lake}/source/orders.csv", header=True, sep="\u0001", quote="\u0000", escape="\u0000")
    schema = schemas.struct(("order_id", "bigint"), ("customer_id", "bigint"), ("status", "string"))
    land(spark, DatasetSpec("orders.csv", "orders", schema), f"{lake}/source", f"{lake}/bronze")
    listed = spark.read.parquet(malformed_path(f"{lake}/bronze", "orders"))
    landed = spark.read.parquet(f"{lake}/bronze/orders").groupBy("status").count()
    return listed.select(F.lit("malformed").alias("kind"), "record", F.lit(1).cast("bigint").alias("rows")).unionByName(
        landed.select(F.lit("landed").alias("kind"), F.col("status").alias("record"), F.col("count").alias("rows"))
    )


def _order_date_texts(roles: Roles) -> DataFrame:
    """Purchase dates as text: three ISO layouts, two declared ones and two unreadable ones."""
    date, kind = F.col("o_orderdate"), F.col("o_orderkey") % 7
    text = (
        F.when(kind == 0, F.date_format(date, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 1, F.date_format(date, "yyyy-MM-dd"))
        .when(kind == 2, F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == 3, F.date_format(date, "MM/dd/yyyy"))
        .when(kind == 4, F.date_format(date, "MMM d yyyy"))
        .when(kind == 5, F.lit("not specified"))
        .otherwise(F.date_format(date, "yyyy-'13'-dd"))
    )
    return roles.table("orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        text.alias("order_purchase_timestamp"),
        F.col("o_totalprice").cast(schemas.MONEY).alias("order_total"),
    )


LAYOUTS = ("MM/dd/yyyy", "MMM d yyyy")


@query
def lenient_timestamp_parse(spark, roles):
    texts = _order_date_texts(roles).drop("order_total")
    parsed = lenient_timestamp(F.col("order_purchase_timestamp"), LAYOUTS)
    return texts.withColumn("parsed", parsed)


@query
def bronze_partitioned_orders(spark, roles):
    lake = new_folder(spark, "year-month")
    texts = _order_date_texts(roles)
    texts.write.csv(f"{lake}/source/orders.csv", header=True)
    column = "order_purchase_timestamp"
    spec = DatasetSpec(
        "orders.csv", "orders", texts.schema, partition_column=column, timestamp_layouts=LAYOUTS
    )
    return (
        read_parquet_dir(spark, land(spark, spec, f"{lake}/source", f"{lake}/bronze"))
        .groupBy("year", "month")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("order_total").cast(schemas.MONEY_TOTAL).alias("order_total"),
        )
    )


@query
def bronze_load_date_partition(spark, roles):
    """Four runs: two days, a repeat of the second with more rows, and an empty batch."""
    path = f"{new_folder(spark, 'load-date')}/orders"
    orders = roles.table("orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").cast(schemas.MONEY).alias("order_total"),
        "o_orderdate",
    )
    start = F.lit(DAILY_START).cast("timestamp_ntz")
    early = orders.where(F.col("o_orderdate") < start)
    late = orders.where(F.col("o_orderdate") >= start)
    write_load_date(early, path, datetime.date(2001, 8, 1))
    write_load_date(late.where("order_status = 'F'"), path, datetime.date(2001, 8, 2))
    write_load_date(late, path, datetime.date(2001, 8, 2))
    write_load_date(late.where("order_status IS NULL"), path, datetime.date(2001, 8, 3))
    return (
        read_parquet_dir(spark, path)
        .groupBy("ingestion_date")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("order_total").cast(schemas.MONEY_TOTAL).alias("order_total"),
        )
    )


@query
def dataset_routing(spark, roles):
    """Land every source file by its spec; one line per dataset. Sources are many compressed files each."""
    lake = new_folder(spark, "routing")
    sources = {
        "customers.csv": roles.history_customers(),
        "orders.csv": roles.orders().drop("ingestion_date"),
        "order_items.csv": roles.order_items().drop("ingestion_date"),
        "payments.csv": roles.payments(),
        "products.csv": roles.history_products(),
        "reviews.csv": roles.reviews(),
        "geolocation.csv": roles.table("nation"),
        "sellers.csv": roles.table("supplier"),
        "category_translation.csv": roles.table("region"),
    }

    def deliver_and_land(file: str) -> str | None:
        # A compressed file is read by one task, so none is large.
        few = sources[file].write.option("maxRecordsPerFile", 500_000)
        few.csv(f"{lake}/source/{file}", header=True, compression="gzip")
        spec = route(file, bronze.DATASETS)
        return land(spark, spec, f"{lake}/source", f"{lake}/bronze")

    paths = run_together(*[partial(deliver_and_land, file) for file in sources])
    lines = []
    for file, path in zip(sources, paths):
        spec = route(file, bronze.DATASETS)
        if path is None:
            counts = spark.range(1).select(
                F.lit(0).cast("bigint").alias("rows_landed"), F.lit(0).cast("bigint").alias("months")
            )
        else:
            landed = spark.read.parquet(path)
            months = F.count_distinct("year", "month") if spec.partition_column else F.lit(0)
            counts = landed.agg(
                F.count(F.lit(1)).alias("rows_landed"), months.cast("bigint").alias("months")
            )
        lines.append(
            counts.select(
                F.lit(spec.name).alias("dataset"),
                F.lit(spec.action).alias("action"),
                F.lit(spec.partition_column).cast("string").alias("partition_column"),
                "rows_landed",
                "months",
            )
        )
    return reduce(DataFrame.unionByName, lines)


@query
def cursor_page(spark, roles):
    """Four runs from an absent cursor, two of them on one day; the regions run out."""
    lake = new_folder(spark, "pages")
    products = roles.product_records().withColumns(
        {"stock": F.lit(None).cast("int"), "rating": F.lit(None).cast("double")}
    )
    sources = [
        PagedSource(
            "users", roles.users(), "id", USERS_PER_RUN, "customers", bronze.customers_from_users
        ),
        PagedSource(
            "products", products, "id", PRODUCTS_PER_RUN, "products", bronze.products_from_records
        ),
        PagedSource("regions", roles.regions(), "id", 2, "regions", lambda rows: rows),
    ]
    for day in (1, 1, 2, 3):
        bronze.pull_pages(spark, sources, lake, datetime.date(2024, 1, day))
    landed = []
    for dataset, key in (("customers", "customer_id"), ("products", "product_id"), ("regions", "id")):
        rows = spark.read.parquet(f"{lake}/bronze/daily/{dataset}")
        landed.append(
            rows.select(
                F.lit(dataset).alias("dataset"),
                "ingestion_date",
                F.col("run").cast("int").alias("run"),
                F.col(key).cast("string").alias("key"),
            )
        )
    return reduce(DataFrame.unionByName, landed)


@query
def json_flatten_events(spark, roles):
    record = F.from_json("props", "k INT")
    return roles.table("events").withColumn("record", record).select(
        "event_id", "event_type", F.col("record.k").alias("k")
    )


@query
def customers_transform(spark, roles):
    """Users landed as nested JSON lines, read back by schema and flattened."""
    path = f"{new_folder(spark, 'json')}/users"
    roles.users().write.json(path)
    return bronze.customers_from_users(read_json(spark, path, bronze.USER_RECORD))


@query
def products_transform(spark, roles):
    return bronze.products_from_records(roles.product_deliveries())


# --- silver --------------------------------------------------------------------------------


@query
def high_water_mark(spark, roles):
    """Latest load date of two stored tables and of one that does not exist."""
    lake = new_folder(spark, "marks")
    write_flat(roles.orders().select("order_id", "ingestion_date"), f"{lake}/orders")
    write_flat(roles.order_items().select("order_id", "ingestion_date"), f"{lake}/order_items")
    names = ["orders", "order_items", "reviews"]
    found = [
        (name, marks.high_water_mark(read_parquet_or_none(spark, f"{lake}/{name}")))
        for name in names
    ]
    return spark.createDataFrame(found, "table_name STRING, mark DATE")


@query
def incremental_filter(spark, roles):
    """Daily orders after the mark of what was delivered before the second batch."""
    path = f"{new_folder(spark, 'daily')}/orders"
    daily = roles.orders_between(DAILY_START, None)
    write_partitioned(daily, path, "ingestion_date")
    mark = marks.high_water_mark(roles.orders_between(DAILY_START, SECOND_BATCH))
    stored = read_parquet_dir(spark, path, schemas.DAILY_ORDERS)
    return marks.newer_than(stored, mark).select("order_id", "customer_id", "ingestion_date")


@query
def align_union_products(spark, roles):
    return align_union(
        roles.history_products(),
        bronze.products_from_records(roles.product_deliveries()),
        silver.PRODUCTS.daily,
        silver.PRODUCTS.renames,
    )


def _item_columns(roles: Roles) -> DataFrame:
    return roles.order_items().select(
        "product_id", "order_id", "order_item_id", "seller_id", "shipping_limit_date", "price"
    )


@query
def dedup_single_key(spark, roles):
    items = _item_columns(roles)
    return keep_first(items, ["product_id"], newest_first(items.columns, "shipping_limit_date"))


@query
def dedup_composite_key(spark, roles):
    items = _item_columns(roles)
    keys = ["order_item_id", "order_id"]
    return keep_first(items, keys, newest_first(items.columns, "shipping_limit_date"))


def _histories(roles: Roles) -> dict[str, DataFrame]:
    return {
        "products": roles.history_products(),
        "customers": roles.history_customers(),
        "orders": as_history(roles.orders_between(None, DAILY_START), "order_purchase_timestamp"),
        "order_items": as_history(
            roles.order_items_between(None, DAILY_START), "shipping_limit_date"
        ),
        "payments": roles.payments_between(None, DAILY_START).drop("ingestion_date"),
    }


def _deliveries(roles: Roles, name: str, start: str, end: str | None) -> DataFrame:
    """What arrives of a table between two dates."""
    if name == "products":
        return bronze.products_from_records(roles.product_deliveries(start, end))
    if name == "customers":
        return bronze.customers_from_users(roles.user_deliveries(start, end))
    between = {
        "orders": roles.orders_between,
        "order_items": roles.order_items_between,
        "payments": roles.payments_between,
    }
    return between[name](start, end)


def _daily(lake: str, name: str) -> str:
    return f"{lake}/bronze/daily/{name}"


def _deliver(rows: DataFrame, lake: str, name: str, number: int) -> None:
    write_flat(rows, f"{_daily(lake, name)}/delivery={number}")


def _run_silver(
    spark, roles: Roles, lake: str, number: int, feeds: dict[str, DataFrame], archive: Archive | None = None
) -> None:
    """Deliver and load some tables, orders before what depends on them."""
    histories = _histories(roles)
    for name, rows in feeds.items():
        _deliver(rows, lake, name, number)
        table = runs.TABLES[name]
        silver.load(spark, lake, table, histories[name], _daily(lake, name), archive=archive)


def _single_run(spark, roles: Roles, *names: str) -> DataFrame:
    """The last of the tables after one run over the whole feeds."""
    lake = new_folder(spark, "silver")
    feeds = {name: _deliveries(roles, name, DAILY_START, None) for name in names}
    _run_silver(spark, roles, lake, 1, feeds)
    return silver.read_silver(spark, lake, runs.TABLES[names[-1]]).drop("batch_id")


_TWO_RUNS = ((DAILY_START, SECOND_BATCH), (SECOND_BATCH, None))


@query
def silver_products(spark, roles):
    return _single_run(spark, roles, "products")


@query
def silver_customers(spark, roles):
    return _single_run(spark, roles, "customers")


@query
def silver_orders(spark, roles):
    """Of some orders the newest copy has no purchase time."""
    lake = new_folder(spark, "silver")
    daily = _deliveries(roles, "orders", DAILY_START, None)
    undated = daily.where("order_status = 'F'").withColumns(
        {
            "order_purchase_timestamp": F.lit(None).cast("timestamp"),
            "ingestion_date": F.date_add("ingestion_date", 1),
        }
    )
    _run_silver(spark, roles, lake, 1, {"orders": daily.unionByName(undated)})
    return silver.read_silver(spark, lake, silver.ORDERS).drop("batch_id")


@query
def silver_order_items(spark, roles):
    return _single_run(spark, roles, "orders", "order_items")


@query
def silver_payments(spark, roles):
    return _single_run(spark, roles, "orders", "payments")


@query
def silver_orders_incremental(spark, roles):
    """Two runs. Open orders come again a year later as shipped, finished ones unchanged."""
    lake = new_folder(spark, "silver")
    daily = _deliveries(roles, "orders", DAILY_START, None)
    later = daily.withColumn("ingestion_date", F.date_add("ingestion_date", 365))
    shipped = later.where("order_status = 'P'").withColumn("order_status", F.lit("S"))
    feed = daily.unionByName(shipped).unionByName(later.where("order_status = 'F'"))
    second = F.col("ingestion_date") >= F.lit(SECOND_BATCH).cast("date")
    _run_silver(spark, roles, lake, 1, {"orders": feed.where(~second)})
    _run_silver(spark, roles, lake, 2, {"orders": feed.where(second)})
    return silver.read_silver(spark, lake, silver.ORDERS).drop("partition_year")


@query
def silver_same_day(spark, roles):
    """Some orders come twice on their load date with another status; the later delivery counts,
    whether one run takes both deliveries or each has a run of its own."""
    daily = _deliveries(roles, "orders", DAILY_START, None)
    number = F.col("order_id").cast("bigint")
    # Before and after the first status in the alphabet.
    status = F.when(number % 2 == 0, F.lit("A")).otherwise(F.lit("Z"))
    again = daily.where(number % 3 == 0).withColumn("order_status", status)
    results = []
    for runs_taken in (1, 2):
        lake = new_folder(spark, "silver")
        if runs_taken == 1:
            _deliver(daily, lake, "orders", 1)
        else:
            _run_silver(spark, roles, lake, 1, {"orders": daily})
        _run_silver(spark, roles, lake, 2, {"orders": again})
        stored = silver.read_silver(spark, lake, silver.ORDERS)
        results.append(
            stored.select(F.lit(runs_taken).alias("runs"), "order_id", "order_status", "ingestion_date")
        )
    return reduce(DataFrame.unionByName, results)


@query
def silver_products_incremental(spark, roles):
    """Two runs; a product's stock and rating change from one delivery to the next."""
    lake = new_folder(spark, "silver")
    for number, (start, end) in enumerate(_TWO_RUNS):
        feed = _deliveries(roles, "products", start, end)
        _run_silver(spark, roles, lake, number, {"products": feed})
    return silver.read_silver(spark, lake, silver.PRODUCTS)


@query
def late_dates_loaded(spark, roles):
    """The second run brings rows dated before what the first one brought, or not at all."""
    lake = new_folder(spark, "silver")
    daily = _deliveries(roles, "orders", DAILY_START, None)
    late = F.col("order_id").cast("bigint") % 5 == 0
    undated = F.col("order_id").cast("bigint") % 10 == 0
    date = F.when(~undated, F.col("ingestion_date"))
    _run_silver(spark, roles, lake, 1, {"orders": daily.where(~late)})
    _run_silver(
        spark, roles, lake, 2, {"orders": daily.where(late).withColumn("ingestion_date", date)}
    )
    return silver.read_silver(spark, lake, silver.ORDERS).select(
        "order_id", "order_status", "ingestion_date", "batch_id"
    )


@query
def silver_archived_deliveries(spark, roles):
    """Each run archives its deliveries and leaves an empty checkpoint; the second run's rows are dated
    before what the first one brought, and the third run brings the first one's again."""
    lake = new_folder(spark, "silver")
    daily = _deliveries(roles, "orders", DAILY_START, None)
    late = F.col("order_id").cast("bigint") % 7 == 0
    for number, rows in enumerate([daily.where(~late), daily.where(late), daily.where(~late)]):
        _run_silver(spark, roles, lake, number, {"orders": rows}, Archive(f"{lake}/archive", roll_after=1))
    return silver.read_silver(spark, lake, silver.ORDERS).select(
        "order_id", "order_status", "ingestion_date", "batch_id"
    )


def _repriced(items: DataFrame, parts: int, remainder: int, more: str) -> DataFrame:
    """Some orders' items once more, under their load date and with another price."""
    some = F.col("order_id").cast("bigint") % parts == remainder
    price = (F.col("price") + F.lit(Decimal(more))).cast(schemas.MONEY)
    return items.where(some & F.col("ingestion_date").isNotNull()).withColumn("price", price)


@query
def late_items_pending(spark, roles):
    """Two runs of orders and items; an item may arrive before or after its order.

    Of some orders every item comes again on the same day, and of others those of the first run
    come again in the second, with another price and the former date, stored or waiting. Per stored item: the
    run its latest version arrived in, the run of its order, the run that stored it, and whether
    a load that joins each batch to its own orders only would have kept it.
    """
    lake = new_folder(spark, "silver")
    first, second = [_deliveries(roles, "order_items", start, end) for start, end in _TWO_RUNS]
    more = [[_repriced(first, 4, 1, "1.00")], [_repriced(second, 4, 1, "1.00"), _repriced(first, 4, 3, "2.00")]]
    for number, (start, end) in enumerate(_TWO_RUNS):
        _run_silver(spark, roles, lake, number, {"orders": _deliveries(roles, "orders", start, end)})
        _deliver((first, second)[number], lake, "order_items", 10 * number)
        for again, rows in enumerate(more[number][:-1], 1):
            _deliver(rows, lake, "order_items", 10 * number + again)
        _run_silver(spark, roles, lake, 10 * number + 9, {"order_items": more[number][-1]})
    orders = silver.read_silver(spark, lake, silver.ORDERS)
    second = F.col("ingestion_date") >= F.lit(SECOND_BATCH).cast("date")
    arrival = F.when(second, 1).otherwise(0)
    order_batch = orders.select("order_id", F.col("batch_id").alias("order_batch"))
    return silver.read_silver(spark, lake, silver.ORDER_ITEMS, of_orders=order_batch).select(
        "order_id",
        "order_item_id",
        "product_id",
        "shipping_limit_date",
        "price",
        arrival.alias("arrival_batch"),
        "order_batch",
        F.col("batch_id").alias("landed_batch"),
        (arrival == F.col("order_batch")).cast("int").alias("kept_by_ref"),
    )


def _odd_customers(spark, roles: Roles) -> DataFrame:
    """Staged files with other letter case, one column missing, one extra, text for typed."""
    path = f"{new_folder(spark, 'stage')}/customers"
    zip_code = F.lpad(F.col("c_custkey").cast("string"), 5, "0")
    odd_zip = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(zip_code, F.lit("-x")))
    write_flat(
        roles.table("customer").select(
            F.col("c_custkey").alias("CUSTOMER_ID"),
            F.col("c_name").alias("Customer_Unique_Id"),
            F.col("c_mktsegment").alias("FIRST_NAME"),
            F.coalesce(odd_zip, zip_code).alias("CUSTOMER_ZIP_CODE_PREFIX"),
            F.lit("2001-02-03").alias("Ingestion_Date"),
            F.col("c_acctbal").alias("BALANCE"),
        ),
        path,
    )
    return read_parquet_dir(spark, path)


@query
def conform_by_name(spark, roles):
    return conform(_odd_customers(spark, roles), schemas.WAREHOUSE["customers"])


@query
def conform_rejects(spark, roles):
    """One row per value that the same load cannot fit into its type."""
    staged = _odd_customers(spark, roles)
    key = F.col("CUSTOMER_ID").cast("string").alias("customer_id")
    return bad_values(staged, schemas.WAREHOUSE["customers"], key)


# --- gold ----------------------------------------------------------------------------------


@query
def order_items_join(spark, roles):
    return gold.order_lines(roles.warehouse_orders(), roles.order_items())


@query
def order_items_payments_join(spark, roles):
    return gold.join_fan_out(roles.orders(), roles.order_items(), roles.payments())


@query
def payment_windows(spark, roles):
    return with_group_measures(
        roles.payments(),
        ["order_id"],
        {
            "order_payment_value": F.sum("payment_value").cast(schemas.MONEY_SUM),
            "order_payment_type": F.max("payment_type"),
            "order_payment_installments": F.max("payment_installments"),
        },
    )


def _fact(roles: Roles) -> DataFrame:
    return gold.fact_orders(roles.warehouse_orders(), roles.order_items(), roles.payments())


def _fact_ref(roles: Roles) -> DataFrame:
    return gold.fact_orders_ref(roles.warehouse_orders(), roles.order_items(), roles.payments())


@query
def fact_orders_ref(spark, roles):
    return _fact_ref(roles)


@query
def fact_orders(spark, roles):
    return _fact(roles)


@query
def fact_self_dedup(spark, roles):
    """A stored fact whose first load repeated its grain is repaired in place."""
    root = f"{new_folder(spark, 'gold')}/fact_orders"
    repeated = gold.paid_lines(roles.warehouse_orders(), roles.order_items(), roles.payments())
    fact_store.merge_fact(spark, root, repeated.select(*schemas.FACT_ORDERS.names), 0)
    fact_store.repair_fact(spark, root)
    return fact_store.read_fact(spark, root)


@query
def fact_merge(spark, roles):
    """Second batch of orders, items and payments merged onto the fact of the first."""
    root = f"{new_folder(spark, 'gold')}/fact_orders"
    first = gold.fact_orders(
        with_year_text(roles.orders_between(None, SECOND_BATCH)),
        roles.order_items_between(None, SECOND_BATCH),
        roles.payments_between(None, SECOND_BATCH),
    )
    fact_store.merge_fact(spark, root, first, 0)
    new_rows = [
        roles.orders_between(SECOND_BATCH, None),
        roles.order_items_between(SECOND_BATCH, None),
        roles.payments_between(SECOND_BATCH, None),
    ]
    changed = reduce(DataFrame.union, [rows.select("order_id") for rows in new_rows])
    tables = [roles.warehouse_orders(), roles.order_items(), roles.payments()]
    affected = gold.of_changed_orders(tables, changed, f"{root}/changed/batch_id=1")
    fact_store.merge_fact(spark, root, gold.fact_orders(*affected), 1)
    return fact_store.read_fact(spark, root)


@query
def dim_customers(spark, roles):
    root = f"{new_folder(spark, 'gold')}/dim_customers"
    daily = _deliveries(roles, "customers", DAILY_START, None)
    rows = align_union(roles.history_customers(), daily, silver.CUSTOMERS.daily)
    publish(gold.dim_customers(rows), root)
    return current(spark, root)


@query
def dim_products(spark, roles):
    root = f"{new_folder(spark, 'gold')}/dim_products"
    daily = _deliveries(roles, "products", DAILY_START, None)
    table = silver.PRODUCTS
    rows = align_union(roles.history_products(), daily, table.daily, table.renames)
    publish(gold.dim_products(rows), root)
    return current(spark, root)


# --- analytics -----------------------------------------------------------------------------


@query
def order_payment_total(spark, roles):
    return analytics.order_payment_total(roles.order_items())


@query
def shipping_limit(spark, roles):
    return analytics.shipping_limit(roles.orders())


@query
def total_revenue_ref(spark, roles):
    return analytics.total_revenue_ref(_fact_ref(roles))


@query
def total_revenue(spark, roles):
    return analytics.total_revenue(_fact(roles))


@query
def top_products(spark, roles):
    return analytics.top_products(_fact(roles))


@query
def top_products_k(spark, roles):
    return analytics.top_products(_fact(roles), k=10)


@query
def kept_totals(spark, roles):
    """Totals that two merges keep: orders of the second batch change or come, every fifth order goes."""
    root = f"{new_folder(spark, 'totals')}/fact_orders"
    first = [
        roles.orders_between(None, SECOND_BATCH),
        roles.order_items_between(None, SECOND_BATCH),
        roles.payments_between(None, SECOND_BATCH),
    ]
    first[0] = with_year_text(first[0])
    fact_store.merge_fact(spark, root, gold.fact_orders(*first), 0)
    fact_store.keep_totals(spark, root)
    new_rows = [
        roles.orders_between(SECOND_BATCH, None),
        roles.order_items_between(SECOND_BATCH, None),
        roles.payments_between(SECOND_BATCH, None),
    ]
    changed = reduce(DataFrame.union, [rows.select("order_id") for rows in new_rows])
    tables = [roles.warehouse_orders(), roles.order_items(), roles.payments()]
    affected = gold.of_changed_orders(tables, changed, f"{root}/changed/batch_id=1")
    fact_store.merge_fact(spark, root, gold.fact_orders(*affected), 1, of_orders=changed)
    gone = roles.orders().where(F.col("order_id").cast("bigint") % 5 == 0)
    nothing = spark.createDataFrame([], schemas.FACT_ORDERS)
    fact_store.merge_fact(spark, root, nothing, 2, of_orders=gone)
    return fact_store.read_totals(spark, root)


# --- streams -------------------------------------------------------------------------------


@query
def stream_autoload(spark, roles):
    """Silver orders loaded as they arrive: two batches, then a run without new files."""
    lake = new_folder(spark, "autoload")
    for number, (start, end) in enumerate(_TWO_RUNS):
        feed = _deliveries(roles, "orders", start, end)
        _run_silver(spark, roles, lake, number, {"orders": feed})
        runs.load_warehouse_table(spark, lake, silver.ORDERS)
    runs.load_warehouse_table(spark, lake, silver.ORDERS)
    return runs.read_warehouse(spark, lake, "orders")


FACT_SIDE = {
    "orders": schemas.WAREHOUSE["orders"],
    "order_items": schemas.DAILY_ORDER_ITEMS,
    "payments": schemas.DAILY_PAYMENTS,
}


def _land_batch(roles: Roles, lake: str, start: str | None, end: str | None) -> dict:
    """Append one batch to the three fact-side tables; the tables as (path, schema)."""
    batch = {
        "orders": with_year_text(roles.orders_between(start, end)),
        "order_items": roles.order_items_between(start, end),
        "payments": roles.payments_between(start, end),
    }

    def append(name: str) -> None:
        conform(batch[name], FACT_SIDE[name]).write.mode("append").parquet(f"{lake}/{name}")

    run_together(*[partial(append, name) for name in batch])
    return {name: (f"{lake}/{name}", schema) for name, schema in FACT_SIDE.items()}


@query
def stream_change_gate(spark, roles):
    """Three runs of the gate: a batch, nothing new, another batch."""
    lake = new_folder(spark, "gate")

    def count_changes(run: int) -> Callable[[DataFrame, int], None]:
        def handle(changed: DataFrame, batch_id: int) -> None:
            (
                changed.groupBy("changed_table")
                .agg(F.count_distinct("order_id").alias("changed_orders"))
                .withColumn("batch_id", F.lit(batch_id))
                .write.mode("overwrite")
                .parquet(f"{lake}/runs/run={run}")
            )

        return handle

    tables = _land_batch(roles, lake, None, SECOND_BATCH)
    on_change(spark, tables, count_changes(1), f"{lake}/work")
    on_change(spark, tables, count_changes(2), f"{lake}/work")
    _land_batch(roles, lake, SECOND_BATCH, None)
    on_change(spark, tables, count_changes(3), f"{lake}/work")
    return spark.read.parquet(f"{lake}/runs").select(
        "run", "batch_id", "changed_table", "changed_orders"
    )


@query
def stream_fact_merge(spark, roles):
    """The fact kept current by the change streams over two batches and an empty run."""
    lake = new_folder(spark, "stream-fact")
    root, work = f"{lake}/gold/fact_orders", f"{lake}/work"
    tables = _land_batch(roles, lake, None, SECOND_BATCH)
    refresh_fact(spark, tables, root, work)
    _land_batch(roles, lake, SECOND_BATCH, None)
    refresh_fact(spark, tables, root, work)
    refresh_fact(spark, tables, root, work)
    return fact_store.read_fact(spark, root)


def _full_runs(
    spark,
    roles: Roles,
    lake: str,
    batches: list[dict[str, DataFrame]],
    again: dict[str, DataFrame] | None = None,
) -> None:
    """Deliver and run everything, batch after batch; `again` is delivered after the last batch."""
    histories = _histories(roles)
    for number, batch in enumerate(batches):
        with for_many_steps(spark):
            run_together(
                *[partial(_deliver, rows, lake, name, number) for name, rows in batch.items()]
            )
            for name, rows in ((again or {}) if number == len(batches) - 1 else {}).items():
                _deliver(rows, lake, name, len(batches))
        feeds = {name: (histories[name], _daily(lake, name)) for name in runs.TABLES}
        runs.run(spark, lake, feeds)


def _two_batches(roles: Roles) -> list[dict[str, DataFrame]]:
    return [
        {name: _deliveries(roles, name, start, end) for name in runs.TABLES}
        for start, end in _TWO_RUNS
    ]


@query
def daily_runs_fact(spark, roles):
    """Two full runs from the feeds to gold; items may arrive before or after their order."""
    lake = new_folder(spark, "runs")
    _full_runs(spark, roles, lake, _two_batches(roles))
    return fact_store.read_fact(spark, f"{lake}/gold/fact_orders")


@query
def daily_runs_dims(spark, roles):
    """Both dimensions after two runs of products and customers, from silver to gold."""
    lake = new_folder(spark, "runs")
    for number, (start, end) in enumerate(_TWO_RUNS):
        feeds = {n: _deliveries(roles, n, start, end) for n in ("products", "customers")}
        _run_silver(spark, roles, lake, number, feeds)
        for name in feeds:
            runs.load_warehouse_table(spark, lake, runs.TABLES[name])
        runs.refresh_dimensions(spark, lake)
    products = runs.dimension(spark, lake, "products")
    customers = runs.dimension(spark, lake, "customers")
    none = F.lit(None).cast("string")
    return products.select(
        F.lit("product").alias("dimension"),
        F.col("product_id").alias("key"),
        F.col("product_category_name").alias("name"),
        none.alias("city"),
        "price",
        "stock",
        "rating",
    ).unionByName(
        customers.select(
            F.lit("customer").alias("dimension"),
            F.col("customer_id").alias("key"),
            F.col("last_name").alias("name"),
            F.col("customer_city").alias("city"),
            F.lit(None).cast(schemas.MONEY).alias("price"),
            F.lit(None).cast("int").alias("stock"),
            F.lit(None).cast("double").alias("rating"),
        )
    )


@query
def stream_fact_order_moved(spark, roles):
    """Two full runs; the second moves the purchase of some stored orders by 14 months, and
    brings their items again with another price under their former date."""
    lake = new_folder(spark, "moved")
    first, second = _two_batches(roles)
    moved = first["orders"].where(F.col("order_id").cast("bigint") % 3 == 0)
    moved = moved.withColumns(
        {
            "order_purchase_timestamp": F.col("order_purchase_timestamp")
            + F.expr("INTERVAL 14 MONTHS"),
            "ingestion_date": F.date_add("ingestion_date", 400),
        }
    )
    second["orders"] = second["orders"].unionByName(moved)
    again = {"order_items": _repriced(first["order_items"], 3, 0, "2.00")}
    _full_runs(spark, roles, lake, [first, second], again)
    return fact_store.read_fact(spark, f"{lake}/gold/fact_orders")
