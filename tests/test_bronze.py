import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.plans import bronze
from orderloom.schemas import DAILY_CUSTOMERS, DAILY_PRODUCTS, struct
from orderloom.session import new_folder, prepare, shuffle_sizes, work_root
from orderloom.sinks.folders import complete, current, drop, exists, publish
from orderloom.sinks.parquet import write_load_date, write_year_month
from orderloom.sinks.state import load_state, save_state
from orderloom.sources.files import read_csv, read_json, read_parquet_or_none
from orderloom.sources.paging import PagedSource, cursors_from
from orderloom.sources.routing import DatasetSpec, land, malformed_path, route
from tests.conftest import rows

DAY1, DAY2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def text_file(spark, path, text):
    spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.text(path)


def test_csv_with_line_breaks_in_quotes(spark, lake):
    text_file(spark, f"{lake}/reviews.csv", 'review_id,comment\nr1,"two\nlines, ""quoted"""\nr2,\n')
    schema = struct(("review_id", "string"), ("comment", "string"))
    df = read_csv(spark, f"{lake}/reviews.csv", schema, multiline=True)
    assert rows(df) == [("r1", 'two\nlines, "quoted"'), ("r2", None)]


def test_csv_types_are_inferred_without_a_schema(spark, lake):
    text_file(spark, f"{lake}/x.csv", "a,b\n1,x\n2,y\n")
    assert dict(read_csv(spark, f"{lake}/x.csv").dtypes) == {"a": "int", "b": "string"}


def test_routing_is_exact(spark, lake):
    specs = [
        DatasetSpec("orders.csv", "orders", partition_column="at"),
        DatasetSpec("customers.csv", "customers"),
        DatasetSpec("sellers.csv", "sellers", excluded=True),
    ]
    assert [route(s.file, specs).action for s in specs] == ["partitioned", "flat", "skipped"]
    # A part of a listed name is not that name.
    with pytest.raises(ValueError, match="known files"):
        route("orders", specs)
    assert land(spark, specs[2], f"{lake}/absent", lake) is None


@pytest.mark.parametrize("declared", [True, False])
def test_malformed_rows_land_and_are_listed_with_their_file(spark, lake, declared):
    Path(f"{lake}/src").mkdir(parents=True)
    lines = ["k,when,note", "1,2018-01-02,a", "2,2018-01-03", "3,2018-02-02,b,extra", '4,2018-02-03,"c,d"', ""]
    Path(f"{lake}/src/x.csv").write_text("\n".join(lines))
    schema = T.StructType.fromDDL("k INT, when STRING, note STRING") if declared else None
    for column in ("when", None):
        spec = DatasetSpec("x.csv", f"x_{column}", schema, partition_column=column)
        path = land(spark, spec, f"{lake}/src", f"{lake}/bronze")
        assert rows(spark.read.parquet(path), "k", "note") == [(1, "a"), (2, None), (3, "b"), (4, "c,d")]
        listed = spark.read.parquet(malformed_path(f"{lake}/bronze", spec.name))
        assert rows(listed, "record") == [("2,2018-01-03",), ("3,2018-02-02,b,extra",)]
        assert all(r["file"].endswith("/src/x.csv") for r in listed.collect())
        assert '"k":2' in rows(listed, "read_as")[0][0]
        # Landed again without them, nothing is listed.
        Path(f"{lake}/src/y.csv").write_text("\n".join([*lines[:2], *lines[4:]]))
        clean = DatasetSpec("y.csv", spec.name, schema, partition_column=column)
        land(spark, clean, f"{lake}/src", f"{lake}/bronze")
        assert not exists(spark, malformed_path(f"{lake}/bronze", spec.name))


def test_partitioned_landing_keeps_rows_with_bad_dates(spark, lake):
    text_file(spark, f"{lake}/in/orders.csv", "id,at\n1,2017-10-02 10:56:33\n2,never\n3,\n4,2018-01-01\n")
    spec = DatasetSpec(
        "orders.csv", "orders", struct(("id", "int"), ("at", "string")), partition_column="at"
    )
    path = land(spark, spec, f"{lake}/in", f"{lake}/out")
    assert rows(spark.read.parquet(path), "id", "year", "month") == [
        (1, 2017, 10),
        (2, None, None),
        (3, None, None),
        (4, 2018, 1),
    ]


def test_landing_reads_the_layouts_its_spec_declares(spark, lake):
    text_file(spark, f"{lake}/in/orders.csv", "id,at\n1,10/02/2017\n2,Oct 2 2017\n3,2017-10-02\n")
    schema = struct(("id", "int"), ("at", "string"))
    spec = DatasetSpec(
        "orders.csv", "orders", schema, partition_column="at", timestamp_layouts=("dd/MM/yyyy", "MMM d yyyy")
    )
    path = land(spark, spec, f"{lake}/in", f"{lake}/out")
    assert rows(spark.read.parquet(path), "id", "year", "month") == [(1, 2017, 2), (2, 2017, 10), (3, 2017, 10)]


def test_year_month_write_takes_timestamps_too(spark, lake):
    df = spark.createDataFrame([(dt.datetime(2020, 2, 3),)], "at TIMESTAMP")
    write_year_month(df, "at", f"{lake}/t")
    assert rows(spark.read.parquet(f"{lake}/t"), "year", "month") == [(2020, 2)]


def test_load_date_rerun_replaces_its_day_only(spark, lake):
    df = spark.createDataFrame([(1,), (2,)], "id INT")
    write_load_date(df, lake, DAY1)
    write_load_date(df, lake, DAY2)
    write_load_date(df.where("id = 2"), lake, DAY2)
    write_load_date(df.where("id = 0"), lake, DAY1)  # an empty batch writes nothing
    assert rows(spark.read.parquet(lake), "ingestion_date", "id") == [
        (DAY1, 1),
        (DAY1, 2),
        (DAY2, 2),
    ]


def test_absent_path_is_none_and_other_errors_are_raised(spark, lake):
    assert read_parquet_or_none(spark, f"{lake}/nothing") is None
    text_file(spark, f"{lake}/text", "not parquet")
    with pytest.raises(Exception):
        read_parquet_or_none(spark, f"{lake}/text").count()


def test_nested_users_are_flattened(spark, lake):
    line = (
        '{"id": 5, "username": "u", "firstName": "F", "lastName": "L", "email": "e", "phone": "p",'
        ' "address": {"city": "C", "state": "S", "postalCode": "01046"}, "other": 1}'
    )
    text_file(spark, f"{lake}/users", line)
    out = bronze.customers_from_users(read_json(spark, f"{lake}/users", bronze.USER_RECORD))
    assert out.columns == [c for c in DAILY_CUSTOMERS.names if c != "ingestion_date"]
    assert rows(out, "first_name", "customer_city", "customer_zip_code_prefix") == [
        ("F", "C", "01046")
    ]


def test_products_keep_lengths_and_depth(spark):
    record = spark.sql(
        "SELECT 1L id, 'c' category, 'naïve' title, CAST(NULL AS STRING) description,"
        " CAST(NULL AS ARRAY<STRING>) images, 3 weight,"
        " named_struct('depth', 1D, 'height', 2D, 'width', 3D) dimensions,"
        " 9.5BD price, 4 stock, 4.5D rating"
    )
    out = bronze.products_from_records(record)
    assert out.columns == [c for c in DAILY_PRODUCTS.names if c != "ingestion_date"]
    assert rows(out.select(*out.columns[2:5], "product_length_cm")) == [(5, None, None, 1.0)]


def test_pages_follow_the_cursor_until_the_source_is_exhausted(spark, lake):
    source = PagedSource("users", spark.range(1, 6), "id", 2, "customers", lambda page: page)
    for n, day in enumerate((1, 1, 2, 3, 4)):  # two pulls on the first day
        landed = bronze.pull_pages(spark, [source], lake, dt.date(2024, 1, day))
        assert landed == (["customers"] if n < 3 else [])
    assert rows(spark.read.parquet(f"{lake}/bronze/daily/customers"), "ingestion_date", "run", "id") == [
        (dt.date(2024, 1, 1), 0, 1),
        (dt.date(2024, 1, 1), 0, 2),
        (dt.date(2024, 1, 1), 2, 3),
        (dt.date(2024, 1, 1), 2, 4),
        (dt.date(2024, 1, 2), 4, 5),
    ]
    # The cursor moved by whole pages, past the end of a source of five.
    cursor = cursors_from(current(spark, f"{lake}/control/cursors"))["users"]
    assert (cursor.offset, cursor.last_key) == (6, 5)


def test_an_interrupted_pull_replaces_its_own_page_only(spark, lake):
    source = PagedSource("users", spark.range(1, 8), "id", 2, "customers", lambda page: page)
    day = dt.date(2024, 1, 1)
    bronze.pull_pages(spark, [source], lake, day)
    bronze.pull_pages(spark, [source], lake, day)
    drop(spark, f"{lake}/control/cursors/v=2")  # the second pull's cursor was never saved
    bronze.pull_pages(spark, [source], lake, day)
    bronze.pull_pages(spark, [source], lake, day)
    landed = spark.read.parquet(f"{lake}/bronze/daily/customers")
    assert rows(landed, "id") == [(n,) for n in range(1, 7)]


def test_rows_that_share_a_key_at_a_page_border_stay_together(spark, lake):
    table = spark.createDataFrame([(1,), (2,), (2,), (2,), (3,)], "id BIGINT")
    source = PagedSource("users", table, "id", 2, "customers", lambda page: page)
    for day in (1, 2, 3):
        bronze.pull_pages(spark, [source], lake, dt.date(2024, 1, day))
    assert rows(spark.read.parquet(f"{lake}/bronze/daily/customers"), "id") == [(1,), (2,), (2,), (2,), (3,)]


def test_state_is_created_once_and_replaced_whole(spark, lake):
    initial = spark.createDataFrame([("users", 0)], "source STRING, offset BIGINT")
    assert rows(load_state(spark, lake, initial)) == [("users", 0)]
    save_state(spark.createDataFrame([("users", 20)], initial.schema), lake)
    assert rows(load_state(spark, lake, initial)) == [("users", 20)]


def test_a_table_can_be_replaced_by_a_query_on_itself(spark, lake):
    publish(spark.range(4), lake)
    publish(current(spark, lake).where(F.col("id") > 1), lake)
    assert rows(current(spark, lake)) == [(2,), (3,)]
    assert complete(spark, lake, "v") == [0, 1]
    publish(current(spark, lake).where("id = 3"), lake)
    assert rows(current(spark, lake)) == [(3,)]
    assert complete(spark, lake, "v") == [1, 2]


def test_work_folder_and_shuffle_size(spark):
    assert new_folder(spark, "x").startswith(work_root(spark))
    assert shuffle_sizes(10_000, 8) == (256 * 1024, 8, 128 << 20)
    # Partitions stay at 128 MB until there would be too many, then they grow.
    tera = 1 << 40
    assert shuffle_sizes(tera, 1000)[:2] == (128 << 20, 4 * tera // (128 << 20))
    size, count, _ = shuffle_sizes(100 * tera, 1000, most_partitions=100_000)
    assert size == -(-4 * tera // 1000) and count <= 100_000
    prepare(spark, "/root/testdata/sf0.001")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(128 << 20)
