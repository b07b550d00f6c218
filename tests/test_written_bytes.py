"""Files that only later steps of a job read are written small."""

from pathlib import Path

from orderloom import schemas
from orderloom.plans import fact_store
from orderloom.plans.catalog import QUERIES
from orderloom.session import work_root


def files(root, suffix):
    return [p for p in Path(root).rglob("part-*") if p.name.endswith(suffix)]


def test_source_files_of_the_routing_are_compressed(spark):
    before = set(Path(work_root(spark), "orderloom").glob("routing-*"))
    assert QUERIES["dataset_routing"](spark, "/root/testdata/sf0.001").count() == 9
    (lake,) = set(Path(work_root(spark), "orderloom").glob("routing-*")) - before
    sources = files(lake / "source", "")
    assert sources and all(p.name.endswith(".csv.gz") for p in sources)
    # Rows come back from the compressed files as they were.
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert spark.read.parquet(f"{lake}/bronze/order_items").count() == lines


def test_the_fact_is_written_compressed(spark, tmp_path):
    root = f"{tmp_path}/fact"
    fields = schemas.FACT_ORDERS.names
    keyed = spark.range(500).selectExpr("cast(id as string) order_id", "md5(cast(id as string)) product_id")
    rows = keyed.selectExpr(*[c if c in keyed.columns else f"cast(null as {schemas.FACT_ORDERS[c].dataType.simpleString()}) {c}" for c in fields])
    fact_store.merge_fact(spark, root, rows, 0)
    fact_store.merge_fact(spark, root, rows.limit(10), 1)
    parts = files(f"{root}/source", ".parquet") + files(f"{root}/base", ".parquet") + files(f"{root}/delta", ".parquet")
    assert parts and all(".zstd." in p.name for p in parts)
    assert fact_store.read_fact(spark, root).count() >= 500
