"""A merge stages its rows where they meet the base, and ids are short in exchanges."""

from pathlib import Path

from orderloom import schemas
from orderloom.functions.keys import packed, unpacked
from orderloom.operators.upsert import upsert, upsert_parts
from orderloom.plans import fact_store, gold
from tests.conftest import rows


def facts(spark, orders, price="1.00"):
    filled = {"order_id": "cast(id as string)", "product_id": "md5(cast(id as string))", "price": price}
    return spark.range(orders).selectExpr(
        *[f"cast({filled.get(f.name, 'null')} as {f.dataType.simpleString()}) {f.name}" for f in schemas.FACT_ORDERS]
    )


def test_any_text_comes_back_from_its_packed_form(spark):
    texts = ["", "a", "ab", "AB", "aB", "0f" * 16, "0f" * 15 + "0", "ab\n", "é", "\x01", "\x00ab", None]
    df = spark.createDataFrame([(t,) for t in texts], "k STRING")
    short = packed(df, "k", "absent")
    assert rows(unpacked(short, "k")) == rows(df)
    assert short.where("k IS NOT NULL").distinct().count() == len(texts) - 1
    assert rows(packed(df.where(f"k = '{'0f' * 16}'"), "k").selectExpr("length(k) n")) == [(17,)]


def test_parts_of_an_upsert_are_the_upsert(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", None, "z")], "k STRING, v INT, w STRING")
    source = spark.createDataFrame([("a", None, "n"), ("d", 4, "m")], "k STRING, v INT, w STRING")
    one, other = upsert_parts(target, source, ["k"], ["v"])
    assert rows(one.unionByName(other)) == rows(upsert(target, source, ["k"], ["v"]))


def test_the_first_merge_is_written_once_and_a_large_one_without_a_delta(spark, tmp_path):
    root = f"{tmp_path}/fact"
    nameless = facts(spark, 3).selectExpr(*[c if c != "product_id" else "cast(null as string) product_id" for c in schemas.FACT_ORDERS.names])
    fact_store.merge_fact(spark, root, facts(spark, 40).unionByName(nameless), 0, buckets=4)
    assert not Path(root, "source").exists()
    assert spark.read.parquet(f"{root}/rejects/batch_id=0").count() == 3
    fact_store.keep_totals(spark, root)
    fact_store.merge_fact(spark, root, facts(spark, 30, "2.00"), 1, update=["price"], buckets=4)
    assert not Path(root, "delta").exists()
    stored = fact_store.read_fact(spark, root)
    assert stored.count() == 40 and stored.where("price = 2").count() == 30
    kept = fact_store.read_totals(spark, root, "product").where("amount = 2").count()
    assert kept == 30


def test_a_fold_exchanges_neither_base_nor_staged_rows(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/fact"
    fact_store.merge_fact(spark, root, facts(spark, 40), 0, buckets=4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans, plain = [], fact_store.write_bucketed

    def write(parts, path, *layout):
        if not path.endswith("/source"):
            for part in parts:
                plans.append(part.repartition(layout[1], "order_id")._jdf.queryExecution().executedPlan().toString())
        plain(parts, path, *layout)

    monkeypatch.setattr(fact_store, "write_bucketed", write)
    try:
        fact_store.merge_fact(spark, root, facts(spark, 30, "2.00"), 1, buckets=4)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(plans) == 3 and not any("Exchange" in plan for plan in plans)


def test_long_keys_are_joined_in_their_packed_form(spark):
    orders = spark.createDataFrame([("1", "0f" * 16, None, "2000")], "order_id STRING, customer_id STRING, order_purchase_timestamp TIMESTAMP, order_purchase_year STRING")
    items = spark.createDataFrame([("1", 1, "ab" * 16, "s", None, None, None), ("1", 2, "plain", "s", None, None, None)], "order_id STRING, order_item_id INT, product_id STRING, seller_id STRING, shipping_limit_date TIMESTAMP, price DECIMAL(12,2), freight_value DECIMAL(12,2)")
    payments = spark.createDataFrame([("1", 1, "voucher", 1, None)], "order_id STRING, payment_sequential INT, payment_type STRING, payment_installments INT, payment_value DECIMAL(12,2)")
    fact = gold.fact_orders(orders, items, payments)
    assert rows(fact, "customer_id", "product_id") == [("0f" * 16, "ab" * 16), ("0f" * 16, "plain")]
    assert "unhex" in fact._jdf.queryExecution().executedPlan().toString()
