"""The same results as plain SQL over the given tables, for the DuckDB comparison."""

from __future__ import annotations

CUT = "TIMESTAMP '2000-01-01'"
SECOND = "TIMESTAMP '2001-01-01'"

# --- role tables -----------------------------------------------------------------------------

ROLES = {
    "r_orders": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               md5('dummyjson_customer_' || CAST(o_custkey AS VARCHAR)) AS customer_id,
               o_orderstatus AS order_status,
               o_orderdate AS order_purchase_timestamp,
               o_orderdate + INTERVAL 15 MINUTE AS order_approved_at,
               CAST(NULL AS TIMESTAMP) AS order_delivered_carrier_date,
               CAST(NULL AS TIMESTAMP) AS order_delivered_customer_date,
               CAST(NULL AS TIMESTAMP) AS order_estimated_delivery_date,
               CASE WHEN o_orderdate >= {CUT} THEN CAST(o_orderdate AS DATE) END AS ingestion_date,
               CAST(year(o_orderdate) AS INT) AS order_purchase_year
        FROM orders""",
    "r_items": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_linenumber AS INT) AS order_item_id,
               md5('dummyjson_product_' || CAST(l_partkey AS VARCHAR)) AS product_id,
               CAST(l_suppkey AS VARCHAR) AS seller_id,
               l_shipdate AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
               CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)
                    AS DECIMAL(18,2)) AS freight_value,
               CASE WHEN l_shipdate >= {CUT} THEN CAST(l_shipdate AS DATE) END AS ingestion_date
        FROM lineitem""",
    "r_payments": f"""
        SELECT order_id,
               CAST(ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY flag) AS INT)
                 AS payment_sequential,
               CASE flag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END
                 AS payment_type,
               n AS payment_installments,
               payment_value,
               CASE WHEN paid_from >= {CUT} THEN CAST(paid_from AS DATE) END AS ingestion_date,
               paid_from
        FROM (SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_returnflag AS flag,
                     CAST(COUNT(*) AS INT) AS n,
                     CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2))
                       AS payment_value,
                     MIN(l_shipdate) AS paid_from
              FROM lineitem GROUP BY 1, 2)""",
    "r_people": """
        SELECT * FROM customer
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "r_customers": """
        SELECT c_custkey, md5('dummyjson_customer_' || CAST(c_custkey AS VARCHAR)) AS customer_id,
               md5(c_name) AS customer_unique_id,
               c_mktsegment AS first_name,
               c_name AS last_name,
               lower(c_name) || '@' || lower(n_name) || '.example' AS email,
               CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS phone,
               lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
               n_name AS customer_city,
               r_name AS customer_state
        FROM r_people""",
    "r_customer_rows": f"""
        SELECT customer_id, customer_unique_id, NULL AS first_name, NULL AS last_name,
               NULL AS email, NULL AS phone, customer_zip_code_prefix, customer_city,
               customer_state, CAST(NULL AS DATE) AS ingestion_date
        FROM r_customers
        UNION ALL
        SELECT customer_id, customer_unique_id, first_name, last_name, email, phone,
               customer_zip_code_prefix, customer_city, customer_state, d.ingestion_date
        FROM r_customers
        JOIN (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS ingestion_date
              FROM orders WHERE o_orderdate >= {CUT}) d ON d.o_custkey = c_custkey""",
    "r_product_base": """
        SELECT p_partkey, md5('dummyjson_product_' || CAST(p_partkey AS VARCHAR)) AS product_id,
               p_type AS product_category_name,
               CAST(length(p_name) AS INT) AS product_name_length,
               CAST(length(p_name || ' ' || p_brand || ' ' || p_type) AS INT)
                 AS product_description_length,
               CAST(len(string_split(p_name, ' ')) AS INT) AS product_photos_qty,
               CAST(p_size AS INT) AS product_weight_g,
               CAST(p_size AS DOUBLE) / 2 AS product_length_cm,
               CAST(p_size AS DOUBLE) / 4 AS product_height_cm,
               CAST(p_size AS DOUBLE) * 2 AS product_width_cm,
               CAST(p_retailprice AS DECIMAL(18,2)) AS price
        FROM part""",
    "r_product_deliveries": f"""
        SELECT b.*, d.stock, d.rating, d.ingestion_date
        FROM r_product_base b
        JOIN (SELECT l_partkey, year(l_shipdate) AS y, CAST(SUM(l_quantity) AS INT) AS stock,
                     CAST(MAX(l_quantity) / 10 AS DOUBLE) AS rating,
                     CAST(MAX(l_shipdate) AS DATE) AS ingestion_date
              FROM lineitem WHERE l_shipdate >= {CUT} GROUP BY 1, 2) d ON l_partkey = p_partkey""",
    "r_product_rows": """
        SELECT product_id, product_category_name, product_name_length, product_description_length,
               product_photos_qty, product_weight_g, product_length_cm, product_height_cm,
               product_width_cm, CAST(NULL AS DECIMAL(18,2)) AS price, CAST(NULL AS INT) AS stock,
               CAST(NULL AS DOUBLE) AS rating, CAST(NULL AS DATE) AS ingestion_date
        FROM r_product_base
        UNION ALL
        SELECT * EXCLUDE (p_partkey) FROM r_product_deliveries""",
    "r_date_texts": """
        SELECT *, coalesce(TRY_CAST(order_purchase_timestamp AS TIMESTAMP),
                           try_strptime(order_purchase_timestamp, '%m/%d/%Y'),
                           try_strptime(order_purchase_timestamp, '%b %d %Y')) AS parsed
        FROM (SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               CASE o_orderkey % 7
                 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                 WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
                 WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
                 WHEN 3 THEN strftime(o_orderdate, '%m/%d/%Y')
                 WHEN 4 THEN strftime(o_orderdate, '%b %-d %Y')
                 WHEN 5 THEN 'not specified'
                 ELSE strftime(o_orderdate, '%Y-13-%d') END AS order_purchase_timestamp,
               CAST(o_totalprice AS DECIMAL(18,2)) AS order_total
        FROM orders)""",
    "r_paid": """
        SELECT order_id, CAST(SUM(payment_value) AS DECIMAL(28,2)) AS payment_value,
               MAX(payment_type) AS payment_type,
               MAX(payment_installments) AS payment_installments
        FROM r_payments GROUP BY order_id""",
    "r_fact": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT o.order_id, o.customer_id, i.product_id, o.order_purchase_timestamp,
                 CAST(o.order_purchase_year AS VARCHAR) AS order_purchase_year,
                 i.price, i.freight_value, p.payment_value, p.payment_type, p.payment_installments,
                 ROW_NUMBER() OVER (PARTITION BY o.order_id, i.product_id
                   ORDER BY o.order_purchase_timestamp DESC, i.order_item_id, i.seller_id,
                            i.shipping_limit_date, i.price) AS rn
          FROM r_orders o JOIN r_items i ON o.order_id = i.order_id
          JOIN r_paid p ON p.order_id = o.order_id) WHERE rn = 1""",
    "r_fact_ref": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT o.order_id, o.customer_id, i.product_id, o.order_purchase_timestamp,
                 CAST(o.order_purchase_year AS VARCHAR) AS order_purchase_year,
                 i.price, i.freight_value,
                 CAST(SUM(p.payment_value) OVER (PARTITION BY o.order_id) AS DECIMAL(28,2))
                   AS payment_value,
                 MAX(p.payment_type) OVER (PARTITION BY o.order_id) AS payment_type,
                 MAX(p.payment_installments) OVER (PARTITION BY o.order_id) AS payment_installments,
                 ROW_NUMBER() OVER (PARTITION BY o.order_id, i.product_id
                   ORDER BY o.order_purchase_timestamp DESC, i.order_item_id, i.seller_id,
                            i.shipping_limit_date, i.price, p.payment_sequential) AS rn
          FROM r_orders o JOIN r_items i ON o.order_id = i.order_id
          JOIN r_payments p ON p.order_id = o.order_id) WHERE rn = 1""",
}

# Role tables each role builds on.
USES = {
    "r_customers": ["r_people"],
    "r_customer_rows": ["r_customers"],
    "r_product_deliveries": ["r_product_base"],
    "r_product_rows": ["r_product_base", "r_product_deliveries"],
    "r_paid": ["r_payments"],
    "r_fact": ["r_orders", "r_items", "r_paid"],
    "r_fact_ref": ["r_orders", "r_items", "r_payments"],
}


def _with(roles: list[str], body: str) -> str:
    needed: list[str] = []

    def add(name: str) -> None:
        for used in USES.get(name, []):
            add(used)
        if name not in needed:
            needed.append(name)

    for role in roles:
        add(role)
    ctes = ",\n".join(f"{name} AS ({ROLES[name]})" for name in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


def _first(source: str, keys: str, order: str) -> str:
    """One row per key, latest first with every tie closed."""
    return f"""SELECT * EXCLUDE (rn) FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source})
        WHERE rn = 1"""


def _newest(columns: str, date: str = "ingestion_date") -> str:
    rest = [f"{c.strip()} ASC NULLS LAST" for c in columns.split(",")]
    return ", ".join([f"{date} DESC NULLS LAST"] + rest)


ITEM_ORDER = _newest(
    "order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value"
)
SINGLE_ORDER = _newest(
    "product_id, order_id, order_item_id, seller_id, price", "shipping_limit_date"
)
CUSTOMER_ORDER = _newest(
    "customer_id, customer_unique_id, first_name, last_name, email, phone,"
    " customer_zip_code_prefix, customer_city, customer_state"
)
PRODUCT_ORDER = _newest(
    "product_id, product_category_name, product_name_length, product_description_length,"
    " product_photos_qty, product_weight_g, product_length_cm, product_height_cm,"
    " product_width_cm, price, stock, rating"
)
ORDER_ORDER = _newest("customer_id, order_status, order_purchase_timestamp")

ITEM_COLUMNS = "product_id, order_id, order_item_id, seller_id, shipping_limit_date, price"
FACT_COLUMNS = (
    "order_id, customer_id, product_id, order_purchase_timestamp, order_purchase_year, price,"
    " freight_value, payment_value, payment_type, payment_installments"
)

SQL: dict[str, str] = {}

# --- bronze ----------------------------------------------------------------------------------

SQL["csv_roundtrip_customers"] = _with(
    ["r_customers"],
    """SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city,
              customer_state FROM r_customers""",
)
SQL["csv_malformed_rows"] = """
SELECT 'malformed' AS kind, 1::BIGINT AS rows,
       concat_ws(',', o_orderkey, o_custkey, CASE WHEN o_orderkey % 11 != 0 THEN o_orderstatus END,
                 CASE WHEN o_orderkey % 11 = 1 THEN 'extra' END) AS record
FROM orders WHERE o_orderkey % 11 IN (0, 1)
UNION ALL
SELECT 'landed', COUNT(*), CASE WHEN o_orderkey % 11 != 0 THEN o_orderstatus END AS status
FROM orders GROUP BY status"""
SQL["lenient_timestamp_parse"] = _with(
    ["r_date_texts"],
    "SELECT order_id, order_purchase_timestamp, parsed FROM r_date_texts",
)
SQL["bronze_partitioned_orders"] = _with(
    ["r_date_texts"],
    """SELECT CAST(year(t) AS INT) AS year, CAST(month(t) AS INT) AS month, COUNT(*) AS orders,
              CAST(SUM(order_total) AS DECIMAL(38,2)) AS order_total
       FROM (SELECT *, parsed AS t FROM r_date_texts)
       GROUP BY 1, 2""",
)
SQL["bronze_load_date_partition"] = f"""
    SELECT CASE WHEN o_orderdate < {CUT} THEN DATE '2001-08-01' ELSE DATE '2001-08-02' END
             AS ingestion_date,
           COUNT(*) AS orders,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS order_total
    FROM orders GROUP BY 1"""


def _landed(dataset: str, source: str, column: str | None = None, moment: str | None = None) -> str:
    action = "partitioned" if column else "flat"
    name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    months = f"COUNT(DISTINCT strftime({moment}, '%Y-%m'))" if moment else "0"
    return f"""SELECT '{dataset}' AS dataset, '{action}' AS action, {name} AS partition_column,
        COUNT(*) AS rows_landed, CAST({months} AS BIGINT) AS months FROM {source}"""


def _skipped(dataset: str) -> str:
    return f"""SELECT '{dataset}', 'skipped', CAST(NULL AS VARCHAR), CAST(0 AS BIGINT),
        CAST(0 AS BIGINT)"""


SQL["dataset_routing"] = "\nUNION ALL\n".join(
    [
        _landed("customers", "customer"),
        _landed("orders", "orders", "order_purchase_timestamp", "o_orderdate"),
        _landed("order_items", "lineitem", "shipping_limit_date", "l_shipdate"),
        _landed("payments", "(SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem)"),
        _landed("products", "part"),
        _landed("reviews", "events", "review_creation_date", "ts"),
        _skipped("geolocation"),
        _skipped("sellers"),
        _skipped("category_translation"),
    ]
)
SQL["cursor_page"] = """
    WITH pulled AS (
        SELECT 'customers' AS dataset, md5('dummyjson_customer_' || CAST(c_custkey AS VARCHAR)) AS key,
               ROW_NUMBER() OVER (ORDER BY c_custkey) - 1 AS n, 20 AS page FROM customer
        UNION ALL
        SELECT 'products', md5('dummyjson_product_' || CAST(p_partkey AS VARCHAR)),
               ROW_NUMBER() OVER (ORDER BY p_partkey) - 1, 30 FROM part
        UNION ALL
        SELECT 'regions', CAST(r_regionkey AS VARCHAR),
               ROW_NUMBER() OVER (ORDER BY r_regionkey) - 1, 2 FROM region)
    SELECT dataset, key, CAST(n // page * page AS INT) AS run,
           [DATE '2024-01-01', DATE '2024-01-01', DATE '2024-01-02', DATE '2024-01-03'][n // page + 1]
             AS ingestion_date
    FROM pulled WHERE n // page < 4"""
SQL["json_flatten_events"] = """
    SELECT event_id, event_type, CAST(props->>'k' AS INT) AS k FROM events"""
SQL["customers_transform"] = _with(
    ["r_customers"], "SELECT * EXCLUDE (c_custkey) FROM r_customers"
)
SQL["products_transform"] = _with(
    ["r_product_deliveries"], "SELECT * EXCLUDE (p_partkey) FROM r_product_deliveries"
)

# --- silver ----------------------------------------------------------------------------------

SQL["high_water_mark"] = _with(
    ["r_orders", "r_items"],
    """SELECT 'orders' AS table_name, MAX(ingestion_date) AS mark FROM r_orders
       UNION ALL SELECT 'order_items', MAX(ingestion_date) FROM r_items
       UNION ALL SELECT 'reviews', CAST(NULL AS DATE)""",
)
SQL["incremental_filter"] = _with(
    ["r_orders"],
    f"""SELECT order_id, customer_id, ingestion_date FROM r_orders
        WHERE ingestion_date > (SELECT MAX(ingestion_date) FROM r_orders
                                WHERE order_purchase_timestamp < {SECOND})""",
)
SQL["align_union_products"] = _with(["r_product_rows"], "SELECT * FROM r_product_rows")
SQL["dedup_single_key"] = _with(
    ["r_items"],
    _first(f"(SELECT {ITEM_COLUMNS} FROM r_items)", "product_id", SINGLE_ORDER),
)
SQL["dedup_composite_key"] = _with(
    ["r_items"],
    _first(f"(SELECT {ITEM_COLUMNS} FROM r_items)", "order_item_id, order_id", SINGLE_ORDER),
)
SQL["silver_products"] = _with(
    ["r_product_rows"], _first("r_product_rows", "product_id", PRODUCT_ORDER)
)
SQL["silver_customers"] = _with(
    ["r_customer_rows"], _first("r_customer_rows", "customer_id", CUSTOMER_ORDER)
)
SQL["silver_orders"] = _with(
    ["r_orders"], "SELECT *, order_purchase_year AS partition_year FROM r_orders"
)
SQL["silver_order_items"] = _with(
    ["r_items", "r_orders"],
    f"""SELECT i.*, o.order_purchase_timestamp, o.order_purchase_year,
               o.order_purchase_year AS partition_year
        FROM ({_first("r_items", "order_id, order_item_id", ITEM_ORDER)}) i
        JOIN r_orders o ON o.order_id = i.order_id""",
)
SQL["silver_payments"] = _with(
    ["r_payments", "r_orders"],
    """SELECT p.* EXCLUDE (paid_from), o.order_purchase_timestamp, o.order_purchase_year,
              o.order_purchase_year AS partition_year
       FROM r_payments p JOIN r_orders o ON o.order_id = p.order_id""",
)

# The latest version over two runs, of rows that carry their run. A run keeps the latest row of a
# key; the second one stores it if its content differs from what the first one stored and it is not older.
def _two_runs(rows: str, keys: str, order: str, content: str, not_older: str = "true") -> str:
    return f"""
    , run0 AS ({_first(f"(SELECT * FROM {rows} WHERE run = 0)", keys, order)}),
    run1 AS ({_first(f"(SELECT * FROM {rows} WHERE run = 1)", keys, order)}),
    changed AS (SELECT run1.* FROM run1 LEFT JOIN run0 USING ({keys})
                WHERE run0.run IS NULL OR (({not_older}) AND ({_differs("run0", "run1", content)}))),
    latest AS (SELECT * FROM run0 WHERE NOT EXISTS (
                 SELECT 1 FROM changed c WHERE {_same("c", "run0", keys)})
               UNION ALL SELECT * FROM changed)"""


def _differs(a: str, b: str, columns: str) -> str:
    return " OR ".join(f"{a}.{c.strip()} IS DISTINCT FROM {b}.{c.strip()}" for c in columns.split(","))


def _same(a: str, b: str, columns: str) -> str:
    return " AND ".join(f"{a}.{c.strip()} = {b}.{c.strip()}" for c in columns.split(","))


SQL["silver_orders_incremental"] = _with(
    ["r_orders"],
    """
    , later AS (SELECT * REPLACE (CAST(ingestion_date + INTERVAL 365 DAY AS DATE) AS ingestion_date)
                FROM r_orders WHERE ingestion_date IS NOT NULL),
    feed AS (
        SELECT *, CASE WHEN ingestion_date >= DATE '2001-01-01' THEN 1 ELSE 0 END AS run FROM (
            SELECT * FROM r_orders
            UNION ALL SELECT * REPLACE ('S' AS order_status) FROM later WHERE order_status = 'P'
            UNION ALL SELECT * FROM later WHERE order_status = 'F'))"""
    + _two_runs("feed", "order_id", ORDER_ORDER, "order_status")
    + "SELECT * EXCLUDE (run), CAST(run AS INT) AS batch_id FROM latest",
)
SQL["silver_same_day"] = _with(
    ["r_orders"],
    """SELECT CAST(runs AS INT) AS runs, order_id,
              CASE WHEN ingestion_date IS NULL OR CAST(order_id AS BIGINT) % 3 <> 0 THEN order_status
                   WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN 'A' ELSE 'Z' END AS order_status, ingestion_date
       FROM r_orders, (VALUES (1), (2)) AS taken(runs)""",
)
SQL["silver_products_incremental"] = _with(
    ["r_product_rows"],
    """
    , feed AS (SELECT *, CASE WHEN ingestion_date >= DATE '2001-01-01' THEN 1 ELSE 0 END AS run
               FROM r_product_rows)"""
    + _two_runs("feed", "product_id", PRODUCT_ORDER, "price, stock, rating")
    + "SELECT * EXCLUDE (run), CAST(run AS INT) AS batch_id FROM latest",
)
SQL["late_dates_loaded"] = _with(
    ["r_orders"],
    """SELECT order_id, order_status,
              CASE WHEN ingestion_date IS NOT NULL AND CAST(order_id AS BIGINT) % 10 = 0 THEN NULL
                   ELSE ingestion_date END AS ingestion_date,
              CAST(ingestion_date IS NOT NULL AND CAST(order_id AS BIGINT) % 5 = 0 AS INT) AS batch_id
       FROM r_orders""",
)
SQL["silver_archived_deliveries"] = _with(
    ["r_orders"],
    """SELECT order_id, order_status, ingestion_date,
              CAST(ingestion_date IS NOT NULL AND CAST(order_id AS BIGINT) % 7 = 0 AS INT) AS batch_id
       FROM r_orders""",
)
# Items after two runs: an item is stored by the later one of its own run and its order's, and its latest
# version counts. `again` lists further deliveries: which rows come again, what is added to their price,
# and the run that brings them (NULL: their own).
def _stored_items(again: list[tuple[str, int, str]] = []) -> str:
    deliveries = "".join(
        f"""
        UNION ALL SELECT * REPLACE (CAST(price + {more} AS DECIMAL(18,2)) AS price,
            coalesce({run}, arrived_run) AS arrived_run, coalesce(10 * {run}, delivery) + {number} AS delivery)
        FROM first_time WHERE ingestion_date IS NOT NULL AND {which}"""
        for number, (which, more, run) in enumerate(again, 1)
    )
    return f"""
    , first_time AS (
        SELECT i.*, CASE WHEN i.shipping_limit_date < {SECOND} THEN 0 ELSE 1 END AS arrival_batch,
               CASE WHEN o.order_purchase_timestamp < {SECOND} THEN 0 ELSE 1 END AS order_batch,
               CASE WHEN i.shipping_limit_date < {SECOND} THEN 0 ELSE 1 END AS arrived_run,
               CASE WHEN i.ingestion_date IS NULL THEN -1 WHEN i.shipping_limit_date < {SECOND} THEN 0
                    ELSE 10 END AS delivery
        FROM r_items i JOIN r_orders o ON o.order_id = i.order_id),
    arrived AS (SELECT * FROM first_time{deliveries}),
    placed AS (SELECT *, greatest(arrived_run, order_batch) AS run FROM arrived)""" + _two_runs(
        "placed",
        "order_id, order_item_id",
        ITEM_ORDER.replace("LAST, ", "LAST, delivery DESC, ", 1),
        "product_id, seller_id, shipping_limit_date, price, freight_value",
        "coalesce(run1.ingestion_date, DATE '0001-01-01') > coalesce(run0.ingestion_date, DATE '0001-01-01')"
        " OR (run1.ingestion_date IS NOT DISTINCT FROM run0.ingestion_date AND run1.delivery >= run0.delivery)",
    ) + """,
    stored AS (SELECT *, run AS landed_batch FROM latest)"""


SQL["late_items_pending"] = _with(
    ["r_items", "r_orders"],
    _stored_items(
        [
            ("CAST(order_id AS BIGINT) % 4 = 1", 1, "NULL"),
            ("CAST(order_id AS BIGINT) % 4 = 3 AND arrival_batch = 0", 2, "1"),
        ]
    )
    + """
    SELECT order_id, order_item_id, product_id, shipping_limit_date, price,
           CAST(arrival_batch AS INT) AS arrival_batch, CAST(order_batch AS INT) AS order_batch,
           CAST(landed_batch AS INT) AS landed_batch,
           CAST(arrival_batch = order_batch AS INT) AS kept_by_ref
    FROM stored""",
)
SQL["conform_by_name"] = """
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
           c_mktsegment AS first_name, CAST(NULL AS VARCHAR) AS last_name,
           CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone,
           TRY_CAST(CASE WHEN c_mktsegment = 'BUILDING'
                         THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0') || '-x'
                         ELSE lpad(CAST(c_custkey AS VARCHAR), 5, '0') END AS INT)
             AS customer_zip_code_prefix,
           CAST(NULL AS VARCHAR) AS customer_city, CAST(NULL AS VARCHAR) AS customer_state,
           DATE '2001-02-03' AS ingestion_date
    FROM customer"""

SQL["conform_rejects"] = """
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, 'customer_zip_code_prefix' AS "column",
           lpad(CAST(c_custkey AS VARCHAR), 5, '0') || '-x' AS value, 'int' AS wanted
    FROM customer WHERE c_mktsegment = 'BUILDING'"""

# --- gold ------------------------------------------------------------------------------------

SQL["order_items_join"] = _with(
    ["r_orders", "r_items"],
    """SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date,
              i.price, i.freight_value, o.customer_id, o.order_purchase_timestamp,
              CAST(o.order_purchase_year AS VARCHAR) AS order_purchase_year
       FROM r_orders o JOIN r_items i ON o.order_id = i.order_id""",
)
SQL["order_items_payments_join"] = _with(
    ["r_orders", "r_items", "r_payments"],
    """SELECT o.order_id,
              COUNT(DISTINCT i.item) AS item_rows,
              COUNT(DISTINCT p.payment_sequential) AS payment_rows,
              COUNT(*) AS joined_rows,
              CAST(SUM(i.price) AS DECIMAL(28,2)) AS joined_price,
              CAST(SUM(p.payment_value) AS DECIMAL(28,2)) AS joined_payment
       FROM r_orders o
       JOIN (SELECT *, ROW_NUMBER() OVER () AS item FROM r_items) i ON o.order_id = i.order_id
       JOIN r_payments p ON o.order_id = p.order_id
       GROUP BY o.order_id""",
)
SQL["payment_windows"] = _with(
    ["r_payments"],
    """SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value,
              CAST(SUM(payment_value) OVER (PARTITION BY order_id) AS DECIMAL(28,2))
                AS order_payment_value,
              MAX(payment_type) OVER (PARTITION BY order_id) AS order_payment_type,
              MAX(payment_installments) OVER (PARTITION BY order_id) AS order_payment_installments
       FROM r_payments""",
)
SQL["fact_orders_ref"] = _with(["r_fact_ref"], f"SELECT {FACT_COLUMNS} FROM r_fact_ref")
SQL["fact_orders"] = _with(["r_fact"], f"SELECT {FACT_COLUMNS} FROM r_fact")
SQL["fact_self_dedup"] = _with(
    ["r_orders", "r_items", "r_paid"],
    f"""
    , lines AS (
        SELECT o.order_id, o.customer_id, i.product_id, o.order_purchase_timestamp,
               CAST(o.order_purchase_year AS VARCHAR) AS order_purchase_year, i.price,
               i.freight_value, p.payment_value, p.payment_type, p.payment_installments
        FROM r_orders o JOIN r_items i ON o.order_id = i.order_id
        JOIN r_paid p ON p.order_id = o.order_id)
    {_first("lines", "order_id, product_id",
            "order_purchase_timestamp DESC, customer_id, order_purchase_year, price,"
            " freight_value, payment_value, payment_type, payment_installments")}""",
)
SQL["fact_merge"] = SQL["fact_orders"]
SQL["dim_customers"] = _with(
    ["r_customer_rows"],
    f"""SELECT customer_id, customer_city, customer_state, first_name, last_name, email, phone
        FROM ({_first("r_customer_rows", "customer_id", CUSTOMER_ORDER)})""",
)
SQL["dim_products"] = _with(
    ["r_product_rows"],
    f"""SELECT product_id, product_category_name, price, rating, stock
        FROM ({_first("r_product_rows", "product_id", PRODUCT_ORDER)})""",
)

# --- analytics -------------------------------------------------------------------------------

SQL["order_payment_total"] = _with(
    ["r_items"],
    """SELECT order_id, CAST(ROUND(SUM(price + freight_value), 2) AS DECIMAL(38,2))
         AS payment_value FROM r_items GROUP BY order_id""",
)
SQL["shipping_limit"] = _with(
    ["r_orders"],
    """SELECT order_id, order_approved_at,
              order_approved_at + INTERVAL 2 DAY AS shipping_limit_date FROM r_orders""",
)
SQL["total_revenue_ref"] = _with(
    ["r_fact_ref"],
    "SELECT CAST(SUM(payment_value) AS DECIMAL(38,2)) AS total_revenue FROM r_fact_ref",
)
SQL["total_revenue"] = _with(
    ["r_fact"],
    """SELECT CAST(SUM(payment_value) AS DECIMAL(38,2)) AS total_revenue
       FROM (SELECT DISTINCT order_id, payment_value FROM r_fact)""",
)
SQL["top_products"] = _with(
    ["r_fact"],
    """SELECT product_id, CAST(SUM(price) AS DECIMAL(38,2)) AS revenue
       FROM r_fact GROUP BY product_id ORDER BY revenue DESC, product_id""",
)
SQL["top_products_k"] = SQL["top_products"] + " LIMIT 10"

SQL["kept_totals"] = _with(
    ["r_fact"],
    """SELECT measure, product_id, CAST(amount AS DECIMAL(38,2)) AS amount FROM (
         SELECT 'product' AS measure, product_id, SUM(price) AS amount
         FROM r_fact WHERE CAST(order_id AS BIGINT) % 5 != 0 GROUP BY product_id
         UNION ALL
         SELECT 'paid', NULL, SUM(payment_value) FROM (
           SELECT DISTINCT order_id, payment_value FROM r_fact WHERE CAST(order_id AS BIGINT) % 5 != 0)
         UNION ALL
         SELECT 'paid_ref', NULL, SUM(payment_value)
         FROM r_fact WHERE CAST(order_id AS BIGINT) % 5 != 0)""",
)

# --- streams ---------------------------------------------------------------------------------

SQL["stream_autoload"] = _with(
    ["r_orders"],
    """SELECT * REPLACE (CAST(order_purchase_year AS VARCHAR) AS order_purchase_year)
       FROM r_orders""",
)


def _changes(run: int, batch: int, side: str) -> str:
    tables = {
        "orders": ("r_orders", "order_purchase_timestamp"),
        "order_items": ("r_items", "shipping_limit_date"),
        "payments": ("r_payments", "paid_from"),
    }
    return "\nUNION ALL\n".join(
        f"""SELECT CAST({run} AS INT) AS run, CAST({batch} AS INT) AS batch_id,
            '{name}' AS changed_table, COUNT(DISTINCT order_id) AS changed_orders
            FROM {role} WHERE {moment} {side} {SECOND}"""
        for name, (role, moment) in tables.items()
    )


SQL["stream_change_gate"] = _with(
    ["r_orders", "r_items", "r_payments"], _changes(1, 0, "<") + "\nUNION ALL\n" + _changes(3, 1, ">=")
)
SQL["stream_fact_merge"] = SQL["fact_orders"]
SQL["daily_runs_fact"] = _with(
    ["r_items", "r_orders", "r_paid"],
    _stored_items()
    + f""",
    stored_fact AS ({ROLES["r_fact"].replace("r_items", "stored")})
    SELECT {FACT_COLUMNS} FROM stored_fact""",
)
SQL["daily_runs_dims"] = _with(
    ["r_customer_rows", "r_product_rows"],
    f"""SELECT 'product' AS dimension, product_id AS key, product_category_name AS name,
               CAST(NULL AS VARCHAR) AS city, price, stock, rating
        FROM ({_first("r_product_rows", "product_id", PRODUCT_ORDER)})
        UNION ALL
        SELECT 'customer', customer_id, last_name, customer_city, NULL, NULL, NULL
        FROM ({_first("r_customer_rows", "customer_id", CUSTOMER_ORDER)})""",
)
# The order's own run stays that of its first delivery, so the items stored are the same.
SQL["stream_fact_order_moved"] = _with(
    ["r_items", "r_orders", "r_paid"],
    _stored_items([("CAST(order_id AS BIGINT) % 3 = 0 AND arrival_batch = 0", 2, "1")])
    + f""",
    timed AS (SELECT *, CASE WHEN ingestion_date IS NOT NULL AND order_purchase_timestamp < {SECOND}
                            AND CAST(order_id AS BIGINT) % 3 = 0
                          THEN order_purchase_timestamp + INTERVAL 14 MONTH
                          ELSE order_purchase_timestamp END AS bought FROM r_orders),
    moved AS (SELECT * EXCLUDE (bought) REPLACE (bought AS order_purchase_timestamp,
                     CAST(year(bought) AS INT) AS order_purchase_year) FROM timed),
    moved_fact AS ({ROLES["r_fact"].replace("r_items", "stored").replace("r_orders", "moved")})
    SELECT {FACT_COLUMNS} FROM moved_fact""",
)
