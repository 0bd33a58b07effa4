"""Independent SQL (DuckDB dialect) for every registered query.

The business collections are re-derived here from the raw test tables with
their own SQL, so a mapping bug on either side shows up as a mismatch.
"""

from __future__ import annotations

from strata.plans import business as B
from strata.rules import OPEN_END

# --- fixed values of the registered queries (shared with strata.plans.queries) ---
EVENT_WINDOW = ("2024-01-08 00:00:00", "2024-01-22 00:00:00")
SCAN_PARTITION = "1998-03-01"
SNAPSHOT_CUTOFFS = ("2001-07-15", "2001-08-01")
TREND_AS_OF = "2001-08-01"
TREND_START = "2001-07-02"  # TREND_AS_OF minus 30 days
LAKE_ROOT = "/lake"
ONBOARDING = (("suppliers", "supplier_id", "updated_at", 1), ("reviews", "review_id", "updated_at", 2))
# --- end of fixed values ---

# --------------------------------------------------------------------------
# shared CTEs
# --------------------------------------------------------------------------

CUSTOMERS_RAW = """
cust_raw AS (
  SELECT
    CASE WHEN c.c_acctbal BETWEEN -800 AND -700 THEN NULL ELSE CAST(c.c_custkey AS VARCHAR) END AS customer_id,
    split_part(c.c_name, '#', 1) AS first_name,
    CASE WHEN c.c_acctbal > 9500 THEN NULL ELSE split_part(c.c_name, '#', 2) END AS last_name,
    CASE WHEN c.c_acctbal < -800 THEN NULL
         WHEN c.c_acctbal < 0 THEN '  ' || upper('customer' || CAST(c.c_custkey AS VARCHAR) || '@example.com') || ' '
         WHEN c.c_acctbal BETWEEN 9000 AND 9500 THEN '   '
         ELSE 'customer' || CAST(c.c_custkey AS VARCHAR) || '@example.com' END AS email,
    CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN ' ' || c.c_mktsegment || ' ' ELSE c.c_mktsegment END AS status,
    n.n_name AS country,
    CASE WHEN c.c_mktsegment = 'AUTOMOBILE' AND c.c_acctbal > 9000 THEN 'not-a-timestamp'
         ELSE CAST(DATE '2023-01-01' + c.c_nationkey * 10 AS VARCHAR) || ' 08:30:00' END AS created_at,
    CAST(DATE '2023-01-01' + c.c_nationkey * 10 AS VARCHAR) || ' 08:30:00' AS updated_at,
    CASE WHEN c.c_mktsegment = 'MACHINERY' AND c.c_acctbal > 9000 THEN 'n/a'
         ELSE CAST(c.c_acctbal AS VARCHAR) END AS acctbal
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

CUSTOMERS = CUSTOMERS_RAW + """,
cust AS (
  SELECT customer_id,
         trim(first_name) AS first_name, trim(last_name) AS last_name,
         lower(trim(email)) AS email, lower(trim(status)) AS status, trim(country) AS country,
         TRY_CAST(created_at AS TIMESTAMP) AS created_at, TRY_CAST(updated_at AS TIMESTAMP) AS updated_at,
         acctbal,
         concat(coalesce(trim(first_name), ''), ' ', coalesce(trim(last_name), '')) AS full_name
  FROM cust_raw
  WHERE customer_id IS NOT NULL AND email IS NOT NULL
)"""

_STATUS_V1 = """CASE o_orderstatus
      WHEN 'F' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'delivered' ELSE 'completed' END
      WHEN 'O' THEN 'processing' WHEN 'P' THEN 'cancelled' END"""
_TOUCHED = "(o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH'))"

ORDERS_V1 = f"""
ord_src1 AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         {_STATUS_V1} AS status,
         o_totalprice AS total_amount, 'USD' AS currency, o_orderdate AS created_at, o_orderdate AS updated_at
  FROM orders
)"""

ORDERS_V2 = f"""
ord_src2 AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN {_TOUCHED} THEN 'completed' ELSE {_STATUS_V1} END AS status,
         o_totalprice AS total_amount, 'USD' AS currency, o_orderdate AS created_at,
         CASE WHEN {_TOUCHED} THEN o_orderdate + INTERVAL {B.CHANGE_DELAY_DAYS} DAY ELSE o_orderdate END AS updated_at
  FROM orders
)"""

ORDERS = ORDERS_V1 + """,
ord AS (
  SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id, lower(trim(status)) AS status,
         CAST(total_amount AS DOUBLE) AS total_amount, trim(currency) AS currency, created_at, updated_at
  FROM ord_src1
  WHERE order_id IS NOT NULL AND customer_id IS NOT NULL
)"""

# Exact sums: whole multiples of 2^-64 (no amount has lower bits), rounded once
# when the total is read as a double.
ORDER_AGG = """
ord_agg AS (
  SELECT customer_id,
         count(order_id) AS total_orders,
         CAST(CAST(sum(CAST(total_amount * power(2, 64) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / power(2, 64) AS total_revenue,
         CAST(CAST(sum(CAST(total_amount * power(2, 64) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / power(2, 64) / count(total_amount) AS avg_order_value,
         min(created_at) AS first_order_date,
         max(created_at) AS last_order_date
  FROM ord
  WHERE status IN ('completed', 'delivered')
  GROUP BY customer_id
)"""

# Thresholds used by the registered customer queries (scaled to the test
# data's order values; the reference defaults are unit-tested separately).
REVENUE_TIERS_TEST = ((2500000.0, "Platinum"), (1500000.0, "Gold"), (750000.0, "Silver"))

SEGMENTS = """
    CASE WHEN a.total_revenue > 2500000 THEN 'Platinum'
         WHEN a.total_revenue > 1500000 THEN 'Gold'
         WHEN a.total_revenue > 750000 THEN 'Silver'
         ELSE 'Bronze' END AS customer_segment,
    CASE WHEN a.total_orders >= 10 THEN 'High'
         WHEN a.total_orders >= 3 THEN 'Medium'
         ELSE 'Low' END AS lifetime_value_tier"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


SQL: dict[str, str] = {}

SQL["customer_order_agg"] = _with(ORDERS, ORDER_AGG) + "\nSELECT * FROM ord_agg"

SQL["customer_segments"] = _with(CUSTOMERS, ORDERS, ORDER_AGG) + f"""
SELECT c.customer_id, {SEGMENTS}
FROM cust c LEFT JOIN ord_agg a ON c.customer_id = a.customer_id"""

SQL["customer_sales_summary"] = _with(CUSTOMERS, ORDERS, ORDER_AGG) + f"""
SELECT c.customer_id,
       coalesce(c.full_name, concat_ws(' ', c.first_name, c.last_name)) AS full_name,
       c.email, c.country,
       coalesce(a.total_orders, 0) AS total_orders,
       coalesce(a.total_revenue, CAST(0 AS DOUBLE)) AS total_revenue,
       coalesce(a.avg_order_value, CAST(0 AS DOUBLE)) AS avg_order_value,
       a.first_order_date, a.last_order_date,
       {SEGMENTS}
FROM cust c LEFT JOIN ord_agg a ON c.customer_id = a.customer_id"""


# --------------------------------------------------------------------------
# helpers
# --------------------------------------------------------------------------

def _half_up_mean(col: str, scale: int) -> str:
    """round(avg(col), scale) with HALF_UP on the exact mean of the values
    taken at 6 decimals, in integer arithmetic (positive values)."""
    unit = 10 ** (6 - scale)
    micro = f"CAST(round({col} * 1000000) AS BIGINT)"
    return (
        f"CAST((2 * sum({micro}) + count({col}) * {unit}) // (2 * count({col}) * {unit}) AS DOUBLE)"
        f" / {10 ** scale}.0"
    )


def _ts(v: str) -> str:
    return f"TIMESTAMP '{v}'"


def md5_compat(cols: list[str]) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in sorted(cols))
    return f"md5(concat_ws('|', {parts}))"


def md5_safe(cols: list[str]) -> str:
    parts = ", ".join(
        f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '~')"
        for c in sorted(cols)
    )
    return f"md5(concat_ws('|', {parts}))"


ORDER_COLS = ["order_id", "customer_id", "status", "total_amount", "currency", "created_at", "updated_at"]
ORDER_LIST = ", ".join(ORDER_COLS)

BATCHES = ORDERS_V1 + "," + ORDERS_V2 + f""",
b1 AS (SELECT * FROM ord_src1 WHERE updated_at > {_ts(B.EPOCH)} AND updated_at <= {_ts(B.BATCH1_UPPER)}),
b2 AS (SELECT * FROM ord_src2 WHERE updated_at > {_ts(B.BATCH2_LOWER)} AND updated_at <= {_ts(B.BATCH2_UPPER)}),
h1 AS (SELECT *, {md5_compat(ORDER_COLS)} AS record_hash FROM b1),
h2 AS (SELECT *, {md5_compat(ORDER_COLS)} AS record_hash FROM b2)"""

L1_DATE, L1_TS = B.LOAD1
L2_DATE, L2_TS = B.LOAD2

SCD2 = BATCHES + f""",
cur AS (
  SELECT h1.*, {_ts(L1_TS)} AS effective_date, {_ts(OPEN_END)} AS expiry_date, true AS is_current,
         CAST(1 AS INTEGER) AS version_number, {_ts(L1_TS)} AS pipeline_load_ts, '{L1_DATE}' AS load_date
  FROM h1
),
kept AS (
  SELECT cur.* FROM cur LEFT JOIN h2 ON cur.order_id = h2.order_id
  WHERE h2.order_id IS NULL OR h2.record_hash = cur.record_hash
),
closed AS (
  SELECT cur.* REPLACE ({_ts(L2_TS)} AS expiry_date, false AS is_current)
  FROM cur JOIN h2 ON cur.order_id = h2.order_id
  WHERE h2.record_hash <> cur.record_hash
),
opened AS (
  SELECT h2.*, {_ts(L2_TS)} AS effective_date, {_ts(OPEN_END)} AS expiry_date, true AS is_current,
         CAST(coalesce(cur.version_number, 0) + 1 AS INTEGER) AS version_number,
         {_ts(L2_TS)} AS pipeline_load_ts, '{L2_DATE}' AS load_date
  FROM h2 LEFT JOIN cur ON cur.order_id = h2.order_id
  WHERE cur.order_id IS NULL OR cur.record_hash <> h2.record_hash
),
scd2_full AS (SELECT * FROM kept UNION ALL SELECT * FROM closed UNION ALL SELECT * FROM opened)"""

LINES = """
lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_quantity AS INTEGER) AS qty, l_extendedprice AS unit_price, l_discount AS discount
  FROM lineitem
),
exploded AS (
  SELECT o.order_id, l.product_id, l.qty, l.unit_price FROM ord o LEFT JOIN lines l ON o.order_id = l.order_id
),
item_agg AS (
  SELECT product_id, CAST(sum(qty) AS BIGINT) AS total_units_sold,
         CAST(CAST(sum(CAST(qty * unit_price * power(2, 64) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / power(2, 64) AS total_revenue
  FROM exploded GROUP BY product_id
)"""

PRODUCTS = """
prod AS (
  SELECT trim(CAST(p_partkey AS VARCHAR)) AS product_id, trim(p_name) AS name,
         trim(CASE WHEN p_size > 48 THEN NULL ELSE p_type END) AS category, trim(p_brand) AS sub_category,
         CAST(p_retailprice AS DOUBLE) AS price, CAST(p_size AS DOUBLE) AS stock_qty, 'active' AS status,
         TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM part
  WHERE p_partkey IS NOT NULL AND p_name IS NOT NULL
)"""

REVIEWS = """
rev AS (
  SELECT trim(CAST(event_id AS VARCHAR)) AS review_id, trim(json_extract_string(props, '$.k')) AS product_id,
         trim(CAST(user_id AS VARCHAR)) AS customer_id, CAST(event_id % 5 + 1 AS DOUBLE) AS rating,
         lower(trim(event_type)) AS status, ts AS created_at
  FROM events
  WHERE event_id IS NOT NULL AND json_extract_string(props, '$.k') IS NOT NULL AND user_id IS NOT NULL
),
rev_agg AS (
  SELECT product_id, avg(rating) AS avg_rating, count(review_id) AS review_count,
         CAST((200 * CAST(sum(rating) AS BIGINT) + count(rating)) // (2 * count(rating)) AS DOUBLE) / 100.0
           AS avg_rating_2
  FROM rev GROUP BY product_id
)"""

ANALYTICS = """
analytics AS (
  SELECT strftime(o.created_at, '%Y-%m-%d') AS order_date, c.country, 'ALL' AS category,
         count(o.order_id) AS total_orders,
         count(*) FILTER (WHERE o.status = 'completed') AS completed_orders,
         count(*) FILTER (WHERE o.status = 'cancelled') AS cancelled_orders,
         CAST(CAST(sum(CAST(o.total_amount * power(2, 64) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / power(2, 64) AS total_revenue,
         CAST(CAST(sum(CAST(o.total_amount * power(2, 64) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / power(2, 64) / count(o.total_amount) AS avg_order_value,
         CAST((20000 * count(*) FILTER (WHERE o.status = 'completed') + count(o.order_id))
              // (2 * count(o.order_id)) AS DOUBLE) / 10000.0 AS completion_rate
  FROM ord_snap o LEFT JOIN cust c ON o.customer_id = c.customer_id
  GROUP BY 1, 2
)"""


def _ord_until(day: str) -> str:
    return f"ord_snap AS (SELECT * FROM ord WHERE created_at <= TIMESTAMP '{day} 23:59:59')"


AUDIT = """
audit AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id,
         CASE WHEN k < 20 THEN 'customers' WHEN k < 40 THEN 'orders' WHEN k < 60 THEN 'products'
              WHEN k < 80 THEN 'payments' ELSE 'reviews' END AS collection_name,
         CASE WHEN event_type IN ('click', 'purchase') THEN 'bronze'
              WHEN event_type IN ('view', 'signup') THEN 'silver' ELSE 'gold' END AS layer,
         ts AS pipeline_start_time,
         CAST(value AS DECIMAL(10, 2)) AS duration_seconds,
         CAST(floor(value * 10) AS BIGINT) AS records_extracted,
         CASE WHEN event_type = 'error' THEN CAST(0 AS BIGINT) ELSE CAST(floor(value * 10) AS BIGINT) END AS records_loaded,
         CASE WHEN event_type = 'error' THEN 'FAILED' WHEN value < 1 THEN 'RUNNING' ELSE 'SUCCESS' END AS status
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""


def _spec_values() -> str:
    from strata.rules import COLLECTIONS, GOLD_MARTS

    rows = []
    for s in COLLECTIONS.values():
        gold = f"'{LAKE_ROOT}/gold/{GOLD_MARTS[s.name]}'" if s.name in GOLD_MARTS else "NULL"
        rows.append(
            f"('{s.name}', '{s.source_database}', '{s.watermark_column}', {s.scd_type}, '{s.primary_key}', true, "
            f"'{LAKE_ROOT}/bronze/{s.name}', '{LAKE_ROOT}/silver/{s.name}', {gold}, 'load_date', '1.0')"
        )
    return ",\n    ".join(rows)


REGISTRY = CUSTOMERS + "," + ORDERS_V1 + f""",
specs AS (
  SELECT * FROM (VALUES
    {_spec_values()}
  ) t(collection_name, source_database, watermark_column, scd_type, primary_key_column, active_flag,
      bronze_path, silver_path, gold_path, partition_column, schema_version)
),
marks AS (
  SELECT 'customers' AS collection_name, max(updated_at) AS mark FROM cust
  UNION ALL SELECT 'orders', max(updated_at) FROM ord_src1
  UNION ALL SELECT 'products', max(TIMESTAMP '2024-01-01 00:00:00') FROM part
  UNION ALL SELECT 'payments', max(ts) FROM events WHERE event_type = 'purchase'
  UNION ALL SELECT 'reviews', max(ts) FROM events
),
registry AS (
  SELECT s.*, coalesce(m.mark, TIMESTAMP '1970-01-01 00:00:00') AS last_loaded_timestamp,
         {_ts(L1_TS)} AS created_at, {_ts(L1_TS)} AS updated_at
  FROM specs s LEFT JOIN marks m ON s.collection_name = m.collection_name
)"""


# --------------------------------------------------------------------------
# per-key SQL
# --------------------------------------------------------------------------

SQL["incremental_extract"] = (
    f"SELECT * FROM events WHERE ts > {_ts(EVENT_WINDOW[0])} AND ts <= {_ts(EVENT_WINDOW[1])}"
)

SQL["incremental_extract_source"] = SQL["incremental_extract"]

SQL["bronze_partition_scan"] = _with(ORDERS_V1) + f"""
SELECT *, strftime(created_at, '%Y-%m-01') AS load_date FROM ord_src1
WHERE strftime(created_at, '%Y-%m-01') = '{SCAN_PARTITION}'"""

SQL["merge_schema_scan"] = _with(ORDERS_V1) + f"""
SELECT *, CAST(NULL AS VARCHAR) AS channel, '{L1_DATE}' AS load_date FROM ord_src1
WHERE created_at < TIMESTAMP '1998-01-01 00:00:00'
UNION ALL
SELECT *, CASE WHEN total_amount > 250000 THEN 'web' ELSE 'store' END, '{L2_DATE}' FROM ord_src1
WHERE created_at >= TIMESTAMP '1998-01-01 00:00:00'"""

_ISO_MS = "'%Y-%m-%dT%H:%M:%S.%g'"  # JSON timestamp rendering: ISO date, T, milliseconds
_RAW_DOCUMENT = ", ".join(
    f"'{c}', strftime({c}, {_ISO_MS})" if c in ("created_at", "updated_at") else f"'{c}', {c}" for c in ORDER_COLS
)
SQL["bronze_enrich"] = _with(ORDERS_V1) + f"""
SELECT *, CAST(json_object({_RAW_DOCUMENT}) AS VARCHAR) AS raw_document,
       '{L1_DATE}' AS load_date, {_ts(L1_TS)} AS pipeline_load_ts, 'orders' AS source_collection
FROM ord_src1"""

SQL["conform_contract"] = _with(ORDERS_V1) + """
SELECT order_id, customer_id, status, total_amount, CAST(NULL AS VARCHAR) AS currency,
       CAST(NULL AS INTEGER) AS items_count, CAST(NULL AS INTEGER) AS total_items_qty,
       CAST(NULL AS VARCHAR) AS shipping_city, CAST(NULL AS VARCHAR) AS shipping_country,
       created_at, updated_at, CAST(NULL AS VARCHAR) AS record_hash,
       CAST(NULL AS TIMESTAMP) AS pipeline_load_ts, CAST(NULL AS VARCHAR) AS load_date
FROM ord_src1"""

SQL["cleanse_required"] = _with(CUSTOMERS_RAW) + """
SELECT * FROM cust_raw WHERE customer_id IS NOT NULL AND email IS NOT NULL"""

SQL["cleanse_strings"] = _with(CUSTOMERS_RAW) + """
SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name, lower(trim(email)) AS email,
       lower(trim(status)) AS status, trim(country) AS country, created_at, updated_at, acctbal
FROM cust_raw"""

SQL["cleanse_casts"] = _with(CUSTOMERS_RAW) + """
SELECT customer_id, first_name, last_name, email, status, country,
       TRY_CAST(created_at AS TIMESTAMP) AS created_at, TRY_CAST(updated_at AS TIMESTAMP) AS updated_at,
       TRY_CAST(acctbal AS DOUBLE) AS acctbal
FROM cust_raw"""

SQL["cleanse_customers"] = _with(CUSTOMERS) + "\nSELECT * FROM cust"

SQL["derived_columns"] = _with(CUSTOMERS_RAW) + """
SELECT *, concat(coalesce(first_name, ''), ' ', coalesce(last_name, '')) AS full_name FROM cust_raw"""

SQL["dedupe_latest"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey
    ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC,
             l_quantity DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
  FROM lineitem
) WHERE rn = 1"""

SQL["dedupe_any"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey
    ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus, l_shipdate) AS rn
  FROM lineitem
) WHERE rn = 1"""

_CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
SQL["row_fingerprint"] = f"""
SELECT *, {md5_compat(_CUSTOMER_COLS)} AS record_hash, {md5_safe(_CUSTOMER_COLS)} AS record_hash_safe
FROM customer"""

# JSON rendering of the name-sorted row (NULL fields kept as null)
_JSON_ARGS = ", ".join(f"'{c}', {c}" for c in sorted(_CUSTOMER_COLS))
SQL["row_fingerprint_json"] = f"""
SELECT *, md5(CAST(json_object({_JSON_ARGS}) AS VARCHAR)) AS record_hash FROM customer"""

SQL["change_detection"] = _with(BATCHES) + """
SELECT h2.order_id,
       CASE WHEN c.order_id IS NULL THEN 'new' WHEN h2.record_hash = c.record_hash THEN 'unchanged'
            ELSE 'changed' END AS change_type,
       CAST(CASE WHEN c.order_id IS NOT NULL THEN 1 END AS INTEGER) AS previous_version,
       c.record_hash AS previous_hash, h2.record_hash
FROM h2 LEFT JOIN h1 c ON h2.order_id = c.order_id"""

_UNTOUCHED = "SELECT * FROM b1 WHERE NOT EXISTS (SELECT 1 FROM b2 WHERE b2.order_id = b1.order_id)"

SQL["anti_join_untouched"] = _with(BATCHES) + "\n" + _UNTOUCHED

SQL["union_by_name"] = _with(BATCHES) + f"""
SELECT {ORDER_LIST}, CAST(NULL AS VARCHAR) AS channel FROM ({_UNTOUCHED})
UNION ALL
SELECT order_id, customer_id, status, total_amount, CAST(NULL AS VARCHAR), created_at, updated_at, 'web' FROM b2"""

SQL["scd1_upsert"] = _with(BATCHES) + f"""
SELECT {ORDER_LIST}, {_ts(L1_TS)} AS pipeline_load_ts, '{L1_DATE}' AS load_date FROM ({_UNTOUCHED})
UNION ALL
SELECT {ORDER_LIST}, {_ts(L2_TS)}, '{L2_DATE}' FROM b2"""

SQL["scd2_initial"] = _with(SCD2) + "\nSELECT * FROM cur"
SQL["scd2_merge"] = _with(SCD2) + "\nSELECT * FROM scd2_full"
SQL["scd2_expired_rows"] = _with(SCD2) + "\nSELECT * FROM closed"
SQL["scd2_current_snapshot"] = _with(SCD2) + "\nSELECT * FROM kept UNION ALL SELECT * FROM opened"
SQL["scd2_as_of"] = _with(SCD2) + f"""
SELECT * FROM scd2_full WHERE effective_date <= {_ts(B.AS_OF_BETWEEN)} AND {_ts(B.AS_OF_BETWEEN)} < expiry_date"""
SQL["bronze_then_silver"] = SQL["scd2_merge"]

SQL["schema_drift_events"] = _with(BATCHES) + """
SELECT 'orders' AS collection_name, t.*, false AS resolved, n.rows_affected FROM (VALUES
  ('ADD_COLUMN', 'channel', NULL, 'string'),
  ('DROP_COLUMN', 'currency', 'string', NULL),
  ('TYPE_CHANGE', 'customer_id', 'string', 'bigint')
) t(change_type, column_name, old_type, new_type)
JOIN (
  SELECT 'channel' AS c, count(*) AS rows_affected FROM b2 UNION ALL
  SELECT 'currency', count(currency) FROM b1 UNION ALL
  SELECT 'customer_id', count(CAST(customer_id AS BIGINT)) FROM b2
) n ON n.c = t.column_name"""

SQL["schema_reconcile"] = _with(BATCHES) + f"""
SELECT {ORDER_LIST}, CAST(NULL AS VARCHAR) AS channel FROM b1
UNION ALL
SELECT order_id, CAST(CAST(customer_id AS BIGINT) AS VARCHAR), status, total_amount, CAST(NULL AS VARCHAR),
       created_at, updated_at, CASE WHEN total_amount > 250000 THEN 'web' ELSE 'store' END
FROM b2"""

SQL["schema_reconcile_nested"] = """
WITH c AS (SELECT c_custkey AS k, c_nationkey AS n, c_acctbal AS b, c_mktsegment = 'BUILDING' AS odd FROM customer)
SELECT 'existing' AS side, CAST(k AS VARCHAR) AS id, CAST(k AS INTEGER) AS points, k * 1000003 AS big,
       CAST(CAST(b AS DECIMAL(10,2)) AS DOUBLE) AS amount, 'city' || n AS city, CAST(n AS INTEGER) AS zip, CAST(NULL AS DOUBLE) AS lat,
       CAST(n AS BIGINT) AS tag, CAST(n AS DOUBLE) AS attr, n AS code,
       NULL AS lost_points, NULL AS lost_big, NULL AS lost_zip, NULL AS lost_codes, CAST(0 AS INTEGER) AS n_lost
FROM c
UNION ALL
SELECT 'incoming', CAST(k AS VARCHAR), CASE WHEN NOT odd THEN CAST(k AS INTEGER) END,
       CASE WHEN b = floor(b) THEN CAST(b AS BIGINT) END, CAST(CAST(b + 0.0025 AS DECIMAL(20,4)) AS DOUBLE), NULL,
       CASE WHEN NOT odd THEN CAST(n AS INTEGER) END, b, n + 5000000000, b, CASE WHEN NOT odd THEN n END,
       CASE WHEN odd THEN 'many' END, CASE WHEN b <> floor(b) THEN CAST(b AS VARCHAR) END, CASE WHEN odd THEN 'Z' || n END,
       CASE WHEN odd THEN '{"k":' || CAST(n + 0.5 AS DOUBLE) || '}' END,
       CAST(CASE WHEN odd THEN 3 ELSE 0 END + CASE WHEN b <> floor(b) THEN 1 ELSE 0 END AS INTEGER)
FROM c"""

SQL["exact_money_sum"] = """
SELECT o_orderstatus, o_orderpriority, count(*) AS n,
       CAST(CAST(sum(CAST(x * power(2, 64) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / power(2, 64) AS total
FROM (
  SELECT *, o_totalprice * [1e-6, 1e-5, 1e-4, 1e-3, 1e-2, 1e-1, 1e0, 1e1, 1e2, 1e3, 1e4, 1e5, 1e6][o_orderkey % 13 + 1]
            * CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END AS x
  FROM orders)
GROUP BY o_orderstatus, o_orderpriority"""

SQL["customer_order_agg_incremental"] = _with(SCD2, "ord AS (SELECT * FROM scd2_full WHERE is_current)", ORDER_AGG) + (
    "\nSELECT * FROM ord_agg"
)

SQL["order_analytics_incremental"] = _with(
    CUSTOMERS, SCD2, "ord_snap AS (SELECT * FROM scd2_full WHERE is_current)", ANALYTICS
) + "\nSELECT * FROM analytics"

SQL["scd2_bucketed_merge"] = SQL["scd2_merge"]
SQL["scd2_merge_colocated"] = SQL["scd2_merge"]
SQL["scd2_as_of_pruned"] = SQL["scd2_as_of"]

SQL["order_items_explode"] = _with(ORDERS, LINES) + "\nSELECT * FROM exploded"

SQL["order_item_features"] = _with(ORDERS, LINES) + """
SELECT o.*, CAST(coalesce(a.n, 0) AS INTEGER) AS items_count, CAST(coalesce(a.q, 0) AS INTEGER) AS total_items_qty
FROM ord o LEFT JOIN (
  SELECT order_id, count(*) AS n, sum(coalesce(qty, 0)) AS q FROM lines GROUP BY order_id
) a ON o.order_id = a.order_id"""

SQL["product_item_agg"] = _with(ORDERS, LINES) + "\nSELECT * FROM item_agg"

SQL["product_review_agg"] = _with(REVIEWS) + "\nSELECT * EXCLUDE (avg_rating_2) FROM rev_agg"

SQL["rank_in_category"] = _with(ORDERS, LINES, PRODUCTS) + """
SELECT p.product_id, p.category, coalesce(a.total_revenue, CAST(0 AS DOUBLE)) AS total_revenue,
       CAST(rank() OVER (PARTITION BY p.category ORDER BY coalesce(a.total_revenue, CAST(0 AS DOUBLE)) DESC)
            AS INTEGER) AS rank_in_category
FROM prod p LEFT JOIN item_agg a ON p.product_id = a.product_id"""

SQL["top_products"] = _with(ORDERS, LINES, PRODUCTS, REVIEWS) + """
SELECT p.product_id, p.name AS product_name, p.category, p.sub_category,
       CAST(coalesce(a.total_units_sold, 0) AS BIGINT) AS total_units_sold,
       coalesce(a.total_revenue, CAST(0 AS DOUBLE)) AS total_revenue,
       coalesce(r.avg_rating_2, CAST(0 AS DOUBLE)) AS avg_rating,
       CAST(coalesce(r.review_count, 0) AS BIGINT) AS review_count,
       CAST(0 AS DOUBLE) AS return_rate,
       CAST(rank() OVER (PARTITION BY p.category ORDER BY coalesce(a.total_revenue, CAST(0 AS DOUBLE)) DESC)
            AS INTEGER) AS rank_in_category
FROM prod p LEFT JOIN item_agg a ON p.product_id = a.product_id LEFT JOIN rev_agg r ON p.product_id = r.product_id"""

SQL["order_analytics"] = _with(CUSTOMERS, ORDERS, "\nord_snap AS (SELECT * FROM ord)", ANALYTICS) + (
    "\nSELECT * FROM analytics"
)

SQL["top_customers_latest"] = _with(CUSTOMERS, ORDERS, _ord_until(SNAPSHOT_CUTOFFS[-1])) + f"""
, snap_agg AS (
  SELECT customer_id, count(order_id) AS total_orders,
         CAST(CAST(sum(CAST(total_amount * power(2, 64) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / power(2, 64) AS total_revenue
  FROM ord_snap WHERE status IN ('completed', 'delivered') GROUP BY customer_id
)
SELECT c.customer_id, coalesce(c.full_name, concat_ws(' ', c.first_name, c.last_name)) AS full_name, c.country,
       coalesce(a.total_orders, 0) AS total_orders,
       round(coalesce(a.total_revenue, CAST(0 AS DOUBLE)), 2) AS revenue,
       CASE WHEN a.total_orders >= 10 THEN 'High' WHEN a.total_orders >= 3 THEN 'Medium' ELSE 'Low' END
         AS lifetime_value_tier
FROM cust c LEFT JOIN snap_agg a ON c.customer_id = a.customer_id
ORDER BY coalesce(a.total_revenue, CAST(0 AS DOUBLE)) DESC, c.customer_id
LIMIT 10"""

SQL["daily_order_trend"] = _with(CUSTOMERS, ORDERS, _ord_until(SNAPSHOT_CUTOFFS[-1]), ANALYTICS) + f"""
SELECT order_date, CAST(sum(total_orders) AS BIGINT) AS orders,
       round(CAST(CAST(sum(CAST(total_revenue * power(2, 64) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / power(2, 64), 2) AS revenue,
       {_half_up_mean("avg_order_value", 2)} AS aov
FROM analytics
WHERE order_date >= '{TREND_START}' AND order_date <= '{TREND_AS_OF}'
GROUP BY order_date ORDER BY order_date"""

SQL["active_collections"] = _with(REGISTRY) + """
SELECT collection_name, watermark_column, last_loaded_timestamp, scd_type, primary_key_column,
       bronze_path, silver_path, gold_path
FROM registry WHERE active_flag ORDER BY collection_name"""

SQL["watermark_status"] = _with(REGISTRY) + """
SELECT collection_name, last_loaded_timestamp, active_flag FROM registry ORDER BY collection_name"""


def _requests_values() -> str:
    rows = []
    for name, pk, wm, scd_type in ONBOARDING:
        rows.append(f"('{name}', '{pk}', '{wm}', {scd_type})")
    return ", ".join(rows)


SQL["registry_upsert"] = _with(REGISTRY) + f""",
req AS (
  SELECT * FROM (VALUES {_requests_values()}) t(collection_name, primary_key_column, watermark_column, scd_type)
)
SELECT r.collection_name, r.source_database,
       coalesce(q.watermark_column, r.watermark_column) AS watermark_column,
       coalesce(q.scd_type, r.scd_type) AS scd_type,
       coalesce(q.primary_key_column, r.primary_key_column) AS primary_key_column,
       CASE WHEN q.collection_name IS NOT NULL THEN true ELSE r.active_flag END AS active_flag,
       r.bronze_path, r.silver_path, r.gold_path, r.partition_column, r.schema_version,
       r.last_loaded_timestamp, r.created_at,
       CASE WHEN q.collection_name IS NOT NULL THEN {_ts(L2_TS)} ELSE r.updated_at END AS updated_at
FROM registry r LEFT JOIN req q ON r.collection_name = q.collection_name
UNION ALL
SELECT q.collection_name, 'enterprise_db', q.watermark_column, q.scd_type, q.primary_key_column, true,
       '{LAKE_ROOT}/bronze/' || q.collection_name, '{LAKE_ROOT}/silver/' || q.collection_name, NULL,
       'load_date', '1.0', TIMESTAMP '1970-01-01 00:00:00', {_ts(L2_TS)}, {_ts(L2_TS)}
FROM req q WHERE q.collection_name NOT IN (SELECT collection_name FROM registry)"""

SQL["advance_watermark"] = _with(REGISTRY, ORDERS_V2) + f""",
b2 AS (SELECT * FROM ord_src2 WHERE updated_at > {_ts(B.BATCH2_LOWER)} AND updated_at <= {_ts(B.BATCH2_UPPER)})
SELECT r.* REPLACE (
         CASE WHEN r.collection_name = 'orders' AND r.active_flag
                   AND (SELECT max(updated_at) FROM b2) > r.last_loaded_timestamp
              THEN (SELECT max(updated_at) FROM b2) ELSE r.last_loaded_timestamp END AS last_loaded_timestamp,
         CASE WHEN r.collection_name = 'orders' AND r.active_flag
                   AND (SELECT max(updated_at) FROM b2) > r.last_loaded_timestamp
              THEN {_ts(L2_TS)} ELSE r.updated_at END AS updated_at)
FROM registry r"""

SQL["run_summary"] = _with(AUDIT) + """
SELECT collection_name, layer, count(*) AS total_runs,
       CAST(sum(records_extracted) AS BIGINT) AS total_extracted,
       CAST(sum(records_loaded) AS BIGINT) AS total_loaded,
       count(*) FILTER (WHERE status = 'SUCCESS') AS successful_runs,
       count(*) FILTER (WHERE status = 'FAILED') AS failed_runs,
       max(pipeline_start_time) AS last_run
FROM audit GROUP BY collection_name, layer ORDER BY collection_name, layer"""

SQL["recent_runs"] = _with(AUDIT) + """
SELECT run_id, collection_name, layer, status, records_loaded, pipeline_start_time, duration_seconds
FROM audit ORDER BY pipeline_start_time DESC, run_id DESC LIMIT 50"""

SQL["batch_metrics"] = _with(CUSTOMERS_RAW) + """
SELECT count(*) AS rows_in,
       count(*) FILTER (WHERE customer_id IS NOT NULL AND email IS NOT NULL) AS rows_out,
       count(*) FILTER (WHERE customer_id IS NULL OR email IS NULL) AS rows_rejected,
       count(*) FILTER (WHERE customer_id IS NOT NULL AND email IS NOT NULL AND trim(email) = '') AS blank_emails,
       count(*) FILTER (WHERE customer_id IS NOT NULL AND email IS NOT NULL
                          AND TRY_CAST(created_at AS TIMESTAMP) IS NULL) AS bad_created_at
FROM cust_raw"""


# order documents built from events: expected item rows straight from the
# event columns (no JSON parsing on this side)
EVENT_ITEMS = """
ev AS (
  SELECT 'E' || CAST(event_id AS VARCHAR) AS order_id, event_type,
         json_extract_string(props, '$.k') AS k,
         CAST(event_id % 3 + 1 AS INTEGER) AS qty, value
  FROM events
),
ev_items AS (
  SELECT order_id, k AS product_id, qty, value AS unit_price FROM ev WHERE event_type IN ('purchase', 'click')
  UNION ALL
  SELECT order_id, CAST((CAST(k AS INTEGER) + 1) % 100 AS VARCHAR), 1, 1.5 FROM ev WHERE event_type = 'purchase'
  UNION ALL
  SELECT order_id, CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE)
  FROM ev WHERE event_type NOT IN ('purchase', 'click')
)"""

SQL["order_items_explode_json"] = _with(EVENT_ITEMS) + "\nSELECT * FROM ev_items"
SQL["order_items_explode_array"] = SQL["order_items_explode_json"]
SQL["order_item_features_json"] = _with(EVENT_ITEMS) + """
SELECT order_id, CAST(count(product_id) AS INTEGER) AS items_count,
       CAST(coalesce(sum(qty), 0) AS INTEGER) AS total_items_qty
FROM ev_items GROUP BY order_id"""

SQL["folded_marks"] = _with(ORDERS) + """
SELECT status AS collection_name, max(CASE WHEN updated_at IS NULL THEN TIMESTAMP '1970-01-01' ELSE updated_at END) AS mark
FROM ord GROUP BY status"""

SQL["external_table_scan"] = _with(BATCHES, REVIEWS) + f"""
SELECT 'bronze_orders' AS table_name, order_id AS id, '{L1_DATE}' AS load_date FROM b1 UNION ALL
SELECT 'bronze_orders', order_id, '{L2_DATE}' FROM b2 UNION ALL
SELECT 'silver_reviews', review_id, day FROM rev, (VALUES ('{L1_DATE}'), ('{L2_DATE}')) t(day)"""

SQL["order_features_variant"] = _with(EVENT_ITEMS) + """
SELECT ev.order_id, f.items_count, f.total_items_qty,
       CASE WHEN event_type NOT IN ('view', 'error') THEN 'city' || k END AS shipping_city,
       CASE WHEN event_type NOT IN ('view', 'error') THEN CASE WHEN CAST(k AS INTEGER) < 50 THEN 'DE' ELSE 'FR' END END AS shipping_country
FROM ev JOIN (
  SELECT order_id, CAST(count(product_id) AS INTEGER) AS items_count, CAST(coalesce(sum(qty), 0) AS INTEGER) AS total_items_qty
  FROM ev_items GROUP BY order_id) f ON f.order_id = ev.order_id"""

SQL["gold_after_scd2_change"] = _with(CUSTOMERS, ORDERS, ORDER_AGG) + """
SELECT c.customer_id, c.full_name,
       CASE WHEN c.status = 'building' THEN 'new.' || c.email ELSE c.email END AS email, c.country,
       coalesce(a.total_orders, 0) AS total_orders,
       coalesce(a.total_revenue, CAST(0 AS DOUBLE)) AS total_revenue,
       coalesce(a.avg_order_value, CAST(0 AS DOUBLE)) AS avg_order_value,
       a.first_order_date, a.last_order_date
FROM cust c LEFT JOIN ord_agg a ON c.customer_id = a.customer_id"""

SQL["gold_from_silver_items"] = _with(EVENT_ITEMS, PRODUCTS, REVIEWS) + """
SELECT p.product_id, p.name AS product_name, CAST(coalesce(i.units, 0) AS BIGINT) AS total_units_sold,
       coalesce(i.revenue, CAST(0 AS DOUBLE)) AS total_revenue, CAST(coalesce(r.review_count, 0) AS BIGINT) AS review_count
FROM prod p
LEFT JOIN (
  SELECT product_id, sum(qty) AS units, CAST(CAST(sum(CAST(qty * unit_price * power(2, 64) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / power(2, 64) AS revenue
  FROM ev_items GROUP BY product_id) i ON i.product_id = p.product_id
LEFT JOIN rev_agg r ON r.product_id = p.product_id"""

SQL["scd2_history_after_drift"] = _with(BATCHES) + """
SELECT b1.order_id, b1.status, CAST(b1.order_id AS BIGINT) AS pieces, CAST(NULL AS VARCHAR) AS channel,
       CAST(1 AS INTEGER) AS version_number, b2.order_id IS NULL AS is_current
FROM b1 LEFT JOIN b2 ON b1.order_id = b2.order_id
UNION ALL
SELECT b2.order_id, b2.status, CAST(b2.order_id AS BIGINT), 'web',
       CAST(CASE WHEN b1.order_id IS NULL THEN 1 ELSE 2 END AS INTEGER), true
FROM b2 LEFT JOIN b1 ON b1.order_id = b2.order_id"""

SQL["silver_batch_mixed_runs"] = _with(ORDERS) + f"""
SELECT order_id, status, total_amount, CASE WHEN updated_at > {_ts(B.BATCH1_UPPER)} THEN 'web' END AS channel FROM ord"""

SQL["silver_rerun"] = SQL["scd2_merge"]

SQL["silver_orders_contract"] = SQL["order_item_features_json"]

SQL["silver_table_scan"] = _with(CUSTOMERS) + """
SELECT customer_id, CASE WHEN status = 'building' THEN 'new.' || email ELSE email END AS email,
       CAST(CASE WHEN status = 'building' AND email IS NOT NULL THEN 2 ELSE 1 END AS INTEGER) AS version_number,
       true AS is_current
FROM cust"""
