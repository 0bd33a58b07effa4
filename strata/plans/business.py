"""Business collections derived from the driver's TPC-H-like tables.

The library operates on the document collections of a shop (customers,
orders, products, reviews) plus control tables (registry, run audit).  The
test tables are mapped onto them here; ``strata.plans.oracle`` derives the
same collections independently in SQL.  All mappings are value-based
projections over whole tables: nothing is sampled or capped.

customers   customer ⋈ nation, with dirty variants chosen by account balance
orders      orders; status F->completed (delivered if urgent), O->processing,
            P->cancelled; created/updated = o_orderdate
orders v2   the same source at a later time: urgent/high open orders are now
            completed and their ``updated_at`` moved 45 days
order lines lineitem as flattened order items
products    part; category NULL for the largest sizes
reviews     events; product = props.k, rating 1..5
event docs  events as order documents carrying their items inline (JSON text
            or native array), built row by row: purchases hold two items,
            clicks one, views none (NULL), signups an empty list, errors
            malformed text
audit       events as pipeline runs
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.cleanse import cleanse
from strata.rules import COLLECTIONS
from strata.sources.extract import incremental_extract

# --- fixed values of the test scenario (shared with the SQL oracle) ---
EPOCH = "1970-01-01 00:00:00"
BATCH1_UPPER = "1999-12-31 23:59:59"
BATCH2_LOWER = "1998-12-31 23:59:59"
BATCH2_UPPER = "2001-12-31 23:59:59"
LOAD1 = ("2024-01-01", "2024-01-01 06:00:00")  # (load_date, as_of)
LOAD2 = ("2024-02-01", "2024-02-01 06:00:00")
AS_OF_BETWEEN = "2024-01-15 00:00:00"
CHANGE_DELAY_DAYS = 45
# --- end of fixed values ---


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# customers
# --------------------------------------------------------------------------

def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    bal = F.col("c_acctbal")
    seg = F.col("c_mktsegment")
    email = F.concat(F.lit("customer"), F.col("c_custkey").cast("string"), F.lit("@example.com"))
    since = F.concat(
        F.date_add(F.lit("2023-01-01").cast("date"), F.col("c_nationkey") * 10).cast("string"),
        F.lit(" 08:30:00"),
    )
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.when(bal.between(-800, -700), F.lit(None)).otherwise(F.col("c_custkey").cast("string")).alias("customer_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.when(bal > 9500, F.lit(None)).otherwise(F.split_part(F.col("c_name"), F.lit("#"), F.lit(2))).alias("last_name"),
        F.when(bal < -800, F.lit(None))
        .when(bal < 0, F.concat(F.lit("  "), F.upper(email), F.lit(" ")))
        .when(bal.between(9000, 9500), F.lit("   "))
        .otherwise(email)
        .alias("email"),
        F.when(seg == "HOUSEHOLD", F.concat(F.lit(" "), seg, F.lit(" "))).otherwise(seg).alias("status"),
        F.col("n_name").alias("country"),
        F.when((seg == "AUTOMOBILE") & (bal > 9000), F.lit("not-a-timestamp")).otherwise(since).alias("created_at"),
        since.alias("updated_at"),
        F.when((seg == "MACHINERY") & (bal > 9000), F.lit("n/a")).otherwise(bal.cast("string")).alias("acctbal"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = COLLECTIONS["customers"]
    return cleanse(customers_raw(spark, sf_dir), spec.rules, spec.primary_key)


# --------------------------------------------------------------------------
# orders
# --------------------------------------------------------------------------

def orders_source(spark: SparkSession, sf_dir: str, version: int = 1) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    st, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    status = (
        F.when(st == "F", F.when(prio == "1-URGENT", F.lit("delivered")).otherwise(F.lit("completed")))
        .when(st == "O", F.lit("processing"))
        .when(st == "P", F.lit("cancelled"))
    )
    updated = F.col("o_orderdate")
    if version == 2:
        touched = (st == "O") & prio.isin("1-URGENT", "2-HIGH")
        status = F.when(touched, F.lit("completed")).otherwise(status)
        updated = F.when(touched, updated + F.expr(f"INTERVAL {CHANGE_DELAY_DAYS} DAYS")).otherwise(updated)
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        status.alias("status"),
        F.col("o_totalprice").alias("total_amount"),
        F.lit("USD").alias("currency"),
        F.col("o_orderdate").alias("created_at"),
        updated.alias("updated_at"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = COLLECTIONS["orders"]
    return cleanse(orders_source(spark, sf_dir), spec.rules, spec.primary_key)


def order_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two overlapping extracts: batch 2 re-sends 1999 (some rows changed),
    brings 2000-2001 as new keys and lacks the older keys."""
    b1 = incremental_extract(orders_source(spark, sf_dir, 1), "updated_at", EPOCH, BATCH1_UPPER)
    b2 = incremental_extract(orders_source(spark, sf_dir, 2), "updated_at", BATCH2_LOWER, BATCH2_UPPER)
    return b1, b2


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("l_discount").alias("discount"),
    )


# --------------------------------------------------------------------------
# products and reviews
# --------------------------------------------------------------------------

def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") > 48, F.lit(None)).otherwise(F.col("p_type")).alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("stock_qty"),
        F.lit("active").alias("status"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = COLLECTIONS["products"]
    return cleanse(products_raw(spark, sf_dir), spec.rules, spec.primary_key)


def reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("review_id"),
        F.get_json_object("props", "$.k").alias("product_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        (F.col("event_id") % 5 + 1).cast("int").alias("rating"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("created_at"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = COLLECTIONS["reviews"]
    return cleanse(reviews_raw(spark, sf_dir), spec.rules, spec.primary_key)


def payments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.where(F.col("event_type") == "purchase").select(
        F.col("event_id").cast("string").alias("payment_id"),
        F.concat(F.lit("ORD-"), F.col("event_id").cast("string")).alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("value").alias("amount"),
        F.lit("USD").alias("currency"),
        F.lit("completed").alias("status"),
        F.col("ts").alias("created_at"),
    )


# --------------------------------------------------------------------------
# order documents with inline items
# --------------------------------------------------------------------------

def _doc_items():
    k = F.get_json_object("props", "$.k")
    qty = (F.col("event_id") % 3 + 1).cast("int")
    second_k = ((k.cast("int") + 1) % 100).cast("string")
    return k, qty, second_k


def event_order_docs_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order document per event, items as JSON text (no grouping)."""
    e = table(spark, sf_dir, "events")
    k, qty, second_k = _doc_items()
    first = F.concat(
        F.lit('{"product_id":"'), k, F.lit('","qty":'), qty.cast("string"),
        F.lit(',"unit_price":'), F.col("value").cast("string"), F.lit("}"),
    )
    second = F.concat(F.lit('{"product_id":"'), second_k, F.lit('","qty":1,"unit_price":1.5}'))
    et = F.col("event_type")
    items = (
        F.when(et == "purchase", F.concat(F.lit("["), first, F.lit(","), second, F.lit("]")))
        .when(et == "click", F.concat(F.lit("["), first, F.lit("]")))
        .when(et == "signup", F.lit("[]"))
        .when(et == "error", F.lit("{not json"))
    )
    return e.select(F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("order_id"), items.alias("items"))


def event_order_docs_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents with items as a native array of structs."""
    e = table(spark, sf_dir, "events")
    k, qty, second_k = _doc_items()
    item_type = "struct<product_id:string,qty:int,unit_price:double,discount:double>"
    first = F.struct(k.alias("product_id"), qty.alias("qty"), F.col("value").alias("unit_price"), F.lit(None).cast("double").alias("discount"))
    second = F.struct(second_k.alias("product_id"), F.lit(1).alias("qty"), F.lit(1.5).alias("unit_price"), F.lit(None).cast("double").alias("discount"))
    et = F.col("event_type")
    items = (
        F.when(et == "purchase", F.array(first, second))
        .when(et == "click", F.array(first))
        .when(et.isin("signup", "error"), F.array().cast(f"array<{item_type}>"))
    )
    return e.select(F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("order_id"), items.alias("items"))


def event_order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same orders as raw JSON documents with an address: even events nest
    items and address, odd ones hold both as JSON text; views have neither and
    errors cannot be read."""
    orders = event_order_docs_array(spark, sf_dir).withColumnRenamed("order_id", "_o")
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    address = F.struct(
        F.concat(F.lit("city"), k).alias("city"), F.when(k.cast("int") < 50, "DE").otherwise("FR").alias("country")
    )
    order_id = F.concat(F.lit("E"), F.col("event_id").cast("string"))
    about = e.select(order_id.alias("order_id"), "event_id", "event_type", F.when(F.col("event_type") != "view", address).alias("_a"))
    both = about.join(orders, F.col("order_id") == F.col("_o"))
    nested = F.to_json(F.struct("order_id", "items", F.col("_a").alias("shipping_address")))
    text = F.to_json(F.struct("order_id", F.to_json("items").alias("items"), F.to_json("_a").alias("shipping_addr")))
    document = F.when(F.col("event_type") == "error", F.lit("{broken")).when(F.col("event_id") % 2 == 0, nested).otherwise(text)
    return both.select("order_id", document.alias("raw_document"))


# --------------------------------------------------------------------------
# control plane
# --------------------------------------------------------------------------

def audit_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-audit rows: every event stands for one pipeline run."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    et = F.col("event_type")
    status = (
        F.when(et == "error", F.lit("FAILED")).when(F.col("value") < 1, F.lit("RUNNING")).otherwise(F.lit("SUCCESS"))
    )
    extracted = F.floor(F.col("value") * 10).cast("long")
    return e.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.when(k < 20, "customers")
        .when(k < 40, "orders")
        .when(k < 60, "products")
        .when(k < 80, "payments")
        .otherwise("reviews")
        .alias("collection_name"),
        F.when(et.isin("click", "purchase"), "bronze").when(et.isin("view", "signup"), "silver").otherwise("gold").alias(
            "layer"
        ),
        F.col("ts").alias("pipeline_start_time"),
        F.col("value").cast("decimal(10,2)").alias("duration_seconds"),
        extracted.alias("records_extracted"),
        F.when(et == "error", F.lit(0).cast("long")).otherwise(extracted).alias("records_loaded"),
        status.alias("status"),
    )


def collection_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw collections keyed by name (used to derive high-water marks)."""
    return {
        "customers": customers(spark, sf_dir),
        "orders": orders_source(spark, sf_dir, 1),
        "products": products_raw(spark, sf_dir),
        "payments": payments_raw(spark, sf_dir),
        "reviews": reviews_raw(spark, sf_dir),
    }
