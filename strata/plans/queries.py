"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each query feeds whole test tables (through ``strata.plans.business``) into
library operators.  The matching SQL lives in ``strata.plans.oracle``.
Queries that exercise sinks write under the session's checkpoint folder
(``spark.checkpoint.dir``) and return the data read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.exact import SIGN, exact_sums, merge_states
from strata.functions.fingerprint import add_fingerprint
from strata.operators import control, items, marts, reports, scd
from strata.operators.cleanse import add_derived, cleanse, clean_columns, drop_missing_required
from strata.operators.dedupe import any_per_key, latest_per_key
from strata.operators.enrich import enrich_bronze
from strata.operators.evolution import RESCUED, affected_rows, drift_events, reconcile
from strata.plans import business as B
from strata.plans import jobs
from strata.plans.oracle import (
    EVENT_WINDOW,
    LAKE_ROOT,
    ONBOARDING,
    REVENUE_TIERS_TEST,
    SCAN_PARTITION,
    SNAPSHOT_CUTOFFS,
    TREND_AS_OF,
)
from strata.rules import COLLECTIONS, CUSTOMER_RULES, CleanseRules, CollectionSpec
from strata.session import local_frame, materialized, scratch_path
from strata.sources import logs
from strata.sources.contracts import conform, contract, register_silver, write_table
from strata.sources.documents import read_documents, write_documents
from strata.sources.extract import incremental_extract, merged_scan, partition_scan
from strata.sources.publish import (
    observed,
    publish_colocated,
    read_latest_partition,
    read_scd2_as_of,
    read_scd2_full,
    write_partition,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query | None = None, *, name: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        return f

    return register(fn) if fn is not None else register


ORDERS_PK = COLLECTIONS["orders"].primary_key
LINE_ORDER = ["l_shipdate"]
LINE_TIEBREAK = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


# --------------------------------------------------------------------------
# sources and sinks
# --------------------------------------------------------------------------

@query(name="incremental_extract")
def incremental_extract_events(spark: SparkSession, d: str) -> DataFrame:
    last, upper = EVENT_WINDOW
    return incremental_extract(B.table(spark, d, "events"), "ts", last, upper)


@query
def incremental_extract_source(spark: SparkSession, d: str) -> DataFrame:
    """The same window from a collection of JSON documents, whose reader plans
    only the files that can hold it."""
    events = B.table(spark, d, "events")
    path = scratch_path(spark, "collection")
    write_documents(events, path, "ts", 16)
    window = read_documents(spark, path, "ts", *EVENT_WINDOW)
    return window.select(F.from_json("document", events.schema).alias("d")).select("d.*")


@query
def bronze_partition_scan(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "bronze-orders")
    src = B.orders_source(spark, d).withColumn("load_date", F.date_format("created_at", "yyyy-MM-01"))
    src.write.mode("overwrite").partitionBy("load_date").parquet(root)
    return partition_scan(spark, root, "load_date", SCAN_PARTITION)


@query
def merge_schema_scan(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "bronze-drift")
    src = B.orders_source(spark, d)
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    write_partition(src.where(F.col("created_at") < cut), root, {"load_date": B.LOAD1[0]})
    later = src.where(F.col("created_at") >= cut).withColumn(
        "channel", F.when(F.col("total_amount") > 250000, F.lit("web")).otherwise(F.lit("store"))
    )
    write_partition(later, root, {"load_date": B.LOAD2[0]})
    return merged_scan(spark, root, "load_date")


@query
def bronze_enrich(spark: SparkSession, d: str) -> DataFrame:
    load_date, as_of = B.LOAD1
    return enrich_bronze(B.orders_source(spark, d), "orders", load_date, as_of)


@query
def conform_contract(spark: SparkSession, d: str) -> DataFrame:
    drifted = B.orders_source(spark, d).select(
        "order_id",
        "customer_id",
        "status",
        F.col("total_amount").cast("string").alias("total_amount"),
        "created_at",
        "updated_at",
        F.lit("x").alias("junk"),
    )
    return conform(drifted, contract("silver_orders"))


# --------------------------------------------------------------------------
# cleansing
# --------------------------------------------------------------------------

@query
def cleanse_required(spark: SparkSession, d: str) -> DataFrame:
    return drop_missing_required(B.customers_raw(spark, d), CUSTOMER_RULES.required)


@query
def cleanse_strings(spark: SparkSession, d: str) -> DataFrame:
    return clean_columns(B.customers_raw(spark, d), CleanseRules(string_cols=CUSTOMER_RULES.string_cols))


@query
def cleanse_casts(spark: SparkSession, d: str) -> DataFrame:
    rules = CleanseRules(ts_cols=CUSTOMER_RULES.ts_cols, numeric_cols=("acctbal",))
    return clean_columns(B.customers_raw(spark, d), rules)


@query
def cleanse_customers(spark: SparkSession, d: str) -> DataFrame:
    return B.customers(spark, d)


@query
def derived_columns(spark: SparkSession, d: str) -> DataFrame:
    return add_derived(B.customers_raw(spark, d), CUSTOMER_RULES)


# --------------------------------------------------------------------------
# dedupe and fingerprints
# --------------------------------------------------------------------------

@query
def dedupe_latest(spark: SparkSession, d: str) -> DataFrame:
    return latest_per_key(B.table(spark, d, "lineitem"), ["l_orderkey"], LINE_ORDER, LINE_TIEBREAK)


@query
def dedupe_any(spark: SparkSession, d: str) -> DataFrame:
    return any_per_key(B.table(spark, d, "lineitem"), ["l_orderkey"])


@query
def row_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    c = B.table(spark, d, "customer")
    with_compat = add_fingerprint(c)
    return add_fingerprint(with_compat, exclude=("record_hash",), mode="safe", name="record_hash_safe")


@query
def row_fingerprint_json(spark: SparkSession, d: str) -> DataFrame:
    return add_fingerprint(B.table(spark, d, "customer"), mode="json")


# --------------------------------------------------------------------------
# SCD merges over two order batches
# --------------------------------------------------------------------------

def _hashed_batches(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    b1, b2 = B.order_batches(spark, d)
    return add_fingerprint(b1), add_fingerprint(b2)


def _scd2_after_two_loads(spark: SparkSession, d: str) -> DataFrame:
    h1, h2 = _hashed_batches(spark, d)
    initial = scd.scd2_initial(h1, *B.LOAD1)
    return scd.scd2_merge(initial, h2, ORDERS_PK, *B.LOAD2)


@query
def change_detection(spark: SparkSession, d: str) -> DataFrame:
    h1, h2 = _hashed_batches(spark, d)
    return scd.change_detection(scd.scd2_initial(h1, *B.LOAD1), h2, ORDERS_PK)


@query
def anti_join_untouched(spark: SparkSession, d: str) -> DataFrame:
    b1, b2 = B.order_batches(spark, d)
    return scd.untouched_rows(b1, b2, ORDERS_PK)


@query
def union_by_name(spark: SparkSession, d: str) -> DataFrame:
    b1, b2 = B.order_batches(spark, d)
    narrow = b2.drop("currency").withColumn("channel", F.lit("web"))
    return scd.untouched_rows(b1, b2, ORDERS_PK).unionByName(narrow, allowMissingColumns=True)


@query
def scd1_upsert(spark: SparkSession, d: str) -> DataFrame:
    b1, b2 = B.order_batches(spark, d)
    first = scd.scd1_merge(None, b1, ORDERS_PK, *B.LOAD1)
    return scd.scd1_merge(first, b2, ORDERS_PK, *B.LOAD2)


@query
def scd2_initial(spark: SparkSession, d: str) -> DataFrame:
    h1, _ = _hashed_batches(spark, d)
    return scd.scd2_initial(h1, *B.LOAD1)


@query
def scd2_merge(spark: SparkSession, d: str) -> DataFrame:
    return _scd2_after_two_loads(spark, d)


@query
def scd2_expired_rows(spark: SparkSession, d: str) -> DataFrame:
    return _scd2_after_two_loads(spark, d).where(~F.col("is_current"))


@query
def scd2_current_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return scd.current_view(_scd2_after_two_loads(spark, d))


@query
def scd2_as_of(spark: SparkSession, d: str) -> DataFrame:
    return scd.as_of_view(_scd2_after_two_loads(spark, d), B.AS_OF_BETWEEN)


def _two_loads_into_buckets(spark: SparkSession, d: str) -> str:
    """Both order batches merged into a table of 16 key buckets; its root."""
    lake = jobs.Lake(scratch_path(spark, "lake"))
    spec = CollectionSpec("orders", ORDERS_PK, "updated_at", 2, COLLECTIONS["orders"].rules, buckets=16)
    for batch, load in zip(B.order_batches(spark, d), (B.LOAD1, B.LOAD2)):
        jobs.merge_batch(spark, lake, spec, materialized(jobs.prepare_batch(batch, spec), "batch"), *load)
    return lake.silver("orders")


@query
def scd2_bucketed_merge(spark: SparkSession, d: str) -> DataFrame:
    """Two loads into a bucketed table with a manifest, read as full history."""
    return read_scd2_full(spark, _two_loads_into_buckets(spark, d))


@query
def scd2_as_of_pruned(spark: SparkSession, d: str) -> DataFrame:
    """The as-of view, with folders outside the time left unopened."""
    return read_scd2_as_of(spark, _two_loads_into_buckets(spark, d), B.AS_OF_BETWEEN)


@query
def scd2_merge_colocated(spark: SparkSession, d: str) -> DataFrame:
    """The merge against current rows kept in a Spark table bucketed by key:
    only the batch is shuffled."""
    h1, h2 = _hashed_batches(spark, d)
    root = scratch_path(spark, "colocated")
    name = "orders_current_" + root.rsplit("-", 1)[-1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    publish_colocated(scd.scd2_initial(h1, *B.LOAD1), name, ORDERS_PK, buckets, root)
    return scd.scd2_merge(spark.table(name), h2, ORDERS_PK, *B.LOAD2)


# --------------------------------------------------------------------------
# schema evolution
# --------------------------------------------------------------------------

def _drifted_batch(spark: SparkSession, d: str) -> DataFrame:
    _, b2 = B.order_batches(spark, d)
    return b2.select(
        "order_id",
        F.col("customer_id").cast("long").alias("customer_id"),
        "status",
        "total_amount",
        "created_at",
        "updated_at",
        F.when(F.col("total_amount") > 250000, F.lit("web")).otherwise(F.lit("store")).alias("channel"),
    )


@query
def schema_drift_events(spark: SparkSession, d: str) -> DataFrame:
    """Drift between two written batches, with the rows each change concerns."""
    root = scratch_path(spark, "drift")
    b1, _ = B.order_batches(spark, d)
    b1.write.parquet(f"{root}/old")
    _drifted_batch(spark, d).write.parquet(f"{root}/new")
    old, new = spark.read.parquet(f"{root}/old"), spark.read.parquet(f"{root}/new")
    events = drift_events(spark, "orders", old.schema, new.schema)
    columns = sorted({*old.columns, *new.columns})
    return affected_rows(events, old, new, columns).select(
        "collection_name", "change_type", "column_name", "old_type", "new_type", "resolved", "rows_affected"
    )


@query
def schema_reconcile(spark: SparkSession, d: str) -> DataFrame:
    b1, _ = B.order_batches(spark, d)
    ex, inc = reconcile(b1, _drifted_batch(spark, d))
    return ex.unionByName(inc)


@query
def schema_reconcile_nested(spark: SparkSession, d: str) -> DataFrame:
    """Nested documents whose fields change shape and type: structs gain and
    lose fields, decimals and elements widen, and what does not fit is rescued."""
    c = B.table(spark, d, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("n"), F.col("c_acctbal").alias("b"),
        (F.col("c_mktsegment") == "BUILDING").alias("odd"),
    )
    k, n, b, odd = (F.col(x) for x in ("k", "n", "b", "odd"))

    def unless(odd_value, value) -> Column:
        return F.when(odd, odd_value).otherwise(value)

    existing = c.select(
        F.lit("existing").alias("side"), k.cast("string").alias("id"), k.cast("int").alias("points"),
        (k.cast("long") * 1000003).alias("big"), b.cast("decimal(10,2)").alias("amount"),
        F.struct(F.concat(F.lit("city"), n.cast("string")).alias("city"), n.cast("int").alias("zip")).alias("address"),
        F.array(n.cast("int")).alias("tags"), F.create_map(F.lit("k"), n.cast("int")).alias("attrs"),
        F.create_map(F.lit("k"), n.cast("long")).alias("codes"),
    )
    incoming = c.select(
        F.lit("incoming").alias("side"), k.cast("string").alias("id"), unless("many", k.cast("string")).alias("points"),
        b.alias("big"), (b + 0.0025).cast("decimal(20,4)").alias("amount"),
        F.struct(unless(F.concat(F.lit("Z"), n.cast("string")), n.cast("string")).alias("zip"), F.struct(b.alias("lat")).alias("geo")).alias("address"),
        F.array(n.cast("long") + 5_000_000_000).alias("tags"), F.create_map(F.lit("k"), b).alias("attrs"),
        F.create_map(F.lit("k"), unless(n + 0.5, n.cast("double"))).alias("codes"),
    )
    ex, inc = reconcile(existing, incoming)
    lost = F.col(RESCUED)
    return ex.unionByName(inc).select(
        "side", "id", "points", "big", F.col("amount").cast("double").alias("amount"),
        "address.city", "address.zip", F.col("address.geo.lat").alias("lat"),
        F.col("tags")[0].alias("tag"), F.col("attrs")["k"].alias("attr"), F.col("codes")["k"].alias("code"),
        lost["points"].alias("lost_points"), lost["big"].alias("lost_big"), lost["address.zip"].alias("lost_zip"),
        lost["codes"].alias("lost_codes"), F.coalesce(F.size(F.map_keys(lost)), F.lit(0)).alias("n_lost"),
    )


# --------------------------------------------------------------------------
# items and marts
# --------------------------------------------------------------------------

@query
def exact_money_sum(spark: SparkSession, d: str) -> DataFrame:
    """Sums over thirteen orders of magnitude and both signs, to the last bit."""
    key = F.col("o_orderkey")
    factors = F.array(*(F.lit(float(f"1e{e}")) for e in range(-6, 7)))
    sign = F.when(key % 3 == 0, F.lit(-1)).otherwise(F.lit(1))
    x = F.col("o_totalprice") * F.get(factors, (key % 13).cast("int")) * sign
    keys = ["o_orderstatus", "o_orderpriority"]
    return exact_sums(B.table(spark, d, "orders"), keys, {"total": x}, {"n": (F.count(F.lit(1)), F.sum("n"))})


def _exploded(spark: SparkSession, d: str) -> DataFrame:
    return items.join_lines(B.orders(spark, d), B.order_lines(spark, d))


@query
def order_items_explode(spark: SparkSession, d: str) -> DataFrame:
    return _exploded(spark, d)


@query
def order_items_explode_json(spark: SparkSession, d: str) -> DataFrame:
    return items.explode_items(B.event_order_docs_json(spark, d))


@query
def order_items_explode_array(spark: SparkSession, d: str) -> DataFrame:
    return items.explode_items(B.event_order_docs_array(spark, d))


@query
def order_item_features_json(spark: SparkSession, d: str) -> DataFrame:
    return items.item_features(B.event_order_docs_json(spark, d)).drop("items")


@query
def order_features_variant(spark: SparkSession, d: str) -> DataFrame:
    """Item and shipping features of raw documents, parsed once as variants."""
    return items.document_features(B.event_order_documents(spark, d)).drop("raw_document")


@query
def order_item_features(spark: SparkSession, d: str) -> DataFrame:
    return items.item_features_from_lines(B.orders(spark, d), B.order_lines(spark, d))


@query
def product_item_agg(spark: SparkSession, d: str) -> DataFrame:
    return marts.product_item_agg(_exploded(spark, d))


@query
def product_review_agg(spark: SparkSession, d: str) -> DataFrame:
    return marts.product_review_agg(B.reviews(spark, d))


@query
def customer_order_agg(spark: SparkSession, d: str) -> DataFrame:
    return marts.customer_order_agg(B.orders(spark, d))


@query
def customer_segments(spark: SparkSession, d: str) -> DataFrame:
    return marts.customer_segments(B.customers(spark, d), B.orders(spark, d), revenue_tiers=REVENUE_TIERS_TEST)


@query
def customer_sales_summary(spark: SparkSession, d: str) -> DataFrame:
    return marts.customer_sales_summary(B.customers(spark, d), B.orders(spark, d), revenue_tiers=REVENUE_TIERS_TEST)


@query
def rank_in_category(spark: SparkSession, d: str) -> DataFrame:
    return marts.rank_in_category(B.products(spark, d), items.lines_of(B.orders(spark, d), B.order_lines(spark, d)))


@query
def top_products(spark: SparkSession, d: str) -> DataFrame:
    lines = items.lines_of(B.orders(spark, d), B.order_lines(spark, d))
    return marts.top_products(B.products(spark, d), lines, B.reviews(spark, d))


@query
def order_analytics(spark: SparkSession, d: str) -> DataFrame:
    return marts.order_analytics(B.orders(spark, d), B.customers(spark, d))


# --------------------------------------------------------------------------
# reports over written snapshots
# --------------------------------------------------------------------------

def _orders_until(spark: SparkSession, d: str, day: str) -> DataFrame:
    end = F.lit(f"{day} 23:59:59").cast("timestamp_ntz")
    return B.orders(spark, d).where(F.col("created_at") <= end)


@query
def top_customers_latest(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "gold-customer-summary")
    cust = B.customers(spark, d)
    for day in SNAPSHOT_CUTOFFS:
        summary = marts.customer_sales_summary(cust, _orders_until(spark, d, day), revenue_tiers=REVENUE_TIERS_TEST)
        write_partition(summary, root, {"report_date": day})
    return reports.top_customers_latest(read_latest_partition(spark, root, "report_date"))


@query
def daily_order_trend(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "gold-order-analytics")
    cust = B.customers(spark, d)
    for day in SNAPSHOT_CUTOFFS:
        write_partition(marts.order_analytics(_orders_until(spark, d, day), cust), root, {"report_date": day})
    latest = read_latest_partition(spark, root, "report_date", at_most=TREND_AS_OF)
    return reports.daily_order_trend(latest, TREND_AS_OF)


# --------------------------------------------------------------------------
# control plane
# --------------------------------------------------------------------------

def _registry(spark: SparkSession, d: str) -> DataFrame:
    frames = B.collection_frames(spark, d)
    marks = control.collection_marks({n: (df, COLLECTIONS[n].watermark_column) for n, df in frames.items()})
    rows = control.spec_rows(COLLECTIONS.values(), LAKE_ROOT)
    return control.build_registry(spark, rows, marks, B.LOAD1[1])


@query
def active_collections(spark: SparkSession, d: str) -> DataFrame:
    return control.active_collections(_registry(spark, d))


@query
def watermark_status(spark: SparkSession, d: str) -> DataFrame:
    return control.watermark_status(_registry(spark, d))


@query
def registry_upsert(spark: SparkSession, d: str) -> DataFrame:
    specs = [CollectionSpec(n, pk, wm, scd_type) for n, pk, wm, scd_type in ONBOARDING]
    requests = local_frame(spark, control.spec_rows(specs, LAKE_ROOT), control.REGISTRY_SCHEMA)
    return control.registry_upsert(_registry(spark, d), requests, B.LOAD2[1])


@query
def customer_order_agg_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The customer measures after a second load, where only customers with a
    closed or opened order are aggregated again."""
    h1, h2 = _hashed_batches(spark, d)
    first = scd.scd2_initial(h1, *B.LOAD1)
    before = materialized(marts.customer_order_agg(first), "customer-agg")
    merged = materialized(scd.scd2_merge(first, h2, ORDERS_PK, *B.LOAD2), "orders")
    live = merged.where("is_current")
    now = F.lit(B.LOAD2[1]).cast("timestamp_ntz")
    changes = merged.where(~F.col("is_current") | (F.col("effective_date") == now))
    return marts.refresh_customer_order_agg(before, live, changes)


@query
def order_analytics_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The daily mart kept as a state: built from the first load, then changed
    by what the second one closed and opened."""
    h1, h2 = _hashed_batches(spark, d)
    customers = B.customers(spark, d)
    root = scratch_path(spark, "analytics-state")
    first = scd.scd2_initial(h1, *B.LOAD1)
    marts.order_analytics_state(first.withColumn(SIGN, F.lit(1)), customers).write.parquet(f"{root}/1")
    merged = scd.scd2_merge(first, h2, ORDERS_PK, *B.LOAD2)
    opened = merged.where(F.col("is_current") & (F.col("effective_date") == F.lit(B.LOAD2[1]).cast("timestamp_ntz")))
    change = marts.order_analytics_state(marts.signed_changes(opened, merged.where(~F.col("is_current"))), customers)
    state = spark.read.parquet(f"{root}/1")
    merge_states(state, change.select(*state.columns), marts.ANALYTICS_KEYS).write.parquet(f"{root}/2")
    return marts.order_analytics_from_state(spark.read.parquet(f"{root}/2"))


@query
def advance_watermark(spark: SparkSession, d: str) -> DataFrame:
    _, b2 = B.order_batches(spark, d)
    new_mark = b2.select(F.col("updated_at").alias("mark"))
    return control.advance_watermark(_registry(spark, d), "orders", new_mark, B.LOAD2[1])


@query
def folded_marks(spark: SparkSession, d: str) -> DataFrame:
    """Marks of a log that is folded three times and appended to again: every
    order is an advance of its status's collection."""
    path = f"{scratch_path(spark, 'control')}/marks"
    orders = B.orders(spark, d)
    advances = orders.select(
        F.col("status").alias("collection_name"), F.col("updated_at").alias("mark"), F.col("order_id").alias("run_id"),
        F.col("updated_at").alias("advanced_at"),
    )
    year = F.year("mark")
    for rows in (advances.where(year < 1994), advances.where(year.between(1994, 1996)), advances.where(year > 1996)):
        logs.append(rows, path)
        logs.fold(spark, path, control.MARKS_SCHEMA, control.latest_marks)
    logs.append(advances.withColumn("mark", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")), path)  # an older tail
    return logs.read(spark, path, control.MARKS_SCHEMA, control.latest_marks).select("collection_name", "mark")


@query
def external_table_scan(spark: SparkSession, d: str) -> DataFrame:
    """A bronze and an SCD1 silver table of the catalog, partitioned as their
    contracts say; each write adds its own partition."""
    root = scratch_path(spark, "tables")
    tag = root.rsplit("-", 1)[-1]
    bronze, silver = f"bronze_orders_{tag}", f"silver_reviews_{tag}"
    for batch, (load_date, as_of) in zip(B.order_batches(spark, d), (B.LOAD1, B.LOAD2)):
        write_table(spark, enrich_bronze(batch, "orders", load_date, as_of), bronze, "bronze_orders", f"{root}/bronze", load_date)
        reviews = jobs.prepare_batch(B.reviews_raw(spark, d), COLLECTIONS["reviews"])
        write_table(spark, scd.stamp_load(reviews, load_date, as_of), silver, "silver_reviews", f"{root}/silver", load_date)
    scans = [
        spark.table(table).select(F.lit(name).alias("table_name"), F.col(key).alias("id"), "load_date")
        for table, name, key in ((bronze, "bronze_orders", "order_id"), (silver, "silver_reviews", "review_id"))
    ]
    rows = materialized(scans[0].unionByName(scans[1]), "external")
    for table in (bronze, silver):
        spark.sql(f"DROP TABLE {table}")  # the files stay
    return rows


@query
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    return reports.run_summary(B.audit_runs(spark, d))


@query
def recent_runs(spark: SparkSession, d: str) -> DataFrame:
    return reports.recent_runs(B.audit_runs(spark, d))


@query
def batch_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Counts of one cleansing pass, observed during its single write."""
    raw, obs_in = observed(B.customers_raw(spark, d), "cleanse-in", rows_in=F.count(F.lit(1)))
    spec = COLLECTIONS["customers"]
    clean, obs_out = observed(
        cleanse(raw, spec.rules, spec.primary_key),
        "cleanse-out",
        rows_out=F.count(F.lit(1)),
        blank_emails=F.count_if(F.col("email") == ""),
        bad_created_at=F.count_if(F.col("created_at").isNull()),
    )
    clean.write.mode("overwrite").parquet(scratch_path(spark, "silver-customers"))
    m = {**obs_in.get, **obs_out.get}
    m["rows_rejected"] = m["rows_in"] - m["rows_out"]
    names = ["rows_in", "rows_out", "rows_rejected", "blank_emails", "bad_created_at"]
    return local_frame(spark, [tuple(int(m[k]) for k in names)], ", ".join(f"{k} long" for k in names))


@query
def bronze_then_silver(spark: SparkSession, d: str) -> DataFrame:
    """End to end: two extracts of the order source through bronze into an
    SCD2 cleansed table, read back as full history."""
    lake = jobs.Lake(scratch_path(spark, "lake"))
    spec = CollectionSpec("orders", ORDERS_PK, "updated_at", 2, COLLECTIONS["orders"].rules)
    jobs.init_registry(spark, lake, [spec], B.LOAD1[1])
    jobs.run_bronze(spark, lake, spec, B.orders_source(spark, d, 1), B.LOAD1[0], B.BATCH1_UPPER, B.LOAD1[1])
    jobs.run_silver(spark, lake, spec, B.LOAD1[0], B.LOAD1[1])
    jobs.run_bronze(
        spark, lake, spec, B.orders_source(spark, d, 2), B.LOAD2[0], B.BATCH2_UPPER, B.LOAD2[1],
        lookback_from=B.BATCH2_LOWER,
    )
    jobs.run_silver(spark, lake, spec, B.LOAD2[0], B.LOAD2[1])
    return read_scd2_full(spark, lake.silver("orders"))


# --------------------------------------------------------------------------
# jobs: gold after changes, drifted history, replays
# --------------------------------------------------------------------------

def _loaded(spark: SparkSession, lake: jobs.Lake, spec: CollectionSpec, source: DataFrame, load: tuple[str, str]) -> None:
    jobs.run_bronze(spark, lake, spec, source, load[0], load[1], load[1], lookback_from=B.EPOCH)
    jobs.run_silver(spark, lake, spec, load[0], load[1])


@query
def gold_after_scd2_change(spark: SparkSession, d: str) -> DataFrame:
    """The customer mart after some customers changed their e-mail: one row
    per customer, with the new address and unchanged totals."""
    lake = jobs.Lake(scratch_path(spark, "lake"))
    jobs.init_registry(spark, lake, list(COLLECTIONS.values()), B.LOAD1[1])
    before = B.customers_raw(spark, d).withColumn("updated_at", F.lit("2023-06-01 00:00:00").cast("timestamp_ntz"))
    moved = F.when(F.col("status") == "BUILDING", F.concat(F.lit("new."), F.trim("email"))).otherwise(F.col("email"))
    after = before.withColumn("email", moved).withColumn("updated_at", F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    _loaded(spark, lake, COLLECTIONS["orders"], B.orders_source(spark, d), B.LOAD1)
    _loaded(spark, lake, COLLECTIONS["customers"], before, B.LOAD1)
    _loaded(spark, lake, COLLECTIONS["customers"], after, B.LOAD2)
    jobs.run_gold(spark, lake, B.LOAD2[0], B.LOAD2[1])
    mart = read_latest_partition(spark, lake.gold("customer_sales_summary"), "report_date")
    return mart.drop("report_date", "pipeline_load_ts", "customer_segment", "lifetime_value_tier")


@query
def gold_from_silver_items(spark: SparkSession, d: str) -> DataFrame:
    """The product mart with its lines taken from the items of cleansed orders."""
    lake = jobs.Lake(scratch_path(spark, "lake"))
    jobs.init_registry(spark, lake, list(COLLECTIONS.values()), B.LOAD1[1])
    when = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    documents = B.event_order_docs_json(spark, d).select(
        "order_id", F.lit("1").alias("customer_id"), F.lit("completed").alias("status"),
        F.lit(1.0).alias("total_amount"), when.alias("created_at"), when.alias("updated_at"), "items",
    )
    _loaded(spark, lake, COLLECTIONS["orders"], documents, B.LOAD1)
    _loaded(spark, lake, COLLECTIONS["products"], B.products_raw(spark, d), B.LOAD1)
    _loaded(spark, lake, COLLECTIONS["reviews"], B.reviews_raw(spark, d), B.LOAD2)
    jobs.run_gold(spark, lake, B.LOAD2[0], B.LOAD2[1])
    mart = read_latest_partition(spark, lake.gold("top_products"), "report_date")
    return mart.select("product_id", "product_name", "total_units_sold", "total_revenue", "review_count")


@query
def scd2_history_after_drift(spark: SparkSession, d: str) -> DataFrame:
    """History over a batch that adds a column and widens another."""
    lake = jobs.Lake(scratch_path(spark, "lake"))
    spec = CollectionSpec("orders", ORDERS_PK, "updated_at", 2, COLLECTIONS["orders"].rules)
    b1, b2 = B.order_batches(spark, d)
    pieces = F.col("order_id").cast("int")
    jobs.merge_batch(spark, lake, spec, jobs.prepare_batch(b1.withColumn("pieces", pieces), spec), *B.LOAD1)
    drifted = b2.withColumn("pieces", pieces.cast("long")).withColumn("channel", F.lit("web"))
    jobs.merge_batch(spark, lake, spec, jobs.prepare_batch(drifted, spec), *B.LOAD2)
    full = read_scd2_full(spark, lake.silver("orders"))
    return full.select("order_id", "status", "pieces", "channel", "version_number", "is_current")


@query
def silver_batch_mixed_runs(spark: SparkSession, d: str) -> DataFrame:
    """One load date with two runs, the second of which has one more column."""
    lake = jobs.Lake(scratch_path(spark, "lake"))
    spec = COLLECTIONS["orders"]
    jobs.init_registry(spark, lake, [spec], B.LOAD1[1])
    source = B.orders_source(spark, d)
    jobs.run_bronze(spark, lake, spec, source, B.LOAD1[0], B.BATCH1_UPPER, B.LOAD1[1])
    wider = source.withColumn("channel", F.lit("web"))
    jobs.run_bronze(spark, lake, spec, wider, B.LOAD1[0], B.BATCH2_UPPER, B.LOAD1[1])
    return jobs.silver_batch(spark, lake, spec, B.LOAD1[0]).select("order_id", "status", "total_amount", "channel")


@query
def silver_rerun(spark: SparkSession, d: str) -> DataFrame:
    """Both loads merged, the second one twice: a replay changes nothing."""
    lake = jobs.Lake(scratch_path(spark, "lake"))
    spec = CollectionSpec("orders", ORDERS_PK, "updated_at", 2, COLLECTIONS["orders"].rules)
    b1, b2 = (jobs.prepare_batch(b, spec) for b in B.order_batches(spark, d))
    jobs.merge_batch(spark, lake, spec, b1, *B.LOAD1)
    for _ in range(2):
        jobs.merge_batch(spark, lake, spec, b2, *B.LOAD2)
    return read_scd2_full(spark, lake.silver("orders"))


@query
def silver_orders_contract(spark: SparkSession, d: str) -> DataFrame:
    """Cleansed orders with inline items, in the shape of their contract."""
    documents = B.event_order_docs_json(spark, d).select(
        "order_id", F.lit("1").alias("customer_id"), F.lit("2024-01-01 00:00:00").alias("updated_at"), "items"
    )
    ready = jobs.prepare_batch(documents, COLLECTIONS["orders"])
    return conform(ready, contract("silver_orders")).select("order_id", "items_count", "total_items_qty")


@query
def silver_table_scan(spark: SparkSession, d: str) -> DataFrame:
    """The SQL view of a versioned table: its current rows only."""
    lake = jobs.Lake(scratch_path(spark, "lake"))
    spec = COLLECTIONS["customers"]
    before = B.customers_raw(spark, d)
    moved = F.when(F.col("status") == "BUILDING", F.concat(F.lit("new."), F.trim("email"))).otherwise(F.col("email"))
    for source, load in ((before, B.LOAD1), (before.withColumn("email", moved), B.LOAD2)):
        jobs.merge_batch(spark, lake, spec, materialized(jobs.prepare_batch(source, spec), "batch"), *load)
    view = "silver_customers_" + lake.root.rstrip("/").split("-")[-1]
    register_silver(spark, view, "silver_customers", lake.silver("customers"))
    rows = spark.table(view).select("customer_id", "email", "version_number", "is_current")
    spark.sql(f"DROP VIEW {view}")  # the frame is resolved already
    return rows
