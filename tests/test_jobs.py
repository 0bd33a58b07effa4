"""End to end: bronze -> silver -> gold with control tables."""

from datetime import datetime

from pyspark.sql import functions as F

from strata.plans import business as B
from strata.plans import jobs
from strata.sources.extract import partition_scan
from strata.rules import COLLECTIONS
from strata.session import scratch_path
from strata.sources.publish import read_scd2_current, read_scd2_full, read_snapshot

SF = "/root/testdata/sf0.001"


def test_two_batches_scd1_and_gold(spark):
    lake = jobs.Lake(scratch_path(spark, "e2e"))
    orders = COLLECTIONS["orders"]
    jobs.init_registry(spark, lake, list(COLLECTIONS.values()), B.LOAD1[1])

    r1 = jobs.run_bronze(spark, lake, orders, B.orders_source(spark, SF, 1), B.LOAD1[0], B.BATCH1_UPPER, B.LOAD1[1])
    jobs.run_silver(spark, lake, orders, B.LOAD1[0], B.LOAD1[1])
    reg = {r.collection_name: r for r in jobs.read_registry(spark, lake).collect()}
    assert reg["orders"].last_loaded_timestamp <= datetime(1999, 12, 31, 23, 59, 59)
    assert r1.records_loaded > 0

    # second run continues from the stored mark
    r2 = jobs.run_bronze(spark, lake, orders, B.orders_source(spark, SF, 1), B.LOAD2[0], B.BATCH2_UPPER, B.LOAD2[1])
    jobs.run_silver(spark, lake, orders, B.LOAD2[0], B.LOAD2[1])
    silver = read_snapshot(spark, lake.silver("orders"))
    assert silver.count() == spark.read.parquet(f"{SF}/orders.parquet").count()
    assert silver.groupBy("order_id").count().where("count > 1").count() == 0
    assert r1.records_loaded + r2.records_loaded == silver.count()

    # customers through SCD2 and the marts
    cust = COLLECTIONS["customers"]
    src = B.customers_raw(spark, SF).withColumn("updated_at", F.lit("2023-06-01 00:00:00").cast("timestamp_ntz"))
    jobs.run_bronze(spark, lake, cust, src, B.LOAD1[0], "2023-12-31 23:59:59", B.LOAD1[1])
    jobs.run_silver(spark, lake, cust, B.LOAD1[0], B.LOAD1[1])
    assert read_scd2_current(spark, lake.silver("customers")).count() > 0

    res = jobs.run_gold(spark, lake, "2024-02-01", B.LOAD2[1], order_lines=B.order_lines(spark, SF))
    assert res.status == "PARTIAL"  # products/reviews were never loaded
    assert set(res.extra["built"]) == {"customer_sales_summary", "order_analytics"}

    audit = spark.read.parquet(lake.audit)
    assert audit.where("layer = 'bronze'").count() == 3
    assert audit.where("layer = 'gold' AND status = 'PARTIAL'").count() == 1


def test_empty_extract_does_not_move_mark(spark):
    lake = jobs.Lake(scratch_path(spark, "e2e-empty"))
    orders = COLLECTIONS["orders"]
    jobs.init_registry(spark, lake, [orders], B.LOAD1[1])
    r = jobs.run_bronze(spark, lake, orders, B.orders_source(spark, SF, 1), B.LOAD1[0], "1900-01-01 00:00:00", B.LOAD1[1])
    assert r.records_loaded == 0
    reg = jobs.read_registry(spark, lake).collect()[0]
    assert reg.last_loaded_timestamp == datetime(1970, 1, 1)
    audit = spark.read.parquet(lake.audit).collect()[0]
    assert audit.status == "SUCCESS" and audit.records_loaded == 0
    assert audit.watermark_end == audit.watermark_start == datetime(1970, 1, 1)  # the mark did not move


def test_same_day_reruns_keep_both_deltas(spark):
    lake = jobs.Lake(scratch_path(spark, "e2e-rerun"))
    orders = COLLECTIONS["orders"]
    jobs.init_registry(spark, lake, [orders], B.LOAD1[1])
    src = B.orders_source(spark, SF, 1)
    a = jobs.run_bronze(spark, lake, orders, src, B.LOAD1[0], "1997-12-31 23:59:59", B.LOAD1[1])
    b = jobs.run_bronze(spark, lake, orders, src, B.LOAD1[0], B.BATCH1_UPPER, B.LOAD1[1])
    day = partition_scan(spark, lake.bronze("orders"), "load_date", B.LOAD1[0])
    assert day.count() == a.records_loaded + b.records_loaded
    assert day.select("run_id").distinct().count() == 2


def test_failed_run_is_audited_and_mark_kept(spark):
    lake = jobs.Lake(scratch_path(spark, "e2e-fail"))
    orders = COLLECTIONS["orders"]
    jobs.init_registry(spark, lake, [orders], B.LOAD1[1])
    broken = B.orders_source(spark, SF, 1).withColumn("updated_at", F.lit("x"))  # no usable watermark
    try:
        jobs.run_bronze(spark, lake, orders, broken.drop("updated_at"), B.LOAD1[0], B.BATCH1_UPPER, B.LOAD1[1])
    except Exception:  # noqa: BLE001 - the failure itself is expected
        pass
    else:
        raise AssertionError("run should fail")
    audit = spark.read.parquet(lake.audit).collect()
    assert [(r.layer, r.status) for r in audit] == [("bronze", "FAILED")]
    assert audit[0].error_message
    assert jobs.read_registry(spark, lake).collect()[0].last_loaded_timestamp == datetime(1970, 1, 1)


def test_gold_failed_when_nothing_builds(spark):
    lake = jobs.Lake(scratch_path(spark, "e2e-gold"))
    jobs.init_registry(spark, lake, list(COLLECTIONS.values()), B.LOAD1[1])
    res = jobs.run_gold(spark, lake, "2024-02-01", B.LOAD2[1])
    assert res.status == "FAILED" and res.extra["built"] == []


def test_silver_logs_drift_and_reconciles(spark):
    lake = jobs.Lake(scratch_path(spark, "e2e-drift"))
    spec = COLLECTIONS["orders"]
    jobs.init_registry(spark, lake, [spec], B.LOAD1[1])
    src1 = B.orders_source(spark, SF, 1)
    jobs.run_bronze(spark, lake, spec, src1, B.LOAD1[0], "1997-12-31 23:59:59", B.LOAD1[1])
    jobs.run_silver(spark, lake, spec, B.LOAD1[0], B.LOAD1[1])
    # the source gains a column and drops another
    src2 = src1.withColumn("channel", F.lit("web")).drop("currency")
    jobs.run_bronze(spark, lake, spec, src2, B.LOAD2[0], B.BATCH1_UPPER, B.LOAD2[1])
    jobs.run_silver(spark, lake, spec, B.LOAD2[0], B.LOAD2[1])
    events = {(r.change_type, r.column_name) for r in spark.read.parquet(lake.drift).collect()}
    assert events == {("ADD_COLUMN", "channel"), ("DROP_COLUMN", "currency")}
    silver = read_snapshot(spark, lake.silver("orders"))
    assert {"channel", "currency"} <= set(silver.columns)
    assert silver.where("channel = 'web'").count() > 0 and silver.where("currency = 'USD'").count() > 0


def test_scd2_silver_with_drift(spark):
    lake = jobs.Lake(scratch_path(spark, "e2e-drift2"))
    spec = COLLECTIONS["customers"]
    jobs.init_registry(spark, lake, [spec], B.LOAD1[1])
    src = B.customers_raw(spark, SF).withColumn("updated_at", F.lit("2023-06-01 00:00:00").cast("timestamp_ntz"))
    jobs.run_bronze(spark, lake, spec, src, B.LOAD1[0], "2023-12-31 23:59:59", B.LOAD1[1])
    jobs.run_silver(spark, lake, spec, B.LOAD1[0], B.LOAD1[1])
    later = src.withColumn("updated_at", F.lit("2023-07-01 00:00:00").cast("timestamp_ntz")).withColumn("tier", F.lit("gold"))
    jobs.run_bronze(spark, lake, spec, later, B.LOAD2[0], "2023-12-31 23:59:59", B.LOAD2[1])
    jobs.run_silver(spark, lake, spec, B.LOAD2[0], B.LOAD2[1])
    current = read_scd2_current(spark, lake.silver("customers"))
    assert current.where("version_number = 2 AND tier = 'gold'").count() == current.count()
    events = [(r.change_type, r.column_name) for r in spark.read.parquet(lake.drift).collect()]
    assert events == [("ADD_COLUMN", "tier")]


def test_fractional_mark_is_not_extracted_again(spark):
    lake = jobs.Lake(scratch_path(spark, "e2e-frac"))
    spec = COLLECTIONS["orders"]
    jobs.init_registry(spark, lake, [spec], B.LOAD1[1])
    src = B.orders_source(spark, SF, 1).limit(1).withColumn("updated_at", F.lit("2000-01-01 10:00:00.500001").cast("timestamp_ntz"))
    counts = [jobs.run_bronze(spark, lake, spec, src, B.LOAD1[0], B.LOAD1[1], B.LOAD1[1]).records_loaded for _ in range(2)]
    assert counts == [1, 0]


def test_interleaved_advances_both_survive(spark):
    from strata.operators import control

    lake = jobs.Lake(scratch_path(spark, "e2e-marks"))
    jobs.init_registry(spark, lake, list(COLLECTIONS.values()), B.LOAD1[1])
    for name, at in (("orders", "2000-01-01"), ("reviews", "2001-01-01"), ("orders", "1999-01-01")):
        row = [(name, datetime.fromisoformat(at), "run", datetime(2024, 1, 1))]
        spark.createDataFrame(row, control.MARKS_SCHEMA).write.mode("append").parquet(lake.marks)
    marks = {r.collection_name: r.last_loaded_timestamp for r in jobs.read_registry(spark, lake).collect()}
    assert marks["orders"] == datetime(2000, 1, 1) and marks["reviews"] == datetime(2001, 1, 1)
    assert marks["customers"] == datetime(1970, 1, 1)


def test_silver_run_twice_is_a_no_op(spark):
    lake = jobs.Lake(scratch_path(spark, "e2e-twice"))
    spec = COLLECTIONS["customers"]
    jobs.init_registry(spark, lake, [spec], B.LOAD1[1])
    src = B.customers_raw(spark, SF).withColumn("updated_at", F.lit("2023-06-01 00:00:00").cast("timestamp_ntz"))
    jobs.run_bronze(spark, lake, spec, src, B.LOAD1[0], "2023-12-31 23:59:59", B.LOAD1[1])
    seen = []
    for _ in range(2):
        jobs.run_silver(spark, lake, spec, B.LOAD1[0], B.LOAD1[1])
        full = read_scd2_full(spark, lake.silver("customers"))
        seen.append(sorted(map(repr, full.collect())))
    assert seen[0] == seen[1]


def test_orders_get_item_features(spark):
    spec = COLLECTIONS["orders"]
    raw = B.event_order_docs_json(spark, SF).select(
        "order_id", F.lit("1").alias("customer_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"), "items"
    )
    out = jobs.prepare_batch(raw, spec)
    assert {"items", "items_count", "total_items_qty"} <= set(out.columns)
    assert out.where("items_count = 2").count() > 0
