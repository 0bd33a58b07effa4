"""Extraction windows, partition scans, schema merging, publishing."""

from datetime import datetime

from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources import manifest, publish
from strata.sources.contracts import conform, contract
from strata.sources.extract import effective_upper, incremental_extract, merged_scan, partition_scan

SF = "/root/testdata/sf0.001"


def test_window_is_half_open(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2)), (3, datetime(2024, 1, 3))], "id int, wm timestamp_ntz"
    )
    out = incremental_extract(df, "wm", "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert [r.id for r in out.collect()] == [2]  # lower bound excluded, upper included


def test_window_pushed_to_parquet(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    plan = incremental_extract(ev, "ts", "2024-01-08 00:00:00", "2024-01-22 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan


def test_effective_upper_never_in_future():
    assert effective_upper("2024-01-02 23:59:59", "2024-01-02 10:00:00") == "2024-01-02 10:00:00"
    assert effective_upper("2024-01-01 23:59:59", "2024-01-02 10:00:00", 60) == "2024-01-01 23:59:59"


def test_partition_scan_prunes_and_keeps_string(spark):
    root = scratch_path(spark, "t-part")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, load_date string")
    df.write.partitionBy("load_date").parquet(root)
    out = partition_scan(spark, root, "load_date", "2024-01-02")
    assert dict(out.dtypes)["load_date"] == "string"
    assert [r.id for r in out.collect()] == [2]
    assert out.inputFiles() and all("/load_date=2024-01-02/" in f for f in out.inputFiles())


def test_partition_scan_nested_partitions_stay_strings(spark):
    root = scratch_path(spark, "t-nested")
    df = spark.createDataFrame([(1, "2024-01-01", "123"), (2, "2024-01-01", "456")], "id int, load_date string, run_id string")
    df.write.partitionBy("load_date", "run_id").parquet(root)
    out = partition_scan(spark, root, "load_date", "2024-01-01")
    assert dict(out.dtypes)["run_id"] == "string"
    assert sorted(r.run_id for r in out.collect()) == ["123", "456"]


def test_merged_scan_fills_missing_columns(spark):
    root = scratch_path(spark, "t-merge")
    publish.write_partition(spark.createDataFrame([(1,)], "id int"), root, {"load_date": "a"})
    publish.write_partition(spark.createDataFrame([(2, "x")], "id int, extra string"), root, {"load_date": "b"})
    rows = sorted(tuple(r) for r in merged_scan(spark, root, "load_date").select("id", "extra", "load_date").collect())
    assert rows == [(1, None, "a"), (2, "x", "b")]


def test_dynamic_overwrite_touches_one_partition(spark):
    root = scratch_path(spark, "t-dyn")
    publish.write_partition(spark.createDataFrame([(1,)], "id int"), root, {"load_date": "a"})
    publish.write_partition(spark.createDataFrame([(2,)], "id int"), root, {"load_date": "b"})
    publish.write_partition(spark.createDataFrame([(3,)], "id int"), root, {"load_date": "a"})
    rows = sorted(tuple(r) for r in spark.read.schema("id int, load_date string").parquet(root).collect())
    assert rows == [(2, "b"), (3, "a")]


def test_versions_and_failed_write_ignored(spark):
    root = scratch_path(spark, "t-ver")
    assert publish.read_snapshot(spark, root) is None  # first load
    publish.publish_version(spark.createDataFrame([(1,)], "id int"), root)
    # data without a manifest row (a run that died before its commit)
    spark.createDataFrame([(99,)], "id int").write.parquet(f"{root}/{manifest.new_folder(2)}")
    assert [r.id for r in publish.read_snapshot(spark, root).collect()] == [1]
    v = publish.publish_version(spark.createDataFrame([(2,)], "id int"), root)
    assert v == publish.latest_version(spark, root) == "v00000002"
    assert [r.id for r in publish.read_snapshot(spark, root).collect()] == [2]
    assert manifest.newest(spark, root, at_most=1).number == 1


def test_republish_while_reading_same_table(spark):
    root = scratch_path(spark, "t-self")
    publish.publish_version(spark.createDataFrame([(1,)], "id int"), root)
    current = publish.read_snapshot(spark, root)
    publish.publish_version(current.withColumn("id", F.col("id") + 1), root)
    assert [r.id for r in publish.read_snapshot(spark, root).collect()] == [2]


def test_scd2_layout(spark):
    root = scratch_path(spark, "t-scd2")
    v1 = spark.createDataFrame([("a", "current"), ("b", "current")], "k string, _outcome string")
    publish.publish_buckets(v1, root, "k", 1, [0])
    v2 = spark.createDataFrame([("a", "closed"), ("a2", "current"), ("b", "current"), ("z", "late")], "k string, _outcome string")
    _, written = publish.publish_buckets(v2, root, "k", 1, [0], manifest.newest(spark, root))
    assert written == {"current": 2, "closed": 1, "late": 1}
    cur = sorted(r.k for r in publish.read_scd2_current(spark, root).collect())
    full = sorted(r.k for r in publish.read_scd2_full(spark, root).collect())
    assert cur == ["a2", "b"] and full == ["a", "a2", "b"]
    assert [r.k for r in publish.read_late(spark, root).collect()] == ["z"]


def test_conform_contract(spark):
    df = spark.createDataFrame([("1", "12.5", "junk")], "order_id string, total_amount string, extra string")
    out = conform(df, contract("silver_orders"))
    assert out.schema == contract("silver_orders")
    r = out.collect()[0]
    assert r.total_amount == 12.5 and r.currency is None


def test_history_reads_every_version_with_its_own_schema(spark):
    root = scratch_path(spark, "t-drift")
    for row, schema in (
        ((1, "a", "current"), "n int, k string, _outcome string"),
        ((2, "a", "closed"), "n int, k string, _outcome string"),
        ((2**40, "b", "current", "vip"), "n bigint, k string, _outcome string, tier string"),
        ((7, "c", "closed", "x"), "n bigint, k string, _outcome string, tier string"),
    ):
        df = spark.createDataFrame([row], schema)
        publish.publish_buckets(df, root, "k", 1, [0], manifest.newest(spark, root))
    full = publish.read_scd2_full(spark, root)
    assert dict(full.dtypes)["n"] == "bigint"
    assert sorted((r.n, r.k, r.tier) for r in full.collect()) == [(2, "a", None), (7, "c", "x")]


def test_contracts_parse(spark):
    from strata.sources.contracts import CONTRACTS

    layers = [name.split("_")[0] for name in CONTRACTS]
    assert (layers.count("bronze"), layers.count("silver"), layers.count("gold")) == (5, 5, 3)
    assert all(len(contract(name).fields) > 5 for name in CONTRACTS)


def test_external_table_and_partition_repair(spark):
    from strata.sources.contracts import create_table, repair

    root = scratch_path(spark, "t-gold-table")
    schema = contract("gold_order_analytics")
    row = {f.name: None for f in schema.fields}
    row.update(order_date="2024-01-01", category="ALL", total_orders=1)
    data = spark.createDataFrame([tuple(row[f.name] for f in schema.fields)], schema)
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        publish.write_partition(data.drop("report_date"), root, {"report_date": day})
    create_table(spark, "gold_order_analytics_t", "gold_order_analytics", root)
    try:
        assert spark.sql("SHOW PARTITIONS gold_order_analytics_t").count() == 0
        repair(spark, "gold_order_analytics_t")
        assert spark.sql("SHOW PARTITIONS gold_order_analytics_t").count() == 3
        assert spark.table("gold_order_analytics_t").where("report_date = '2024-01-02'").count() == 1
    finally:
        spark.sql("DROP TABLE IF EXISTS gold_order_analytics_t")


def test_writes_add_their_partitions_to_the_catalog(spark):
    from strata.sources.contracts import CONTRACTS, PARTITION_COLUMNS, write_table

    assert set(PARTITION_COLUMNS) == set(CONTRACTS)  # every table is partitioned
    root, table = scratch_path(spark, "t-catalog"), "bronze_reviews_t"
    rows = spark.createDataFrame([("1", "p", 5.0)], "review_id string, product_id string, rating double")
    try:
        for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
            write_table(spark, rows, table, "bronze_reviews", root, day)
        assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()] == ["load_date=2024-01-01", "load_date=2024-01-02"]
        one = spark.table(table).where("load_date = '2024-01-02'")
        assert one.count() == 1 and all("load_date=2024-01-02" in f for f in one.inputFiles())
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
