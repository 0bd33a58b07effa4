"""Physical-plan shapes the scale design relies on."""

import pytest

import __spark_entry__ as E
from strata.operators import marts
from strata.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(spark, key):
    df = E.queries()[key](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "key",
    ["customer_order_agg", "product_item_agg", "product_review_agg", "order_analytics", "dedupe_latest", "run_summary"],
)
def test_aggregates_combine_map_side(spark, key):
    plan = _plan(spark, key)
    assert "partial_" in plan  # a partial aggregate runs before the exchange


def test_item_explosion_has_no_outer_join(spark):
    plan = _plan(spark, "order_items_explode")
    assert "LeftOuter" not in plan and "RightOuter" not in plan and "FullOuter" not in plan


def test_scd2_merge_reads_each_side_once(spark):
    out = E.queries()["scd2_merge"](spark, SF)
    optimized = out._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("Join FullOuter") == 1 and "hint" not in optimized


def test_order_analytics_shuffles_orders_once(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        orders = spark.range(9).selectExpr(
            "string(id) order_id", "string(id % 2) customer_id", "'completed' status", "1.0D total_amount",
            "timestamp_ntz'2024-01-01 00:00:00' created_at",
        )
        customers = spark.range(2).selectExpr("string(id) customer_id", "'DE' country")
        plan = marts.order_analytics(orders, customers)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # orders and customers to the join; then the map-side sums per bin, and per group
    assert plan.count("Exchange hashpartitioning") == 4
    assert plan.count("Exchange hashpartitioning(customer_id") == 2
    assert plan.count("partial_") >= 1


def test_watermark_window_reaches_the_scan(spark):
    plan = _plan(spark, "incremental_extract")
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan


def test_scans_are_column_pruned(spark):
    plan = _plan(spark, "customer_order_agg")
    # only the columns the aggregate needs are read from orders
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double" in plan


def test_no_cross_or_nested_loop_joins(spark):
    for key, fn in QUERIES.items():
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, key


def test_hot_order_is_split_by_aqe(spark):
    """One order holding a third of all lines: AQE splits it in the inner join
    of the flattened explosion (a single left outer join would not be split)."""
    import re

    from pyspark.sql import functions as F

    from strata.operators.items import join_lines

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 300000
        order_id = F.when(F.col("id") % 3 == 0, F.lit("0")).otherwise((F.col("id") % 50000).cast("string"))
        lines = spark.range(n).select(
            order_id.alias("order_id"),
            (F.col("id") % 1000).cast("string").alias("product_id"),
            F.lit(1).alias("qty"),
            F.lit(2.0).alias("unit_price"),
        )
        orders = spark.range(60000).select(F.col("id").cast("string").alias("order_id"))
        out = join_lines(orders, lines)
        assert len(out.collect()) == n + 10000  # every line plus one row per line-less order
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"SortMergeJoin\(skew=true\)[^\n]*Inner", plan)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_colocated_merge_shuffles_the_batch_only(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = E.queries()["scd2_merge_colocated"](spark, SF)._jdf.queryExecution().executedPlan()
        text = plan.toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    join = text[text.index("SortMergeJoin") :].splitlines()
    scan = next(i for i, line in enumerate(join) if "Bucketed: true" in line)
    left = [line for line in join[:scan] if "Exchange" in line]
    assert not left, left  # no exchange above the scan of the current rows


def test_the_ranked_input_is_computed_once(spark):
    plan = E.queries()["top_products"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1  # the rows as written, not their joins and aggregates again
