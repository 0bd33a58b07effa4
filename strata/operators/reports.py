"""Reports over marts and the run audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.exact import exact_sums


def latest_snapshot(snapshots: DataFrame, column: str = "report_date") -> DataFrame:
    """Rows of the newest snapshot (``column = max(column)``).

    The max is an uncorrelated scalar subquery; on a partitioned scan Spark
    evaluates it first and prunes partitions with the result.
    """
    latest = snapshots.agg(F.max(column)).scalar()
    return snapshots.where(F.col(column) == latest)


def top_customers_latest(summary_snapshots: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` customers by revenue in the newest summary snapshot
    (ties broken by customer id so the cut is deterministic)."""
    return (
        latest_snapshot(summary_snapshots)
        .orderBy(F.col("total_revenue").desc(), F.col("customer_id").asc())
        .limit(n)
        .select(
            "customer_id",
            "full_name",
            "country",
            "total_orders",
            F.round("total_revenue", 2).alias("revenue"),
            "lifetime_value_tier",
        )
    )


def daily_order_trend(analytics_snapshots: DataFrame, as_of: str, days: int = 30, mode: str = "latest") -> DataFrame:
    """Orders, revenue and mean of daily average order value per order date.

    ``latest``: the newest snapshot taken on or before ``as_of``; order dates
    within the ``days`` before ``as_of``.  Each order is counted once.
    ``snapshots``: the reference's form: every snapshot whose report date lies
    in the window is summed, which counts an order once per snapshot.
    """
    day = F.to_date(F.lit(as_of))
    start = F.date_sub(day, days)
    if mode == "latest":
        eligible = analytics_snapshots.where(F.col("report_date") <= F.date_format(day, "yyyy-MM-dd"))
        rows = latest_snapshot(eligible).where(
            (F.col("order_date") >= F.date_format(start, "yyyy-MM-dd"))
            & (F.col("order_date") <= F.date_format(day, "yyyy-MM-dd"))
        )
    elif mode == "snapshots":
        rows = analytics_snapshots.where(F.col("report_date") >= F.date_format(start, "yyyy-MM-dd"))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    days_ = exact_sums(
        rows,
        ["order_date"],
        {"revenue": "total_revenue", "aov": "avg_order_value"},
        {"orders": (F.sum("total_orders"), F.sum("orders")), "_n_aov": (F.count("avg_order_value"), F.sum("_n_aov"))},
    )
    mean = F.try_divide("aov", "_n_aov")
    return days_.select(
        "order_date", "orders", F.round("revenue", 2).alias("revenue"), F.round(mean, 2).alias("aov")
    ).orderBy("order_date")


def run_summary(audit: DataFrame) -> DataFrame:
    """Runs per (collection, layer): totals and success / failure counts."""
    return (
        audit.groupBy("collection_name", "layer")
        .agg(
            F.count(F.lit(1)).alias("total_runs"),
            F.sum("records_extracted").alias("total_extracted"),
            F.sum("records_loaded").alias("total_loaded"),
            F.count_if(F.col("status") == "SUCCESS").alias("successful_runs"),
            F.count_if(F.col("status") == "FAILED").alias("failed_runs"),
            F.max("pipeline_start_time").alias("last_run"),
        )
        .orderBy("collection_name", "layer")
    )


def recent_runs(audit: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` most recent runs (top-k, run id breaks ties)."""
    return (
        audit.orderBy(F.col("pipeline_start_time").desc(), F.col("run_id").desc())
        .limit(n)
        .select("run_id", "collection_name", "layer", "status", "records_loaded", "pipeline_start_time", "duration_seconds")
    )
