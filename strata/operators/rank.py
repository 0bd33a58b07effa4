"""``rank()`` within a group, ordered by a value descending, for any group size.

A rank is one plus the number of rows of the group with a strictly greater
value.  ``rank_within_skew_safe`` never puts a whole group in one task:

0. the rows are written once, so they are not computed again for the last
   step, and both steps see the same values bit for bit;
1. rows are reduced to distinct ``(group, value)`` pairs with their counts
   (partial aggregation collapses tied rows map-side);
2. the pairs are range-partitioned by group and value, so a group with a
   third of all pairs lies in a third of the partitions; each pair is tagged
   with its partition and written once, so every use below sees the same cut;
3. a window over ``(group, partition)`` counts the greater values in the
   partition, a window over the per-partition totals those in the partitions
   before it (at most one row per group and partition);
4. the ranks are joined back on ``(group, value)``.

Values may have any orderable type; NULL and NaN rank as in ``rank()`` over a
descending window (NaN first, NULL last).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import checkpoint_root, materialized


def rank_within_skew_safe(df: DataFrame, group: str, value: str, name: str, parts: int | None = None) -> DataFrame:
    """``df`` with the rank as integer column ``name``.

    ``parts``: range partitions, by default the session's shuffle partitions.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    n = max(1, parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
    df = materialized(df, "rank-rows")
    pairs = df.groupBy(F.col(group).alias("_g"), F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    order = F.col("_v").desc()
    cut = (
        pairs.repartitionByRange(n, F.col("_g").asc(), order)
        .withColumn("_p", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    inside = Window.partitionBy("_g", "_p").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("_tg").orderBy("_tp").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(F.col("_g").alias("_tg"), F.col("_p").alias("_tp")).agg(F.sum("_n").alias("_sum"))
    totals = totals.withColumn("_before", F.coalesce(F.sum("_sum").over(across), F.lit(0)))
    same = F.col("_g").eqNullSafe(F.col("_tg")) & (F.col("_p") == F.col("_tp"))
    ranks = (
        cut.withColumn("_here", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(totals, same)
        .select("_g", "_v", (F.col("_here") + F.col("_before") + 1).cast("int").alias("_rank"))
    )
    on = F.col(group).eqNullSafe(F.col("_g")) & F.col(value).eqNullSafe(F.col("_v"))
    return df.join(ranks, on, "left").select(*df.columns, F.col("_rank").alias(name))
