"""Control plane as Spark tables: collection registry, watermarks, run audit.

The registry is a small keyed table; updates to it are keyed merges (join +
coalesce), published as a new snapshot version, never in-place updates.
High-water marks are computed by Spark from the collections themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import ts_literal
from strata.rules import EPOCH_MARK, GOLD_MARTS, CollectionSpec
from strata.session import local_frame

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("collection_name", T.StringType(), False),
        T.StructField("source_database", T.StringType()),
        T.StructField("watermark_column", T.StringType()),
        T.StructField("scd_type", T.IntegerType()),
        T.StructField("primary_key_column", T.StringType()),
        T.StructField("active_flag", T.BooleanType()),
        T.StructField("bronze_path", T.StringType()),
        T.StructField("silver_path", T.StringType()),
        T.StructField("gold_path", T.StringType()),
        T.StructField("partition_column", T.StringType()),
        T.StructField("schema_version", T.StringType()),
    ]
)

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("collection_name", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("pipeline_start_time", T.TimestampNTZType()),
        T.StructField("pipeline_end_time", T.TimestampNTZType()),
        T.StructField("duration_seconds", T.DecimalType(10, 2)),
        T.StructField("records_extracted", T.LongType()),
        T.StructField("records_loaded", T.LongType()),
        T.StructField("records_failed", T.LongType()),
        T.StructField("watermark_start", T.TimestampNTZType()),
        T.StructField("watermark_end", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("output_path", T.StringType()),
        T.StructField("records_skipped", T.LongType()),
        T.StructField("dag_id", T.StringType()),
        T.StructField("task_id", T.StringType()),
        T.StructField("spark_job_id", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

LAYERS = ("bronze", "silver", "gold")
STATUSES = ("RUNNING", "SUCCESS", "FAILED", "PARTIAL")


def spec_rows(specs: Iterable[CollectionSpec], lake_root: str, active: bool = True) -> list[tuple]:
    rows = []
    for s in specs:
        gold = GOLD_MARTS.get(s.name)
        rows.append(
            (
                s.name,
                s.source_database,
                s.watermark_column,
                s.scd_type,
                s.primary_key,
                active,
                f"{lake_root}/bronze/{s.name}",
                f"{lake_root}/silver/{s.name}",
                f"{lake_root}/gold/{gold}" if gold else None,
                "load_date",
                "1.0",
            )
        )
    return rows


def collection_marks(frames: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``(collection_name, mark)`` = max of each collection's watermark column.

    One global aggregate per collection (partial per partition, one row out).
    """
    parts = [
        df.agg(F.max(F.col(wm)).alias("mark")).select(F.lit(name).alias("collection_name"), "mark")
        for name, (df, wm) in frames.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_registry(spark: SparkSession, rows: list[tuple], marks: DataFrame | None, as_of: str) -> DataFrame:
    """Registry frame; ``last_loaded_timestamp`` from ``marks`` (else epoch)."""
    base = local_frame(spark, rows, REGISTRY_SCHEMA)
    if marks is not None:
        base = base.join(marks.withColumnRenamed("collection_name", "_c"), F.col("collection_name") == F.col("_c"), "left")
        mark = F.coalesce(F.col("mark").cast("timestamp_ntz"), ts_literal(EPOCH_MARK))
    else:
        mark = ts_literal(EPOCH_MARK)
    return base.select(
        *[f.name for f in REGISTRY_SCHEMA.fields],
        mark.alias("last_loaded_timestamp"),
        ts_literal(as_of).alias("created_at"),
        ts_literal(as_of).alias("updated_at"),
    )


def active_collections(registry: DataFrame) -> DataFrame:
    return (
        registry.where(F.col("active_flag"))
        .select(
            "collection_name",
            "watermark_column",
            "last_loaded_timestamp",
            "scd_type",
            "primary_key_column",
            "bronze_path",
            "silver_path",
            "gold_path",
        )
        .orderBy("collection_name")
    )


def collection_by_name(registry: DataFrame, name: str) -> DataFrame:
    return registry.where(F.col("collection_name") == name)


def watermark_status(registry: DataFrame) -> DataFrame:
    return registry.select("collection_name", "last_loaded_timestamp", "active_flag").orderBy("collection_name")


def registry_upsert(registry: DataFrame, requests: DataFrame, as_of: str) -> DataFrame:
    """Onboard or re-register collections by name.

    New names are inserted (mark at epoch).  Existing names take the new
    watermark column, SCD type and key, are re-activated and get a fresh
    ``updated_at``; paths and the stored mark are kept.
    """
    r = requests.select(
        F.col("collection_name").alias("_n"),
        F.col("watermark_column").alias("_wm"),
        F.col("scd_type").cast("int").alias("_scd"),
        F.col("primary_key_column").alias("_pk"),
        *[F.col(c).alias(f"_{c}") for c in ("source_database", "bronze_path", "silver_path", "gold_path")],
    )
    j = registry.join(r, F.col("collection_name") == F.col("_n"), "full_outer")
    hit = F.col("_n").isNotNull()
    old = F.col("collection_name").isNotNull()
    t = ts_literal(as_of)
    return j.select(
        F.coalesce("collection_name", "_n").alias("collection_name"),
        F.coalesce("source_database", "_source_database").alias("source_database"),
        F.when(hit, F.col("_wm")).otherwise(F.col("watermark_column")).alias("watermark_column"),
        F.when(hit, F.col("_scd")).otherwise(F.col("scd_type")).alias("scd_type"),
        F.when(hit, F.col("_pk")).otherwise(F.col("primary_key_column")).alias("primary_key_column"),
        F.when(hit, F.lit(True)).otherwise(F.col("active_flag")).alias("active_flag"),
        F.when(old, F.col("bronze_path")).otherwise(F.col("_bronze_path")).alias("bronze_path"),
        F.when(old, F.col("silver_path")).otherwise(F.col("_silver_path")).alias("silver_path"),
        F.when(old, F.col("gold_path")).otherwise(F.col("_gold_path")).alias("gold_path"),
        F.coalesce("partition_column", F.lit("load_date")).alias("partition_column"),
        F.coalesce("schema_version", F.lit("1.0")).alias("schema_version"),
        F.coalesce("last_loaded_timestamp", ts_literal(EPOCH_MARK)).alias("last_loaded_timestamp"),
        F.coalesce("created_at", t).alias("created_at"),
        F.when(hit, t).otherwise(F.col("updated_at")).alias("updated_at"),
    )


MARKS_SCHEMA = "collection_name string, mark timestamp_ntz, run_id string, advanced_at timestamp_ntz"


def latest_marks(marks: DataFrame) -> DataFrame:
    """One row per collection: its largest mark, with the run that set it."""
    top = F.max_by(F.struct("mark", "run_id"), F.struct("mark", "advanced_at", "run_id"))
    last = marks.groupBy("collection_name").agg(top.alias("_top"), F.max("advanced_at").alias("advanced_at"))
    return last.select("collection_name", "_top.mark", "_top.run_id", "advanced_at")


def with_marks(registry: DataFrame, marks: DataFrame | None) -> DataFrame:
    """The registry with each collection's mark raised to the largest one in
    the log of advances.  Runs only append to that log, so runs of different
    collections cannot undo each other's marks."""
    if marks is None:
        return registry
    last = marks.groupBy(F.col("collection_name").alias("_n")).agg(
        F.max("mark").alias("_mark"), F.max("advanced_at").alias("_at")
    )
    moved = F.col("active_flag") & (F.col("_mark") > F.col("last_loaded_timestamp"))
    return registry.join(last, F.col("collection_name") == F.col("_n"), "left").select(
        *[c for c in registry.columns if c not in ("last_loaded_timestamp", "updated_at")],
        F.when(moved, F.col("_mark")).otherwise(F.col("last_loaded_timestamp")).alias("last_loaded_timestamp"),
        F.when(moved, F.greatest("updated_at", "_at")).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def advance_watermark(registry: DataFrame, collection: str, new_mark: DataFrame, as_of: str) -> DataFrame:
    """Move one collection's mark to ``new_mark`` (a one-row frame with column
    ``mark``, e.g. the max watermark of the rows just loaded).

    Only an active collection moves, and a mark never moves back; an empty
    batch (NULL mark) leaves it where it is.
    """
    mark = new_mark.agg(F.max(F.col("mark").cast("timestamp_ntz"))).scalar()  # uncorrelated scalar subquery
    moves = (F.col("collection_name") == collection) & F.col("active_flag") & (mark > F.col("last_loaded_timestamp"))
    return registry.select(
        *[c for c in registry.columns if c not in ("last_loaded_timestamp", "updated_at")],
        F.when(moves, mark).otherwise(F.col("last_loaded_timestamp")).alias("last_loaded_timestamp"),
        F.when(moves, ts_literal(as_of)).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def audit_record(
    spark: SparkSession,
    run_id: str,
    collection: str,
    layer: str,
    start: str,
    end: str,
    status: str,
    records_extracted: int = 0,
    records_loaded: int = 0,
    records_failed: int = 0,
    watermark_start: str | None = None,
    watermark_end: str | None = None,
    error_message: str | None = None,
    output_path: str | None = None,
    records_skipped: int = 0,
    dag_id: str | None = None,
    task_id: str | None = None,
) -> DataFrame:
    """One audit row describing one run (built from values captured by the
    job itself, so it can be written even when the run failed)."""
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}")
    if status not in STATUSES:
        raise ValueError(f"status must be one of {STATUSES}")
    from datetime import datetime
    from decimal import Decimal

    def ts(v):
        return None if v is None else datetime.fromisoformat(v)

    dur = Decimal(str(round((ts(end) - ts(start)).total_seconds(), 2))).quantize(Decimal("0.01"))
    row = (
        run_id, collection, layer, ts(start), ts(end), dur,
        int(records_extracted), int(records_loaded), int(records_failed),
        ts(watermark_start), ts(watermark_end), status, error_message, output_path,
        int(records_skipped), dag_id, task_id, spark.sparkContext.applicationId, ts(end),
    )
    return local_frame(spark, [row], AUDIT_SCHEMA)
