"""Reading sources: incremental extraction, partition scans, schema merging.

Any Spark batch source can feed the pipeline (parquet, json, csv, jdbc or a
connector ``format``); the high-water-mark window is a plain filter, so
Catalyst pushes it into the scan (``PushedFilters``) and a JDBC or document
source receives it as a source-side predicate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def watermark_window(column: str, last: str, upper: str, ts_type: str = "timestamp_ntz"):
    """Half-open window ``last < column <= upper``."""
    c = F.col(column)
    return (c > F.lit(last).cast(ts_type)) & (c <= F.lit(upper).cast(ts_type))


def incremental_extract(
    df: DataFrame, watermark_column: str, last: str, upper: str, ts_type: str = "timestamp_ntz"
) -> DataFrame:
    """Rows changed after the stored mark ``last`` up to ``upper`` inclusive."""
    return df.where(watermark_window(watermark_column, last, upper, ts_type))


def effective_upper(requested: str, as_of: str, safety_lag_seconds: int = 0) -> str:
    """Never extract beyond ``as_of`` minus a safety lag: a bound in the future
    would move the mark past rows that are still being written."""
    from datetime import datetime, timedelta

    cap = datetime.fromisoformat(as_of) - timedelta(seconds=safety_lag_seconds)
    return str(min(datetime.fromisoformat(requested), cap))


def partition_scan(spark: SparkSession, root: str, column: str, value: str, merge_schema: bool = False) -> DataFrame:
    """Read one partition of a ``column=value`` partitioned dataset.

    Only that partition's directory is listed and read (``basePath`` keeps
    ``column`` and any deeper partition columns); a root scan would first
    list every partition ever written.  Partition columns are typed STRING,
    as in the contracts, instead of an inferred DATE or number.
    """
    path = f"{root.rstrip('/')}/{column}={value}"
    reader = spark.read.option("basePath", root)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    inferred = reader.parquet(path).schema
    # what the files hold, read without the directory names
    stored = spark.read.option("mergeSchema", str(merge_schema).lower()).option("recursiveFileLookup", "true")
    in_files = set(stored.parquet(path).columns)
    schema = StructType([f if f.name in in_files else StructField(f.name, StringType(), True) for f in inferred.fields])
    return reader.schema(schema).parquet(path)


def merged_scan(spark: SparkSession, root: str, partition_column: str | None = None) -> DataFrame:
    """Read a dataset whose files carry different (compatible) schemas: missing
    columns come back as NULL.  Schema merging is enabled per read only."""
    reader = spark.read.option("mergeSchema", "true")
    df = reader.parquet(root)
    if partition_column and partition_column in df.columns:
        schema = StructType(
            [StructField(f.name, StringType(), True) if f.name == partition_column else f for f in df.schema.fields]
        )
        df = reader.schema(schema).parquet(root)
    return df
