"""Append logs that are folded: marks, run audit, drift.

Runs only ever append files to a log.  A *fold* writes the log's content as one
snapshot, reduced if the log allows it, together with the names of the files
it has read; readers take the snapshot and the files it does not name.  A file
that is appended while a fold runs is not named by it, so it stays in the tail
and the next fold takes it.  The snapshot is a version of a manifest: it is
there as a whole or not at all.  Any number of writers; one fold at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import materialized
from strata.sources import manifest
from strata.sources.publish import publish_version, read_snapshot

FILE = "_file"
Reduce = Callable[[DataFrame], DataFrame]


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def _snapshot_path(path: str) -> str:
    return f"{path}_folded"


def _parts(spark: SparkSession, path: str, schema) -> tuple[DataFrame | None, DataFrame | None]:
    """The snapshot (with the names of its files) and the tail (with its own)."""
    folded = read_snapshot(spark, _snapshot_path(path))
    tail = manifest.existing_table(spark, path, schema)
    if tail is not None:
        tail = tail.withColumn(FILE, F.col("_metadata.file_name"))
        if folded is not None:
            named = folded.where(F.col(FILE).isNotNull()).select(F.col(FILE).alias("_named"))
            tail = tail.join(named, F.col(FILE) == F.col("_named"), "left_anti")
    return folded, tail


def read(spark: SparkSession, path: str, schema, reduce: Reduce | None = None) -> DataFrame | None:
    """All rows of a log (reduced), or None where nothing has been appended."""
    folded, tail = _parts(spark, path, schema)
    found = [p.drop(FILE) for p in (None if folded is None else folded.where(F.col(FILE).isNull()), tail) if p is not None]
    if not found:
        return None
    rows = found[0] if len(found) == 1 else found[0].unionByName(found[1], allowMissingColumns=True)
    return rows if reduce is None else reduce(rows)


def fold(spark: SparkSession, path: str, schema, reduce: Reduce | None = None) -> str | None:
    """Fold the tail into a new snapshot; its version, or None without a log.

    The tail's file names and rows come from one read, so no row of a file that
    is named can be missing.
    """
    folded, tail = _parts(spark, path, schema)
    if tail is None:
        return None
    seen = materialized(tail, "log-tail")  # rows and names of the same files
    rows = seen.drop(FILE)
    names = seen.select(FILE).distinct()
    if folded is not None:
        rows = folded.where(F.col(FILE).isNull()).drop(FILE).unionByName(rows, allowMissingColumns=True)
        names = folded.where(F.col(FILE).isNotNull()).select(FILE).unionByName(names)
    if reduce is not None:
        rows = reduce(rows)
    whole = rows.withColumn(FILE, F.lit(None).cast("string")).unionByName(names, allowMissingColumns=True)
    return publish_version(whole.coalesce(1), _snapshot_path(path))
