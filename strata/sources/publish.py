"""Publishing: partition writes, versioned tables, observed metrics.

A path that is being read is never overwritten.  Cleansed tables are published
as *versions* of a manifest (see :mod:`strata.sources.manifest`): data goes to
a fresh folder, and the version is there once its manifest file is.  Task
retries inside a job are handled by Spark's output committer.

A table keyed by bucket rewrites the buckets a batch touches and carries the
others over; closed rows of an SCD2 table are appended, never rewritten.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.scd import CLOSED, CURRENT, LATE, OUTCOME, as_of_view
from strata.session import list_dirs
from strata.sources import manifest


def write_partition(
    df: DataFrame,
    root: str,
    partition_values: Mapping[str, str],
    compression: str = "snappy",
) -> str:
    """Overwrite exactly the partition(s) given by ``partition_values``
    (dynamic partition overwrite), leaving every other partition in place."""
    cols = [c for c in df.columns if c not in partition_values]
    out = df.select(*cols, *[F.lit(v).alias(k) for k, v in partition_values.items()])
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(*partition_values.keys())
        .parquet(root)
    )
    return root + "".join(f"/{k}={v}" for k, v in partition_values.items())


def partition_values(spark: SparkSession, root: str, column: str) -> list[str]:
    """Values of a top-level ``column=value`` partition, from one directory
    listing (no data files are opened)."""
    prefix = f"{column}="
    return sorted(d[len(prefix):] for d in list_dirs(spark, root) if d.startswith(prefix))


def read_latest_partition(
    spark: SparkSession, root: str, column: str, at_most: str | None = None
) -> DataFrame | None:
    """The newest ``column`` partition (optionally the newest not after
    ``at_most``), read alone.  Equivalent to filtering on
    ``column = (SELECT max(column) ...)`` but answered from the directory
    listing, so older snapshots are neither listed file by file nor opened."""
    from strata.sources.extract import partition_scan

    values = [v for v in partition_values(spark, root, column) if at_most is None or v <= at_most]
    if not values:
        return None
    return partition_scan(spark, root, column, values[-1])


# --------------------------------------------------------------------------
# versioned tables
# --------------------------------------------------------------------------

BUCKET = "_bucket"


def _version_name(n: int) -> str:
    return f"v{n:08d}"


def latest_version(spark: SparkSession, root: str) -> str | None:
    version = manifest.newest(spark, root)
    return None if version is None else _version_name(version.number)


def publish_version(df: DataFrame, root: str, compression: str = "snappy") -> str:
    """Write ``df`` as the whole of the next version; returns its name."""
    spark = df.sparkSession
    base = manifest.newest(spark, root)
    n = 1 if base is None else base.number + 1
    folder = manifest.new_folder(n)
    df.write.option("compression", compression).parquet(f"{root}/{folder}")
    manifest.commit(spark, root, n, [manifest.Folder(CURRENT, 1, 0, folder, df.schema.json())])
    return _version_name(n)


def publish_buckets(
    tagged: DataFrame,
    root: str,
    key: str,
    buckets: int,
    touched: Sequence[int],
    base: manifest.Version | None = None,
    compression: str = "snappy",
) -> tuple[str, dict[str, int]]:
    """Publish rows tagged ``current``, ``closed`` or ``late`` (column
    ``_outcome``) as the next version, in one write.

    ``tagged`` holds all current rows of the ``touched`` buckets; the other
    buckets of ``base`` are carried over by name, without being read.  Returns
    the version's name and the rows written per outcome.
    """
    spark = tagged.sparkSession
    n = 1 if base is None else base.number + 1
    folder = manifest.new_folder(n)
    schema = tagged.drop(OUTCOME).schema
    placed = tagged.withColumn(BUCKET, F.when(F.col(OUTCOME) == CURRENT, manifest.bucket_of(key, buckets)).otherwise(F.lit(0)))
    versioned = {"effective_date", "expiry_date"} <= set(schema.names)
    metrics = {o: F.count_if(F.col(OUTCOME) == o) for o in (CURRENT, CLOSED, LATE)}
    if versioned:
        ended = F.col(OUTCOME) == CLOSED
        metrics["low"] = F.min(F.when(ended, F.col("effective_date")))
        metrics["high"] = F.max(F.when(ended, F.col("expiry_date")))
    placed, seen = observed(placed, f"publish-{folder}", **metrics)
    placed.write.option("compression", compression).partitionBy(OUTCOME, BUCKET).parquet(f"{root}/{folder}")
    found = seen.get

    def written(kind: str, bucket: int, **bounds) -> manifest.Folder:
        return manifest.Folder(kind, buckets, bucket, f"{folder}/{OUTCOME}={kind}/{BUCKET}={bucket}", schema.json(), **bounds)

    mine = set(touched)
    folders = [f for f in base.current if f.bucket not in mine] if base is not None else []
    if found[CURRENT]:
        folders += [written(CURRENT, b) for b in sorted(mine)]
    elif not folders:  # a table without rows still has its columns
        placed.select(*schema.names).limit(0).write.parquet(f"{root}/{folder}/empty")
        folders = [manifest.Folder(CURRENT, buckets, 0, f"{folder}/empty", schema.json())]
    if found[CLOSED]:
        folders.append(written(CLOSED, 0, valid_from=found.get("low"), valid_to=found.get("high")))
    if found[LATE]:
        folders.append(written(LATE, 0))
    manifest.commit(spark, root, n, folders)
    return _version_name(n), {o: int(found[o]) for o in (CURRENT, CLOSED, LATE)}


def publish_colocated(df: DataFrame, table: str, key: str, buckets: int, location: str) -> None:
    """Write ``df`` as a Spark table bucketed and sorted by ``key``.

    With ``buckets`` equal to the shuffle partitions, a join on the key reads
    the table as it lies: only the other side is shuffled.  One file per
    bucket, as the rows are dealt by the bucketing hash before they are written.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", location).mode("errorifexists").saveAsTable(table)


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """Live rows of the newest version; None when nothing has been published
    yet (first load).  Read errors propagate."""
    version = manifest.newest(spark, root)
    return None if version is None else manifest.read(spark, root, version.current)


#: An SCD2 table's live rows are its current ones.
read_scd2_current = read_snapshot


def read_scd2_full(spark: SparkSession, root: str) -> DataFrame | None:
    """Current rows of the newest version plus the closed rows of all commits."""
    version = manifest.newest(spark, root)
    if version is None:
        return None
    return manifest.read(spark, root, (*manifest.added(spark, root, CLOSED), *version.current))


def read_late(spark: SparkSession, root: str) -> DataFrame | None:
    """Batch rows that came too late to be applied; None if there are none."""
    return manifest.read(spark, root, manifest.added(spark, root, LATE))


def read_scd2_as_of(spark: SparkSession, root: str, at: str) -> DataFrame | None:
    """Versions valid at time ``at``.  Folders of closed rows whose validity
    interval lies before or after ``at`` are not opened."""
    version = manifest.newest(spark, root)
    if version is None:
        return None
    t = datetime.fromisoformat(at)
    closed = [f for f in manifest.added(spark, root, CLOSED) if (f.valid_from is None or f.valid_from <= t) and (f.valid_to is None or t < f.valid_to)]
    return as_of_view(manifest.read(spark, root, (*closed, *version.current)), at)


# --------------------------------------------------------------------------
# metrics without extra jobs
# --------------------------------------------------------------------------

def observed(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """Attach named aggregate metrics that are computed by the write itself
    (``DataFrame.observe``), instead of separate ``count()`` jobs."""
    obs = Observation(name)
    exprs = [m.alias(k) for k, m in metrics.items()] or [F.count(F.lit(1)).alias("rows")]
    return df.observe(obs, *exprs), obs
