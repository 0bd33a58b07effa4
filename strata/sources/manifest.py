"""Version manifests: which folders make up a version of a table.

A published table is a root with data folders and a ``manifest`` table beside
them.  A *commit* writes its data into a fresh folder and then appends its
manifest rows as one file, so a commit is there with its manifest file or not
at all: a run killed while it writes data leaves an unreferenced folder.  Data
folders are never overwritten.

One manifest row is one folder:

- ``kind = current``: rows of one key bucket that are live.  Every version
  lists all its buckets, whichever commit wrote them, so a commit that touches
  one bucket carries the others over by name.
- ``kind = closed`` (ended versions of rows) and ``late`` (rows that came too
  late to be applied): listed by the commit that added them only.

A row also keeps the folder's schema and the bounds of its validity interval,
so readers neither list folders nor open a file to learn its columns, and an
as-of read leaves out the folders whose interval rules them out.

What the driver handles is one row per bucket and one per commit with closed
rows: metadata.  One writer at a time per table.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.evolution import reconcile, unify_schemas
from strata.operators.scd import CURRENT
from strata.session import list_dirs

MANIFEST_SCHEMA = (
    "version long, kind string, buckets int, bucket int, folder string, schema string, "
    "valid_from timestamp_ntz, valid_to timestamp_ntz"
)
_ARROW = pa.schema(
    [("version", pa.int64()), ("kind", pa.string()), ("buckets", pa.int32()), ("bucket", pa.int32()), ("folder", pa.string()),
     ("schema", pa.string()), ("valid_from", pa.timestamp("us")), ("valid_to", pa.timestamp("us"))]
)


@dataclass(frozen=True)
class Folder:
    """One folder of a version, relative to the table's root."""

    kind: str
    buckets: int
    bucket: int
    folder: str
    schema: str
    valid_from: _dt.datetime | None = None
    valid_to: _dt.datetime | None = None

    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


@dataclass(frozen=True)
class Version:
    """A version: its number and the folders of its live rows."""

    number: int
    current: tuple[Folder, ...]

    @property
    def buckets(self) -> int:
        return self.current[0].buckets

    def schema(self) -> StructType:
        """Columns of the table: those of all its folders, oldest first."""
        distinct = dict.fromkeys(f.schema for f in sorted(self.current, key=lambda f: f.folder))
        return reduce(unify_schemas, (StructType.fromJson(json.loads(s)) for s in distinct))


def bucket_of(key: str, buckets: int) -> Column:
    """Bucket of a key.  It is Spark's own shuffle hash, so rows shuffled by
    the key into a multiple of ``buckets`` partitions are already grouped by
    bucket, and a write makes few files per bucket."""
    return F.pmod(F.hash(key), F.lit(buckets)).cast("int")


def existing_table(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame | None:
    """A Parquet table, or None where nothing has been written yet."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    return spark.read.schema(schema).parquet(path) if name in list_dirs(spark, parent) else None


def _rows(spark: SparkSession, root: str) -> DataFrame | None:
    return existing_table(spark, f"{root}/manifest", MANIFEST_SCHEMA)


def _folders(rows: Iterable) -> tuple[Folder, ...]:
    found = (Folder(r.kind, r.buckets, r.bucket, r.folder, r.schema, r.valid_from, r.valid_to) for r in rows)
    return tuple(sorted(found, key=lambda f: (f.bucket, f.folder)))


def newest(spark: SparkSession, root: str, at_most: int | None = None) -> Version | None:
    """The newest version (not after ``at_most``); None before the first."""
    rows = _rows(spark, root)
    if rows is None:
        return None
    if at_most is not None:
        rows = rows.where(F.col("version") <= at_most)
    last = rows.where(F.col("kind") == CURRENT).where(F.col("version") == rows.agg(F.max("version")).scalar())
    found = last.collect()
    return Version(found[0].version, _folders(found)) if found else None


def added(spark: SparkSession, root: str, kind: str, at_most: int | None = None) -> tuple[Folder, ...]:
    """Folders of ``closed`` or ``late`` rows that any commit added."""
    rows = _rows(spark, root)
    if rows is None:
        return ()
    if at_most is not None:
        rows = rows.where(F.col("version") <= at_most)
    return _folders(rows.where(F.col("kind") == kind).collect())


def new_folder(version: int) -> str:
    """A folder name for a commit's data; a failed commit's is not used again."""
    return f"data/v{version:08d}-{uuid.uuid4().hex[:12]}"


def commit(spark: SparkSession, root: str, version: int, folders: Sequence[Folder]) -> None:
    """Make ``folders`` (all live ones and the added others) version ``version``."""
    columns = ("kind", "buckets", "bucket", "folder", "schema", "valid_from", "valid_to")
    rows = {"version": [version] * len(folders), **{c: [getattr(f, c) for f in folders] for c in columns}}
    table = pa.table(rows, schema=_ARROW)
    # one file, so the commit appears at once
    spark.createDataFrame(table).coalesce(1).write.mode("append").parquet(f"{root}/manifest")


def read(spark: SparkSession, root: str, folders: Sequence[Folder], schema: StructType | None = None) -> DataFrame | None:
    """Rows of ``folders``, each read with its own schema and cast up to the
    columns of all (or of ``schema``); None for no folders and no schema."""
    by_schema: dict[str, list[str]] = {}
    for f in sorted(folders, key=lambda f: f.folder):
        by_schema.setdefault(f.schema, []).append(f"{root}/{f.folder}")
    out = None if schema is None else spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))
    for text, paths in by_schema.items():
        part = spark.read.schema(StructType.fromJson(json.loads(text))).parquet(*paths)
        if out is not None and part.schema != out.schema:
            out, part = reconcile(out, part)
        out = part if out is None else out.unionByName(part)
    return out
