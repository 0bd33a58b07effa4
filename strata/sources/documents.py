"""A collection of JSON documents as a Spark data source.

A collection is a folder of JSON-lines files beside an ``index`` (Parquet, one
row per file: ``file, low, high, rows``) with the bounds of the watermark in
each file.  Reading it through :class:`DocumentSource` plans one partition per
file whose bounds meet the wanted window; other files are not opened.  The
window comes from filters on the watermark that Spark pushes down (with the
option ``pushdown``, where ``spark.sql.python.filterPushdown.enabled`` is on),
from the options ``after``
(exclusive) and ``upto`` (inclusive), or both; Spark applies the filters again,
so pruning never changes the rows.

A row is ``document`` (the line), ``watermark`` and the ``file``.  Batches are
Arrow tables of at most ``BATCH_BYTES`` of text.  Paths are those that pyarrow
opens (local, s3, gs, hdfs).

Defined cases: blank lines are skipped; a document without the watermark field
has a NULL one, which no window contains; an empty collection has no rows.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from strata.sources.extract import watermark_window

BATCH_BYTES = 8 << 20
SCHEMA = "document string, watermark timestamp_ntz, file string"
_ARROW = pa.schema([("document", pa.string()), ("watermark", pa.timestamp("us")), ("file", pa.string())])


class File(InputPartition):
    def __init__(self, name: str):
        self.name = name


def _open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class DocumentReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.field = options["path"].rstrip("/"), options["watermark"]
        as_time = lambda key: _dt.datetime.fromisoformat(options[key]) if key in options else None
        self.after, self.upto = as_time("after"), as_time("upto")

    def partitions(self) -> list[File]:
        fs, path = _open_fs(f"{self.path}/index")
        index = pq.read_table(path, filesystem=fs)
        files = []
        for r in index.to_pylist():
            low, high = r["low"], r["high"]
            if self.after is not None and (high is None or high <= self.after):
                continue
            if self.upto is not None and (low is None or low > self.upto):
                continue
            files.append(File(r["file"]))
        return sorted(files, key=lambda f: f.name)

    def read(self, partition: File | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no file can hold the window
            return
        fs, path = _open_fs(f"{self.path}/documents/{partition.name}")

        def batch(lines: list[str]) -> pa.RecordBatch:
            marks = [json.loads(line).get(self.field) for line in lines]
            marks = [None if m is None else _dt.datetime.fromisoformat(m) for m in marks]
            return pa.record_batch([pa.array(lines), pa.array(marks, pa.timestamp("us")), pa.array([partition.name] * len(lines))], schema=_ARROW)

        lines, size = [], 0
        with fs.open_input_stream(path) as stream:
            rest = b""
            while True:
                block = stream.read(BATCH_BYTES)
                *full, rest = (rest + block).split(b"\n") if block else (rest, b"")
                for line in full:
                    if line.strip():
                        lines.append(line.decode())
                        size += len(line)
                if lines and (size >= BATCH_BYTES or not block):
                    yield batch(lines)
                    lines, size = [], 0
                if not block:
                    return


class PushedReader(DocumentReader):
    """A reader that takes filters; Spark allows it only where the session
    pushes filters down to such sources."""

    def pushFilters(self, filters: list[Filter]):
        """Narrow the window; every filter goes back to Spark as well."""
        for f in filters:
            if getattr(f, "attribute", None) == ("watermark",):
                # bounds of whole files: strictness does not matter for the upper one
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    low = f.value if isinstance(f, GreaterThan) else f.value - _dt.timedelta(microseconds=1)
                    self.after = low if self.after is None else max(self.after, low)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.upto = f.value if self.upto is None else min(self.upto, f.value)
            yield f


class DocumentSource(DataSource):
    """``spark.dataSource.register(DocumentSource)``, then ``format("documents")``
    with the options ``path``, ``watermark`` and, if wanted, ``after``, ``upto``."""

    @classmethod
    def name(cls) -> str:
        return "documents"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DocumentReader:
        pushed = self.options.get("pushdown", "false").lower() == "true"
        return (PushedReader if pushed else DocumentReader)(self.options)


def write_documents(df: DataFrame, path: str, watermark: str, files: int) -> None:
    """Store ``df`` as a collection: files by ranges of the watermark, and the
    index of their bounds."""
    spark = df.sparkSession
    body = f"{path}/documents"
    dealt = df.repartitionByRange(files, F.col(watermark)).sortWithinPartitions(watermark)
    dealt.select(F.to_json(F.struct(*df.columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("value")).write.text(body)
    stored = spark.read.text(body).where(F.trim("value") != "").select(
        F.try_variant_get(F.try_parse_json("value"), f"$.{watermark}", "string").cast("timestamp_ntz").alias("w"),
        F.col("_metadata.file_name").alias("file"),
    )
    stored.groupBy("file").agg(F.min("w").alias("low"), F.max("w").alias("high"), F.count(F.lit(1)).alias("rows")).coalesce(1).write.parquet(
        f"{path}/index"
    )


def read_documents(
    spark: SparkSession, path: str, watermark: str, last: str | None = None, upper: str | None = None
) -> DataFrame:
    """Documents of the window ``(last, upper]``, or all of a collection."""
    spark.dataSource.register(DocumentSource)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    reader = spark.read.format("documents").options(path=path, watermark=watermark, pushdown=pushdown)
    if last is not None and upper is not None:
        return reader.option("after", last).option("upto", upper).load().where(watermark_window("watermark", last, upper))
    return reader.load()
