"""The document source: what it reads and what it opens."""

from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, IsNotNull, LessThan, LessThanOrEqual

from strata.session import scratch_path
from strata.sources.documents import DocumentReader, PushedReader, read_documents, write_documents

DAY = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def collection(spark):
    path = scratch_path(spark, "documents")
    df = spark.range(1000).select(
        F.col("id"), (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("at"),
        F.lit("ä\n\"x\"").alias("text"),
    )
    write_documents(df, path, "at", 8)
    return path


def test_window_rows_and_files(spark, collection):
    full = read_documents(spark, collection, "at")
    assert full.count() == 1000 and full.select("file").distinct().count() == 8
    part = read_documents(spark, collection, "at", str(DAY + timedelta(hours=100)), str(DAY + timedelta(hours=103)))
    rows = part.select(F.from_json("document", "id long, text string").alias("d"), "watermark").collect()
    assert sorted((r.d.id, r.d.text) for r in rows) == [(i, 'ä\n"x"') for i in (101, 102, 103)]
    assert part.rdd.getNumPartitions() <= 2


def test_files_outside_the_window_are_not_opened(spark, collection):
    """Files that cannot hold the window are replaced by rubbish: only a reader
    that opens them would notice."""
    fs_path = collection.removeprefix("file:")
    reader = DocumentReader({"path": collection, "watermark": "at", "after": "2024-01-03 00:00:00", "upto": "2024-01-04 00:00:00"})
    wanted = {f.name for f in reader.partitions()}
    index = pq.read_table(f"{fs_path}/index").to_pylist()
    assert 1 <= len(wanted) <= 2 and len(index) == 8
    import shutil
    import tempfile

    copy = tempfile.mkdtemp() + "/c"
    shutil.copytree(fs_path, copy)
    for r in index:
        if r["file"] not in wanted:
            with open(f"{copy}/documents/{r['file']}", "w") as f:
                f.write("not json\n")
    assert read_documents(spark, copy, "at", "2024-01-03 00:00:00", "2024-01-04 00:00:00").count() == 24


def test_pushed_filters_narrow_the_plan(collection):
    reader = PushedReader({"path": collection, "watermark": "at"})
    at = ("watermark",)
    filters = [GreaterThan(at, DAY + timedelta(hours=500)), LessThanOrEqual(at, DAY + timedelta(hours=510)), IsNotNull(at), LessThan(("file",), "x")]
    assert list(reader.pushFilters(filters)) == filters  # Spark applies them as well
    assert 1 <= len(reader.partitions()) <= 2
    one = PushedReader({"path": collection, "watermark": "at"})
    list(one.pushFilters([EqualTo(at, DAY + timedelta(hours=7))]))
    assert len(one.partitions()) == 1


def test_filters_reach_the_reader_through_spark(spark, collection):
    key = "spark.sql.python.filterPushdown.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        df = read_documents(spark, collection, "at").where("watermark > timestamp_ntz'2024-02-10 00:00:00'")
        assert df.count() == 1000 - 40 * 24 - 1
        assert df.rdd.getNumPartitions() <= 1
    finally:
        spark.conf.set(key, old)


def test_odd_lines(spark, tmp_path):
    (tmp_path / "documents").mkdir()
    (tmp_path / "documents" / "a.txt").write_text('{"at":"2024-01-01T00:00:00"}\n\n  \n{"x":1}\n{"at":null}')
    pq.write_table(pa.table({"file": ["a.txt"], "low": [DAY], "high": [DAY], "rows": [3]}), tmp_path / "index")
    assert read_documents(spark, str(tmp_path), "at").count() == 3
    assert read_documents(spark, str(tmp_path), "at", "2023-01-01 00:00:00", "2025-01-01 00:00:00").count() == 1


def test_empty_collection(spark):
    path = scratch_path(spark, "no-documents")
    write_documents(spark.createDataFrame([], "id int, at timestamp_ntz"), path, "at", 4)
    assert read_documents(spark, path, "at").count() == 0
