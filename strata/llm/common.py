"""Column helpers and shared-storage tables used by the training-data operators.

A *word* is a maximal run of characters other than space and U+0009..U+000D,
i.e. a match of ``[^\\x20\\x09-\\x0D]+``.  ``bytes.split()`` in Python cuts at
exactly those characters, so both sides of the package agree on words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import checkpoint_root, scratch_path

BLANK = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Array of words of ``text``; NULL and blank texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK, -1), "")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z (and nothing else) lower-cased."""
    return F.translate(text, UPPER, UPPER.lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts the lineage, lets later stages reuse the rows, and gives the planner
    the real size of the table (so a small one may be broadcast, a large one
    is not).  The files live in ``spark.checkpoint.dir``, which every executor
    can read, and survive the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the files of a table of :func:`materialize` that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    for name in df.inputFiles():
        path = sc._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, False)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


__all__ = ["BLANK", "UPPER", "ascii_lower", "checkpoint_root", "drop", "materialize", "partitions", "table", "words"]
