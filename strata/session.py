"""Session helpers: shared scratch location and one directory listing.

Intermediate tables and checkpoints always go under the folder the cluster
names in ``spark.checkpoint.dir``.  Only when it is unset on a local master
(tests) a fresh local folder is set as the checkpoint directory; on a cluster
that is an error, as a local folder would not be shared.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint directory; set a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="strata-ckpt-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A few rows made on the driver, handed over as an Arrow table (no Python
    worker has to start for them)."""
    struct = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = to_arrow_schema(struct)
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=fields), struct)


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to shared scratch and read back, so what follows
    does not compute it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty if it does not exist)."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory())
