"""Row fingerprints as columns.

Three encodings over the name-sorted content columns:

* ``compat``: md5 of ``|``-joined string casts, NULL rendered as ''.
  Matches the reference's silver hash, including its collisions
  (NULL == '' and a delimiter inside a value can shift fields).
* ``safe``: md5 of length-prefixed values with an explicit NULL marker;
  arrays, maps and structs are rendered as JSON with their NULLs.  No two
  different rows of one schema encode to the same string.
* ``json``: md5 of the JSON rendering of the row (NULL fields kept).
  The column form of the reference's per-row Python dictionary hash.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from strata.rules import AUDIT_COLUMNS


def hashed_columns(df: DataFrame, exclude: Iterable[str] = AUDIT_COLUMNS) -> list[str]:
    skip = set(exclude)
    return sorted(c for c in df.columns if c not in skip)


def _rendered(column: str, data_type: DataType | None) -> Column:
    """The value as a string; a nested one as JSON, where elements are quoted."""
    if isinstance(data_type, MapType):
        # entries in key order: equal maps may list them differently
        return F.to_json(F.array_sort(F.map_entries(column)), {"ignoreNullFields": "false"})
    if isinstance(data_type, (ArrayType, StructType)):
        return F.to_json(column, {"ignoreNullFields": "false"})
    return F.col(column).cast("string")


def fingerprint_expr(
    columns: list[str], mode: str = "compat", types: dict[str, DataType] | None = None
) -> Column:
    if mode == "compat":
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
        return F.md5(F.concat_ws("|", *parts))
    if mode == "safe":
        parts = []
        for c in columns:
            s = _rendered(c, (types or {}).get(c))
            parts.append(F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("~")))
        return F.md5(F.concat_ws("|", *parts))
    if mode == "json":
        row = F.struct(*[F.col(c) for c in columns])
        return F.md5(F.to_json(row, {"ignoreNullFields": "false"}))
    raise ValueError(f"unknown fingerprint mode {mode!r}")


def add_fingerprint(
    df: DataFrame,
    exclude: Iterable[str] = AUDIT_COLUMNS,
    mode: str = "compat",
    name: str = "record_hash",
) -> DataFrame:
    """Append (or replace) the fingerprint column ``name``."""
    cols = hashed_columns(df, set(exclude) | {name})
    keep = [c for c in df.columns if c != name]
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*keep, fingerprint_expr(cols, mode, types).alias(name))
