"""Latest-row-per-key and any-row-per-key deduplication.

Both are expressed as a grouped ``max``/``min`` over a struct whose leading
fields are the ordering columns and whose last field is the whole row.  Struct
comparison is lexicographic, so the winner is exactly the first row of
``ORDER BY wm DESC, tiebreak... DESC`` (NULL sorts lowest, like
``DESC NULLS LAST``), and ties that survive all ordering columns are broken by
the remaining row content, so the result is deterministic.

Being an aggregate, it runs partial (map-side) before the shuffle: a key that
holds a third of all rows is reduced to one candidate per input partition
before anything moves, unlike a window sort that would ship every row of the
hot key into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Keep, per key, the row with the greatest ``(order_by..., tiebreak...)``."""
    ordering = [*order_by, *[c for c in tiebreak if c not in order_by]]
    return _pick(df, keys, ordering, F.max_by)


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, chosen deterministically (smallest row content)."""
    return _pick(df, keys, [], F.min_by)


def _orderable(data_type: DataType) -> bool:
    if isinstance(data_type, (MapType, VariantType)):
        return False
    if isinstance(data_type, ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, StructType):
        return all(_orderable(f.dataType) for f in data_type.fields)
    return True


def _pick(df: DataFrame, keys: Sequence[str], ordering: Sequence[str], best) -> DataFrame:
    """One whole row per key: by ``ordering``, then by the other columns.

    Columns that have no order (maps) come last, as JSON.
    """
    order = [F.col(c) for c in ordering]
    order += [F.col(f.name) for f in df.schema.fields if f.name not in ordering and _orderable(f.dataType)]
    order += [F.to_json(F.struct(f.name)) for f in df.schema.fields if not _orderable(f.dataType)]
    row = F.struct(*[F.col(c) for c in df.columns])
    by = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    return df.groupBy(*keys).agg(best(row, by).alias("_best")).select("_best.*")
