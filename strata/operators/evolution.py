"""Schema drift: detect added / dropped / retyped columns, log, reconcile.

Detection compares schemas (metadata); reconciliation is a single projection
per side, recursive over structs, arrays and maps: missing columns and fields
become typed NULLs, conflicting types are widened when a type exists that loses
nothing, otherwise the existing type stays and values that do not fit it are
kept as text in ``_rescued``.  Column order: existing ones first, then new ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import ts_literal
from strata.session import local_frame

ADD, DROP, RETYPE = "ADD_COLUMN", "DROP_COLUMN", "TYPE_CHANGE"


@dataclass(frozen=True)
class SchemaChange:
    change_type: str
    column_name: str
    old_type: str | None
    new_type: str | None


def _flatten(schema: T.StructType, nested: bool, prefix: str = "") -> dict[str, T.DataType]:
    out: dict[str, T.DataType] = {}
    for f in schema.fields:
        name = f"{prefix}{f.name}"
        out[name] = f.dataType
        if nested and isinstance(f.dataType, T.StructType):
            out.update(_flatten(f.dataType, nested, f"{name}."))
    return out


def compare_schemas(old: T.StructType, new: T.StructType, nested: bool = False) -> list[SchemaChange]:
    """Changes from ``old`` to ``new`` (top-level; ``nested`` walks structs)."""
    a, b = _flatten(old, nested), _flatten(new, nested)
    changes = [SchemaChange(ADD, n, None, b[n].simpleString()) for n in b if n not in a]
    changes += [SchemaChange(DROP, n, a[n].simpleString(), None) for n in a if n not in b]
    changes += [
        SchemaChange(RETYPE, n, a[n].simpleString(), b[n].simpleString())
        for n in b
        if n in a and a[n].simpleString() != b[n].simpleString()
        and not (nested and isinstance(a[n], T.StructType) and isinstance(b[n], T.StructType))
    ]
    return changes


DRIFT_SCHEMA = T.StructType(
    [
        T.StructField("collection_name", T.StringType()),
        T.StructField("change_type", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("old_type", T.StringType()),
        T.StructField("new_type", T.StringType()),
        T.StructField("old_schema", T.StringType()),
        T.StructField("new_schema", T.StringType()),
        T.StructField("resolved", T.BooleanType()),
        T.StructField("resolved_at", T.TimestampNTZType()),
        T.StructField("notes", T.StringType()),
    ]
)


#: Rows of the log: those of :func:`drift_events` with their time.
DRIFT_LOG_SCHEMA = T.StructType([*DRIFT_SCHEMA.fields, T.StructField("detected_at", T.TimestampNTZType())])


def drift_events(
    spark: SparkSession,
    collection: str,
    old: T.StructType,
    new: T.StructType,
    detected_at: str | None = None,
    nested: bool = False,
    resolved_at: str | None = None,
) -> DataFrame:
    """Drift-log rows, one per changed column (schema metadata, a few rows).

    Both schemas are kept as JSON.  ``resolved`` starts false; a caller that
    reconciles the frames gives ``resolved_at``, and the row says how.
    """
    a, b = _flatten(old, nested), _flatten(new, nested)
    done = resolved_at is not None
    at = datetime.fromisoformat(resolved_at) if done else None
    rows = [
        (
            collection, c.change_type, c.column_name, c.old_type, c.new_type, old.json(), new.json(), done, at,
            resolution(a.get(c.column_name), b.get(c.column_name)) if done else None,
        )
        for c in compare_schemas(old, new, nested)
    ]
    df = local_frame(spark, rows, DRIFT_SCHEMA)
    if detected_at is not None:
        df = df.withColumn("detected_at", ts_literal(detected_at))
    return df


RESCUED = "_rescued"
_INTEGRAL = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_INTEGRAL_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _as_decimal(t: T.DataType) -> T.DecimalType | None:
    if isinstance(t, T.DecimalType):
        return t
    return T.DecimalType(_INTEGRAL_DIGITS[t], 0) if t in _INTEGRAL else None


def widen(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """A common type that both can be cast to without loss, or None."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if a in _INTEGRAL and b in _INTEGRAL:
        return max(a, b, key=_INTEGRAL.index)
    if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
        exact = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType)
        return T.DoubleType() if isinstance(a, exact) and isinstance(b, exact) else None
    x, y = _as_decimal(a), _as_decimal(b)
    if x is not None and y is not None:
        scale = max(x.scale, y.scale)
        digits = max(x.precision - x.scale, y.precision - y.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    if {type(a), type(b)} <= {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if {type(a), type(b)} <= {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return None


def unify(a: T.DataType, b: T.DataType) -> T.DataType:
    """Type of a column that exists as ``a`` and arrives as ``b``.

    Structs keep their fields and gain new ones, at any depth; elements of
    arrays and values of maps are unified; other types are widened if that
    loses nothing.  Where no common type is safe, the existing one stays.
    """
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return unify_schemas(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(unify(a.elementType, b.elementType), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widen(a.keyType, b.keyType) or a.keyType, unify(a.valueType, b.valueType), True)
    return widen(a, b) or a


def unify_schemas(a: T.StructType, b: T.StructType) -> T.StructType:
    """Fields of ``a`` in order, then those only ``b`` has; all nullable."""
    have, got = ({f.name: f.dataType for f in s.fields} for s in (a, b))
    both = {n: unify(t, got[n]) if n in got else t for n, t in have.items()}
    both.update((n, t) for n, t in got.items() if n not in have)
    return T.StructType([T.StructField(n, t, True) for n, t in both.items()])


def _text(value: Column, t: T.DataType) -> Column:
    return F.to_json(value) if isinstance(t, (T.StructType, T.ArrayType, T.MapType)) else value.cast("string")


def _castable(a: T.DataType, b: T.DataType) -> bool:
    if isinstance(a, T.StringType):
        return isinstance(b, (T.NumericType, T.BooleanType, *_TEMPORAL))
    return isinstance(a, T.NumericType) and isinstance(b, T.NumericType) or isinstance(a, _TEMPORAL) and isinstance(b, _TEMPORAL)


#: Where a value sits, whether it does not fit, and its original as text.
Loss = tuple[str, Column, Column]


def _any_lost(losses: list[Loss]) -> Column:
    return reduce(lambda x, y: x | y, (lost for _, lost, _ in losses), F.lit(False))


def _convert(value: Column, a: T.DataType, b: T.DataType, path: str) -> tuple[Column, list[Loss]]:
    """``value`` of type ``a`` as ``b``, and what may not fit.

    A value fits if casting it back gives it again (for text: if it can be
    read, and as a decimal without rounding); one that does not becomes NULL.
    Inside an array or a map a single misfit is reported as the whole of it.
    """
    if a == b:
        return value, []
    if isinstance(a, T.NullType):
        return F.lit(None).cast(b), []
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        have = {f.name: f.dataType for f in a.fields}
        fields, losses = [], []
        for f in b.fields:
            if f.name in have:
                field, more = _convert(value.getField(f.name), have[f.name], f.dataType, f"{path}.{f.name}")
                losses += more
            else:
                field = F.lit(None).cast(f.dataType)
            fields.append(field.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields)), losses
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):

        def element(e: Column) -> tuple[Column, list[Loss]]:
            return _convert(e, a.elementType, b.elementType, path)

        out = F.transform(value, lambda e: element(e)[0])
        if not element(F.lit(None).cast(a.elementType))[1]:
            return out, []
        return out, [(path, F.exists(value, lambda e: _any_lost(element(e)[1])), F.to_json(value))]
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and widen(a.keyType, b.keyType) == b.keyType:

        def entry(k: Column, v: Column) -> tuple[Column, Column, list[Loss]]:
            key, _ = _convert(k, a.keyType, b.keyType, path)
            item, losses = _convert(v, a.valueType, b.valueType, path)
            return key, item, losses

        pairs = F.map_entries(value)
        out = F.map_from_entries(F.transform(pairs, lambda e: F.struct(*entry(e["key"], e["value"])[:2])))
        if not entry(F.lit(None).cast(a.keyType), F.lit(None).cast(a.valueType))[2]:
            return out, []
        return out, [(path, F.exists(pairs, lambda e: _any_lost(entry(e["key"], e["value"])[2])), F.to_json(value))]
    if isinstance(b, T.StringType):
        return _text(value, a), []
    if not _castable(a, b):
        return F.lit(None).cast(b), [(path, value.isNotNull(), _text(value, a))]
    out = value.try_cast(b)
    if widen(a, b) == b:
        return out, []
    if isinstance(a, T.StringType):
        lost = out.isNull()
        if isinstance(b, T.DecimalType):
            exact = T.DecimalType(38, 38 - (b.precision - b.scale))  # all digits that may stand before the point
            lost = lost | ~value.try_cast(exact).eqNullSafe(out.try_cast(exact))
    else:
        lost = ~out.try_cast(a).eqNullSafe(value)
    lost = value.isNotNull() & lost
    return F.when(~lost, out), [(path, lost, _text(value, a))]


def reconcile(existing: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Align both frames to one schema so they can be unioned by position.

    Missing columns and fields become typed NULLs.  If a column's types have
    no safe common one, the existing type stays and both frames get the map
    ``_rescued``: per row, the path of every value that does not fit and its
    original as text.  Nothing is rounded, cut or lost in silence.
    """
    ex = {f.name: f.dataType for f in existing.schema.fields if f.name != RESCUED}
    inc = {f.name: f.dataType for f in incoming.schema.fields if f.name != RESCUED}
    target = {n: unify(t, inc[n]) if n in inc else t for n, t in ex.items()}
    target.update((n, t) for n, t in inc.items() if n not in ex)

    def project(df: DataFrame, have: dict[str, T.DataType]) -> tuple[list[Column], list[Loss]]:
        columns, losses = [], []
        own = {n: F.col(f"_in{i}") for i, n in enumerate(df.columns)}
        for n, t in target.items():
            if n not in have:
                columns.append(F.lit(None).cast(t).alias(n))
                continue
            value, more = _convert(own[n], have[n], t, n)
            columns.append(value.alias(n))
            losses += more
        return columns, losses

    sides = [(df, *project(df, have)) for df, have in ((existing, ex), (incoming, inc))]

    def source(df: DataFrame) -> DataFrame:
        # names of their own, so no output column can be taken for an input
        return df.toDF(*(f"_in{i}" for i in range(len(df.columns))))

    if not any(losses or RESCUED in df.columns for df, _, losses in sides):
        return tuple(source(df).select(*columns) for df, columns, _ in sides)

    def rescued(df: DataFrame, losses: list[Loss]) -> Column:
        none = F.lit(None).cast("map<string,string>")
        kept = F.col(f"_in{df.columns.index(RESCUED)}") if RESCUED in df.columns else none
        if not losses:
            return kept.alias(RESCUED)
        found = F.array_compact(
            F.array(*(F.when(F.coalesce(lost, F.lit(False)), F.struct(F.lit(path).alias("key"), text.alias("value"))) for path, lost, text in losses))
        )
        before = F.coalesce(F.map_entries(kept), F.array().cast("array<struct<key:string,value:string>>"))
        earlier = F.filter(before, lambda e: ~F.array_contains(F.transform(found, lambda x: x["key"]), e["key"]))
        return F.when(F.size(found) > 0, F.map_from_entries(F.concat(found, earlier))).otherwise(kept).alias(RESCUED)

    return tuple(source(df).select(*columns, rescued(df, losses)) for df, columns, losses in sides)


def resolution(old: T.DataType | None, new: T.DataType | None) -> str:
    """How :func:`reconcile` deals with a column of these types."""
    if old is None:
        return "added; earlier rows NULL"
    if new is None:
        return "kept; new rows NULL"
    both = unify(old, new)
    kept = "type kept" if both == old else f"widened to {both.simpleString()}"
    _, losses = _convert(F.lit(None).cast(new), new, both, "")
    return f"{kept}; values that do not fit in {RESCUED}" if losses else kept


def affected_rows(events: DataFrame, old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """Drift rows with the rows they concern: those that carry a value in the
    changed column, in the new data, or for a dropped column in the old."""

    def filled(df: DataFrame) -> DataFrame:
        counts = [F.struct(F.lit(c).alias("_c"), F.count(c).alias("_n")) for c in columns if c in df.columns]
        return df.agg(F.array(*counts).alias("_all")).select(F.inline("_all"))

    before = filled(old).select(F.col("_c").alias("_oc"), F.col("_n").alias("_on"))
    after = filled(new)
    gone = F.col("change_type") == DROP
    return (
        events.join(after, F.col("column_name") == F.col("_c"), "left")
        .join(before, F.col("column_name") == F.col("_oc"), "left")
        .select(*events.columns, F.coalesce(F.when(gone, F.col("_on")).otherwise(F.col("_n")), F.lit(0)).alias("rows_affected"))
    )
