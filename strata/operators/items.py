"""Order line items: explosion and per-order item features.

Items arrive in one of four shapes and all give the same rows:

* a native ``array<struct<product_id, qty, unit_price, ...>>`` column,
* a JSON string holding such an array (parsed with ``from_json``),
* a variant holding such an array,
* a separate, already flattened line table keyed by the order id.

Explosion is *outer*: an order with NULL, empty or unparsable items yields one
row with NULL item fields, so it still counts as an order downstream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType, VariantType

ITEM_SCHEMA = "array<struct<product_id:string,qty:int,unit_price:double,discount:double>>"
ITEM_FIELDS = ("product_id", "qty", "unit_price")


def _items_array(df: DataFrame, items_col: str):
    dtype = df.schema[items_col].dataType
    if isinstance(dtype, ArrayType):
        return F.col(items_col)
    if isinstance(dtype, StringType):
        return F.from_json(F.col(items_col), ITEM_SCHEMA)
    if isinstance(dtype, VariantType):
        return F.try_variant_get(F.col(items_col), "$", ITEM_SCHEMA)
    raise TypeError(f"items column {items_col!r} must be an array, a JSON string or a variant, got {dtype.simpleString()}")


def explode_items(
    orders: DataFrame,
    items_col: str = "items",
    keep: Sequence[str] = ("order_id",),
    fields: Sequence[str] = ITEM_FIELDS,
) -> DataFrame:
    """One row per item (``inline_outer``), carrying the ``keep`` columns."""
    arr = _items_array(orders, items_col)
    exploded = orders.select(*keep, F.explode_outer(arr).alias("_item"))
    return exploded.select(*keep, *[F.col(f"_item.{f}").alias(f) for f in fields])


def join_lines(
    orders: DataFrame,
    lines: DataFrame,
    key: str = "order_id",
    keep: Sequence[str] = ("order_id",),
    fields: Sequence[str] = ITEM_FIELDS,
) -> DataFrame:
    """Flattened-line form: every order with its lines; an order without
    lines gives one row with NULL item fields (same rows as ``explode_outer``).

    Written as an inner join plus the orders that have no line at all, rather
    than one left outer join: for an inner join AQE may split a skewed key on
    either side, so an order holding millions of lines is spread over many
    tasks; the line-less orders come from an anti join against the *distinct*
    order ids of the lines, which partial aggregation reduces map-side.
    """
    heads = orders.select(*keep)
    with_lines = heads.join(lines.select(key, *fields), key, "inner").select(*keep, *fields)
    line_orders = lines.select(key).distinct()
    types = {f.name: f.dataType for f in lines.schema.fields}
    without = heads.join(line_orders, key, "left_anti").select(
        *keep, *[F.lit(None).cast(types[f]).alias(f) for f in fields]
    )
    return with_lines.unionByName(without)


def lines_of(orders: DataFrame, lines: DataFrame, key: str = "order_id") -> DataFrame:
    """Lines whose order exists.  For measures per product this is all that is
    needed of the explosion: its rows without a line carry no product."""
    return lines.join(orders.select(key), key, "left_semi")


#: Names under which an order carries its address, the first one given wins.
ADDRESS_COLUMNS = ("shipping_address", "shipping_addr")
SHIPPING = {"shipping_city": "city", "shipping_country": "country"}


def _counted(arr: Column) -> list[Column]:
    quantity = F.aggregate(arr, F.lit(0).cast("long"), lambda acc, x: acc + F.coalesce(x["qty"], F.lit(0)).cast("long"))
    return [
        F.when(arr.isNull(), F.lit(0)).otherwise(F.size(arr)).cast("int").alias("items_count"),
        F.coalesce(quantity, F.lit(0).cast("long")).cast("int").alias("total_items_qty"),
    ]


def _address_field(df: DataFrame, field: str) -> Column | None:
    """A field of the order's address, from structs and JSON text (NULL where
    the text or the field is missing); None without an address column."""
    found = []
    for name in (c for c in ADDRESS_COLUMNS if c in df.columns):
        dtype = df.schema[name].dataType
        if isinstance(dtype, StructType):
            if field in dtype.names:
                found.append(F.col(name).getField(field).cast("string"))
        elif isinstance(dtype, StringType):
            found.append(F.try_variant_get(F.try_parse_json(F.col(name)), f"$.{field}", "string"))
        elif isinstance(dtype, VariantType):
            found.append(F.try_variant_get(F.col(name), f"$.{field}", "string"))
        else:
            raise TypeError(f"address column {name!r} must be a struct, JSON or a variant, got {dtype.simpleString()}")
    return F.coalesce(*found) if found else None


def item_features(orders: DataFrame, items_col: str = "items", keep_items: bool = False) -> DataFrame:
    """``items_count``, ``total_items_qty`` and, for orders with an address
    column, ``shipping_city`` and ``shipping_country``, row by row."""
    cols = [c for c in orders.columns if keep_items or c != items_col]
    shipping = {name: _address_field(orders, field) for name, field in SHIPPING.items()}
    extra = [c.alias(n) for n, c in shipping.items() if c is not None and n not in cols]
    return orders.select(*cols, *_counted(_items_array(orders, items_col)), *extra)


def document_features(orders: DataFrame, document: str = "raw_document", keep_items: bool = False) -> DataFrame:
    """The same features from a raw JSON document that is parsed once.

    Items and address may be JSON values of the document or text that holds
    JSON.  A document that cannot be read has no items and no address.
    """
    parsed = orders.withColumn("_doc", F.try_parse_json(F.col(document)))

    def part(*names: str) -> Column:
        here = F.coalesce(*(F.try_variant_get("_doc", f"$.{n}", "variant") for n in names))
        return F.when(F.schema_of_variant(here) == "STRING", F.try_parse_json(F.try_variant_get(here, "$", "string"))).otherwise(here)

    read = parsed.withColumns({"_items": part("items"), "_address": part(*ADDRESS_COLUMNS)})
    items = F.try_variant_get("_items", "$", ITEM_SCHEMA)
    shipping = [F.try_variant_get("_address", f"$.{field}", "string").alias(n) for n, field in SHIPPING.items()]
    kept = [items.alias("items")] if keep_items else []
    return read.select(*orders.columns, *kept, *_counted(items), *shipping)


def item_features_from_lines(orders: DataFrame, lines: DataFrame, key: str = "order_id") -> DataFrame:
    """The same features from a flattened line table: aggregate lines per order
    (partial aggregation first), then one left join."""
    per_order = lines.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.coalesce(F.col("qty"), F.lit(0)).cast("long")).alias("_q"),
    )
    return orders.join(per_order, key, "left").select(
        *orders.columns,
        F.coalesce("_n", F.lit(0)).cast("int").alias("items_count"),
        F.coalesce("_q", F.lit(0)).cast("int").alias("total_items_qty"),
    )
