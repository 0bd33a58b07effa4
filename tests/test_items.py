import pytest
from pyspark.sql import functions as F

from strata.operators import items
from strata.operators.items import ITEM_SCHEMA, explode_items, item_features, item_features_from_lines, join_lines

VARIANTS = [
    ("o1", '[{"product_id":"p1","qty":2,"unit_price":5.0},{"product_id":"p2","qty":1,"unit_price":3.5}]'),
    ("o2", "[]"),
    ("o3", None),
    ("o4", "{not json"),
]


def test_json_items_explode_outer(spark):
    df = spark.createDataFrame(VARIANTS, "order_id string, items string")
    rows = sorted(explode_items(df).collect(), key=lambda r: (r.order_id, r.product_id or ""))
    assert [(r.order_id, r.product_id, r.qty) for r in rows] == [
        ("o1", "p1", 2),
        ("o1", "p2", 1),
        ("o2", None, None),
        ("o3", None, None),
        ("o4", None, None),
    ]


def test_native_array_same_rows(spark):
    js = spark.createDataFrame(VARIANTS, "order_id string, items string")
    native = js.select("order_id", F.from_json("items", ITEM_SCHEMA).alias("items"))
    a = sorted(map(tuple, explode_items(js).collect()), key=str)
    b = sorted(map(tuple, explode_items(native).collect()), key=str)
    assert a == b


def test_line_table_form_same_rows(spark):
    orders = spark.createDataFrame([("o1",), ("o2",)], "order_id string")
    lines = spark.createDataFrame([("o1", "p1", 2, 5.0), ("o1", "p2", 1, 3.5)], "order_id string, product_id string, qty int, unit_price double")
    rows = sorted(join_lines(orders, lines).collect(), key=str)
    assert [tuple(r) for r in rows] == [("o1", "p1", 2, 5.0), ("o1", "p2", 1, 3.5), ("o2", None, None, None)]


def test_item_features(spark):
    df = spark.createDataFrame(VARIANTS, "order_id string, items string")
    got = {r.order_id: (r.items_count, r.total_items_qty) for r in item_features(df).collect()}
    assert got == {"o1": (2, 3), "o2": (0, 0), "o3": (0, 0), "o4": (0, 0)}


def test_item_features_shipping(spark):
    df = spark.createDataFrame(
        [("o1", "[]", ("Main St", "Oslo", "NO", "0150"))],
        "order_id string, items string, shipping_address struct<street:string,city:string,country:string,zip:string>",
    )
    r = item_features(df).collect()[0]
    assert (r.shipping_city, r.shipping_country) == ("Oslo", "NO")


def test_features_from_lines_match_array_form(spark):
    js = spark.createDataFrame(VARIANTS[:3], "order_id string, items string")
    lines = explode_items(js).where("product_id IS NOT NULL")
    a = {r.order_id: (r.items_count, r.total_items_qty) for r in item_features(js).collect()}
    b = {r.order_id: (r.items_count, r.total_items_qty) for r in item_features_from_lines(js.select("order_id"), lines).collect()}
    assert a == b


ADDRESS = '{"city":"Ulm","country":"DE","lines":["a"]}'


@pytest.mark.parametrize(
    "value,kind",
    [(ADDRESS, "shipping_addr string"), (ADDRESS, "shipping_address string"), (("Ulm", "DE"), "shipping_address struct<city:string,country:string>")],
)
def test_addresses_as_text_or_struct(spark, value, kind):
    df = spark.createDataFrame([("1", "[]", value), ("2", None, None)], f"order_id string, items string, {kind}")
    out = {r.order_id: (r.shipping_city, r.shipping_country) for r in items.item_features(df).collect()}
    assert out == {"1": ("Ulm", "DE"), "2": (None, None)}


def test_addresses_that_cannot_be_read(spark):
    df = spark.createDataFrame([("1", "[]", "{broken"), ("2", "[]", "[1]"), ("3", "[]", '{"city":7}')], "order_id string, items string, shipping_addr string")
    assert [(r.shipping_city, r.shipping_country) for r in items.item_features(df).orderBy("order_id").collect()] == [(None, None), (None, None), ("7", None)]
    bare = spark.createDataFrame([("1", "[]")], "order_id string, items string")
    assert "shipping_city" not in items.item_features(bare).columns


def test_documents_are_read_in_either_form(spark):
    line = '{"product_id":"p","qty":2,"unit_price":1.5}'
    docs = [
        f'{{"items":[{line},{line}],"shipping_address":{ADDRESS}}}',
        '{"items":"[%s]","shipping_addr":"%s"}' % (line.replace('"', '\\"'), ADDRESS.replace('"', '\\"')),
        '{"items":[],"shipping_address":null}', '{"items":7}', "{broken", None, "[]", '{"items":"oops","shipping_addr":"Ulm"}',
    ]
    df = spark.createDataFrame([(str(i), d) for i, d in enumerate(docs)], "order_id string, raw_document string")
    rows = items.document_features(df, keep_items=True).orderBy("order_id").collect()
    assert [(r.items_count, r.total_items_qty, r.shipping_city, r.shipping_country) for r in rows] == [
        (2, 4, "Ulm", "DE"), (1, 2, "Ulm", "DE"), *[(0, 0, None, None)] * 6
    ]
    assert rows[0]["items"][0].unit_price == 1.5


def test_the_silver_job_fills_the_shipping_columns(spark):
    from strata.plans import jobs
    from strata.rules import COLLECTIONS
    from strata.sources.contracts import conform, contract

    raw = spark.createDataFrame(
        [("1", "c", "completed", "2024-01-01 00:00:00", "[]", ADDRESS)],
        "order_id string, customer_id string, status string, updated_at string, items string, shipping_addr string",
    )
    row = conform(jobs.prepare_batch(raw, COLLECTIONS["orders"]), contract("silver_orders")).first()
    assert (row.shipping_city, row.shipping_country) == ("Ulm", "DE")


def test_variant_items_explode_like_json(spark):
    df = spark.createDataFrame(VARIANTS, "order_id string, items string")
    as_variant = df.withColumn("items", F.try_parse_json("items"))
    want = sorted(map(repr, explode_items(df).collect()))
    assert sorted(map(repr, explode_items(as_variant).collect())) == want
    assert sorted(map(repr, item_features(as_variant).collect())) == sorted(map(repr, item_features(df).collect()))
