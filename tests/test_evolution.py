from pyspark.sql import types as T

from strata.operators.evolution import ADD, DROP, RETYPE, affected_rows, compare_schemas, drift_events, reconcile, widen


def test_compare_schemas(spark):
    old = T.StructType.fromDDL("a int, b string, c double, s struct<x:int>")
    new = T.StructType.fromDDL("a bigint, c double, d string, s struct<x:int,y:int>")
    changes = {(c.change_type, c.column_name) for c in compare_schemas(old, new)}
    assert changes == {(ADD, "d"), (DROP, "b"), (RETYPE, "a"), (RETYPE, "s")}
    nested = {(c.change_type, c.column_name) for c in compare_schemas(old, new, nested=True)}
    assert (ADD, "s.y") in nested and (RETYPE, "s") not in nested


def test_reorder_is_not_drift(spark):
    assert compare_schemas(T.StructType.fromDDL("a int, b int"), T.StructType.fromDDL("b int, a int")) == []


def test_widen():
    assert widen(T.IntegerType(), T.LongType()) == T.LongType()
    assert widen(T.IntegerType(), T.DoubleType()) == T.DoubleType()
    assert widen(T.StringType(), T.LongType()) is None


def test_reconcile_pads_and_aligns(spark):
    ex = spark.createDataFrame([(1, "a")], "id int, name string")
    inc = spark.createDataFrame([(2, 7)], "id bigint, score int")
    a, b = reconcile(ex, inc)
    assert a.columns == b.columns == ["id", "name", "score"]
    assert a.schema == b.schema
    assert dict(a.dtypes)["id"] == "bigint"
    rows = sorted(tuple(r) for r in a.unionByName(b).collect())
    assert rows == [(1, "a", None), (2, None, 7)]


def test_reconcile_incompatible_type_casts_to_existing(spark):
    ex = spark.createDataFrame([("1",)], "id string")
    inc = spark.createDataFrame([(2,)], "id bigint")
    _, b = reconcile(ex, inc)
    assert b.collect()[0].id == "2"


def test_drift_events_and_first_load(spark):
    old = T.StructType.fromDDL("a int")
    new = T.StructType.fromDDL("a int, b string")
    ev = drift_events(spark, "orders", old, new, "2024-01-01 00:00:00").collect()
    assert [(e.change_type, e.column_name, e.new_type) for e in ev] == [(ADD, "b", "string")]
    assert not ev[0].resolved and "integer" in ev[0].old_schema and "string" in ev[0].new_schema


def test_affected_rows(spark):
    old = spark.createDataFrame([(1, "x"), (2, None)], "a int, gone string")
    new = spark.createDataFrame([(1, "p"), (2, "q"), (None, None)], "a bigint, b string")
    events = drift_events(spark, "t", old.schema, new.schema)
    got = {r.column_name: r.rows_affected for r in affected_rows(events, old, new, ["a", "b", "gone"]).collect()}
    assert got == {"a": 2, "b": 2, "gone": 1}


# --------------------------------------------------------------------------
# nested shapes and values that do not fit
# --------------------------------------------------------------------------

def test_widen_loses_nothing():
    dec = T.DecimalType
    assert widen(T.LongType(), T.DoubleType()) is None
    assert widen(T.FloatType(), T.LongType()) is None
    assert widen(T.FloatType(), T.IntegerType()) == T.DoubleType()
    assert widen(dec(10, 2), dec(20, 4)) == dec(20, 4)
    assert widen(dec(20, 0), dec(10, 8)) == dec(28, 8)
    assert widen(dec(38, 0), dec(10, 8)) is None
    assert widen(T.LongType(), dec(10, 2)) == dec(21, 2)
    assert widen(T.NullType(), T.DateType()) == T.DateType()


def both(spark, old_rows, old, new_rows, new):
    a, b = reconcile(spark.createDataFrame(old_rows, old), spark.createDataFrame(new_rows, new))
    assert a.schema.simpleString() == b.schema.simpleString()
    rows = a.unionByName(b).collect()
    return a.schema, [r.asDict(recursive=True) for r in rows]


def test_structs_gain_and_keep_fields_at_any_depth(spark):
    schema, rows = both(
        spark,
        [(1, ("Ulm", (7,)))], "id int, address struct<city:string,geo:struct<x:int>>",
        [(2, ("Bonn", "53111", ("k", 9)))], "id int, address struct<city:string,zip:string,geo:struct<name:string,x:bigint>>",
    )
    assert schema["address"].dataType.simpleString() == "struct<city:string,geo:struct<x:bigint,name:string>,zip:string>"
    assert rows == [
        {"id": 1, "address": {"city": "Ulm", "geo": {"x": 7, "name": None}, "zip": None}},
        {"id": 2, "address": {"city": "Bonn", "geo": {"x": 9, "name": "k"}, "zip": "53111"}},
    ]


def test_null_structs_stay_null(spark):
    _, rows = both(spark, [(1, None)], "id int, a struct<x:int>", [(2, None), (3, (None, None))], "id int, a struct<x:int,y:int>")
    assert [r["a"] for r in rows] == [None, None, {"x": None, "y": None}]


def test_values_that_do_not_fit_are_rescued(spark):
    _, rows = both(
        spark,
        [(1, 5, 2**60, 1.5)], "id int, points int, big bigint, ratio double",
        [(2, "many", 2.5, 2**53 + 1), (3, "12", 3.0, 8), (4, None, None, None)], "id int, points string, big double, ratio bigint",
    )
    assert [(r["points"], r["big"], r["ratio"]) for r in rows] == [(5, 2**60, 1.5), (None, None, None), (12, 3, 8.0), (None, None, None)]
    assert [r["_rescued"] for r in rows] == [
        None, {"points": "many", "big": "2.5", "ratio": "9007199254740993"}, None, None
    ]


def test_misfits_inside_arrays_maps_and_structs(spark):
    _, rows = both(
        spark,
        [([1], {"a": 1}, (1,), 1)], "l array<int>, m map<string,int>, s struct<x:int>, k int",
        [(["1", "x"], {"a": "2"}, ("q",), (9,)), (["3", None], {"a": "y"}, None, None)],
        "l array<string>, m map<string,string>, s struct<x:string>, k struct<z:int>",
    )
    assert [(r["l"], r["m"], r["s"], r["k"]) for r in rows] == [
        ([1], {"a": 1}, {"x": 1}, 1), ([1, None], {"a": 2}, {"x": None}, None), ([3, None], {"a": None}, None, None)
    ]
    assert [r["_rescued"] for r in rows] == [
        None, {"l": '["1","x"]', "s.x": "q", "k": '{"z":9}'}, {"m": '{"a":"y"}'}
    ]


def test_everything_fits_into_text(spark):
    _, rows = both(spark, [("a",)], "c string", [((1, [2]),)], "c struct<x:int,y:array<int>>")
    assert rows == [{"c": "a"}, {"c": '{"x":1,"y":[2]}'}]


def test_decimals_times_and_other_kinds(spark):
    from datetime import date, datetime
    from decimal import Decimal

    _, rows = both(
        spark,
        [(Decimal("1.25"), date(2024, 1, 1), True, Decimal(1))], "d decimal(10,2), t date, b boolean, s decimal(5,2)",
        [(Decimal("1.2345"), datetime(2024, 1, 2, 3), 7, "1.239"), (None, None, None, "2.5")], "d decimal(20,4), t timestamp_ntz, b int, s string",
    )
    assert [(r["d"], r["t"], r["b"], r["s"]) for r in rows] == [
        (Decimal("1.2500"), datetime(2024, 1, 1), True, Decimal("1.00")),
        (Decimal("1.2345"), datetime(2024, 1, 2, 3), None, None),
        (None, None, None, Decimal("2.50")),
    ]
    assert [r["_rescued"] for r in rows] == [None, {"b": "7", "s": "1.239"}, None]


def test_rescued_values_of_earlier_batches_stay(spark):
    ex = spark.createDataFrame([(1, {"n": "old"})], "n int, _rescued map<string,string>")
    inc = spark.createDataFrame([("2",), ("x",)], "n string")
    a, b = reconcile(ex, inc)
    assert [r.asDict() for r in a.unionByName(b).collect()] == [
        {"n": 1, "_rescued": {"n": "old"}}, {"n": 2, "_rescued": None}, {"n": None, "_rescued": {"n": "x"}}
    ]


def test_a_merge_keeps_a_batch_that_does_not_fit(spark):
    from strata.functions.fingerprint import add_fingerprint
    from strata.plans import jobs
    from strata.rules import CollectionSpec
    from strata.session import scratch_path
    from strata.sources.publish import read_scd2_full

    lake = jobs.Lake(scratch_path(spark, "misfit"))
    spec = CollectionSpec("c", "id", "updated_at", 2)
    one = spark.createDataFrame([("1", 10, ("Ulm",))], "id string, points int, address struct<city:string>")
    two = spark.createDataFrame([("1", "many", ("Ulm", "89073"))], "id string, points string, address struct<city:string,zip:string>")
    jobs.merge_batch(spark, lake, spec, add_fingerprint(one), "2024-01-01", "2024-01-01 06:00:00")
    jobs.merge_batch(spark, lake, spec, add_fingerprint(two), "2024-02-01", "2024-02-01 06:00:00")
    full = sorted(read_scd2_full(spark, lake.silver("c")).collect(), key=lambda r: r.version_number)
    assert [(r.points, r.address.zip, r._rescued) for r in full] == [(10, None, None), (None, "89073", {"points": "many"})]
    notes = {r.column_name: r.notes for r in spark.read.parquet(lake.drift).collect()}
    assert notes == {
        "points": "type kept; values that do not fit in _rescued",
        "address": "widened to struct<city:string,zip:string>",
    }
