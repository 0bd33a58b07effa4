from datetime import datetime

import pytest

from strata.functions.fingerprint import add_fingerprint

SCHEMA = "sku string, label string, stock int, checked timestamp_ntz"
BOLT = ("B-17", "hex bolt", 40, datetime(2021, 5, 6, 7))


def _hash(spark, rows, schema=SCHEMA, **kw):
    return [r.record_hash for r in add_fingerprint(spark.createDataFrame(rows, schema), **kw).collect()]


@pytest.mark.parametrize("mode", ["compat", "safe", "json"])
def test_every_column_counts_and_nothing_else(spark, mode):
    changed = [(*BOLT[:k], other, *BOLT[k + 1 :]) for k, other in enumerate(("B-18", "Hex bolt", 41, datetime(2021, 5, 6, 8)))]
    first, again, *rest = _hash(spark, [BOLT, BOLT, *changed], mode=mode)
    assert first == again and len({first, *rest}) == 5


def test_column_order_and_bookkeeping_do_not_count(spark):
    df = spark.createDataFrame([BOLT], SCHEMA)
    versions = [
        df,
        df.select(*reversed(df.columns)),
        df.selectExpr("*", "3 AS version_number", "false AS is_current", "'2022-01-01' AS load_date"),
    ]
    assert len({add_fingerprint(v).first().record_hash for v in versions}) == 1


def test_nested_values_in_safe_mode(spark):
    def different(schema, *values):
        hashes = _hash(spark, [(v,) for v in values], schema, mode="safe")
        assert len(set(hashes)) == len(values)

    different("t array<string>", ["a, b"], ["a", "b"], ["a", None], ["a"], [], None)
    different("t struct<x:string,y:string>", ("a", None), (None, "a"), ("a", ""), None)
    different("t map<string,int>", {"a": 1}, {"a": None}, {"b": 1}, {}, None)
    one = spark.sql("SELECT map('a', 1, 'b', 2) AS t UNION ALL SELECT map('b', 2, 'a', 1)")
    assert add_fingerprint(one, mode="safe").select("record_hash").distinct().count() == 1


def test_compat_matches_pipe_md5(spark):
    import hashlib

    [h] = _hash(spark, [("b", "a")], "y string, x string")
    assert h == hashlib.md5(b"a|b").hexdigest()


def test_compat_collisions_and_safe_mode(spark):
    schema = "a string, b string"
    delim = [("a|b", "c"), ("a", "b|c")]
    nulls = [(None, "q"), ("", "q")]
    for rows in (delim, nulls):
        c1, c2 = _hash(spark, rows, schema)
        assert c1 == c2  # the compatible encoding collides
        s1, s2 = _hash(spark, rows, schema, mode="safe")
        assert s1 != s2
        j1, j2 = _hash(spark, rows, schema, mode="json")
        assert j1 != j2


def test_excluded_columns_are_a_parameter(spark):
    later = (*BOLT[:3], datetime(2030, 1, 1))
    a, b = _hash(spark, [BOLT, later], exclude=("checked",))
    assert a == b
