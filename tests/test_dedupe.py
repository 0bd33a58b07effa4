from datetime import datetime

from strata.operators.dedupe import any_per_key, latest_per_key

SCHEMA = "customer_id string, email string, status string, updated_at timestamp_ntz"


def test_newest_reading_per_sensor(spark):
    df = spark.range(60).selectExpr("id % 4 AS sensor", "(id * 37) % 60 AS at", "id AS reading")
    newest = {}
    for k in range(60):
        newest[k % 4] = max(newest.get(k % 4, (-1, 0)), ((k * 37) % 60, k))
    got = {r.sensor: (r.at, r.reading) for r in latest_per_key(df.repartition(5), ["sensor"], ["at"]).collect()}
    assert got == newest


def test_columns_without_an_order(spark):
    df = spark.sql(
        "SELECT 1 AS k, 5 AS at, map('a', 1) AS tags UNION ALL SELECT 1, 7, map('b', 2) UNION ALL SELECT 1, 7, map('c', 3)"
    )
    picks = {repr(latest_per_key(df.repartition(n), ["k"], ["at"]).collect()) for n in (1, 2, 3)}
    assert len(picks) == 1 and "at=7" in picks.pop()
    assert any_per_key(df, ["k"]).count() == 1


def test_ties_are_deterministic(spark):
    rows = [("C1", "b@x", "s", datetime(2024, 1, 1)), ("C1", "a@x", "s", datetime(2024, 1, 1))]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, SCHEMA).repartition(2)
        assert latest_per_key(df, ["customer_id"], ["updated_at"]).collect()[0].email == "b@x"


def test_tiebreak_column(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 2)], "k int, wm int, seq int")
    assert latest_per_key(df, ["k"], ["wm"], ["seq"]).collect()[0].seq == 2


def test_null_watermark_loses(spark):
    df = spark.createDataFrame([("C1", "new", None), ("C1", "old", datetime(2020, 1, 1))], "k string, v string, wm timestamp_ntz")
    assert latest_per_key(df, ["k"], ["wm"]).collect()[0].v == "old"


def test_hot_key_is_reduced_map_side(spark):
    # one key holding most rows: the aggregate runs partial before the exchange
    df = spark.range(0, 20000).selectExpr("IF(id % 10 < 7, 0, id) AS k", "id AS wm")
    out = latest_per_key(df, ["k"], ["wm"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert out.where("k = 0").collect()[0].wm == 19996
    assert out.count() == 6001


def test_any_per_key(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")
    assert sorted((r.k, r.v) for r in any_per_key(df, ["k"]).collect()) == [(1, "a"), (2, "c")]
