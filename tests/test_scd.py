"""SCD Type 1 / Type 2 merges, including the properties of a version history."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.functions.fingerprint import add_fingerprint
from strata.operators import scd
from strata.rules import OPEN_END

SCHEMA = "id string, name string, city string"
T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def batch(spark, rows):
    return add_fingerprint(spark.createDataFrame(rows, SCHEMA))


def history_after(spark, batches):
    """Fold batches through scd2_initial / scd2_merge; returns the full history."""
    times = [T1, T2, T3, "2024-04-01 00:00:00"]
    full = scd.scd2_initial(batch(spark, batches[0]), times[0][:10], times[0])
    for i, rows in enumerate(batches[1:], start=1):
        current = full.where("is_current")
        history = full.where("NOT is_current")
        merged = scd.scd2_merge(current, batch(spark, rows), "id", times[i][:10], times[i])
        full = history.unionByName(merged)
    return full


# --------------------------------------------------------------------------
# Type 1
# --------------------------------------------------------------------------

def test_scd1_first_load_is_the_batch(spark):
    out = scd.scd1_merge(None, spark.createDataFrame([("1", "a", "x")], SCHEMA), "id", "2024-01-01", T1)
    r = out.collect()[0]
    assert r.load_date == "2024-01-01" and r.pipeline_load_ts == datetime(2024, 1, 1)


def test_scd1_replaces_and_keeps_untouched(spark):
    first = scd.scd1_merge(None, spark.createDataFrame([("1", "a", "x"), ("2", "b", "y")], SCHEMA), "id", "d1", T1)
    second = scd.scd1_merge(first, spark.createDataFrame([("2", "B", "y"), ("3", "c", "z")], SCHEMA), "id", "d2", T2)
    got = {r.id: (r.name, r.load_date) for r in second.collect()}
    assert got == {"1": ("a", "d1"), "2": ("B", "d2"), "3": ("c", "d2")}


def test_null_key_rejected_before_merge(spark):
    out = scd.scd1_merge(None, spark.createDataFrame([(None, "a", "x"), ("1", "b", "y")], SCHEMA), "id", "d", T1)
    assert out.count() == 1
    full = history_after(spark, [[("1", "a", "x")], [(None, "z", "z")], [(None, "z", "z")]])
    assert full.count() == 1


# --------------------------------------------------------------------------
# Type 2
# --------------------------------------------------------------------------

def test_scd2_initial_versions(spark):
    out = scd.scd2_initial(batch(spark, [("1", "a", "x")]), "2024-01-01", T1).collect()[0]
    assert out.version_number == 1 and out.is_current is True
    assert out.expiry_date == datetime.strptime(OPEN_END, "%Y-%m-%d %H:%M:%S")


def test_scd2_change_new_unchanged_absent(spark):
    full = history_after(
        spark,
        [
            [("1", "a", "x"), ("2", "b", "y"), ("3", "c", "z")],
            [("1", "a", "x"), ("2", "B", "y"), ("4", "d", "w")],  # 1 same, 2 changed, 3 absent, 4 new
        ],
    )
    rows = {(r.id, r.version_number): r for r in full.collect()}
    assert set(rows) == {("1", 1), ("2", 1), ("2", 2), ("3", 1), ("4", 1)}
    assert rows[("2", 1)].is_current is False and rows[("2", 1)].expiry_date == datetime(2024, 2, 1)
    assert rows[("2", 1)].load_date == "2024-01-01"  # closed row keeps its load date
    assert rows[("2", 2)].effective_date == datetime(2024, 2, 1) and rows[("2", 2)].is_current
    assert rows[("3", 1)].is_current  # no delete detection
    assert rows[("1", 1)].effective_date == datetime(2024, 1, 1)


def _check_history(full):
    rows = sorted(full.collect(), key=lambda r: (r.id, r.version_number))
    by_key = {}
    for r in rows:
        by_key.setdefault(r.id, []).append(r)
    for versions in by_key.values():
        assert [v.version_number for v in versions] == list(range(1, len(versions) + 1))
        assert sum(v.is_current for v in versions) == 1
        assert versions[-1].is_current
        for a, b in zip(versions, versions[1:]):
            assert a.expiry_date == b.effective_date  # gapless, non-overlapping
            assert a.effective_date < a.expiry_date


def test_scd2_properties_over_three_batches(spark):
    full = history_after(
        spark,
        [
            [("1", "a", "x"), ("2", "b", "y")],
            [("1", "a2", "x"), ("3", "c", "z")],
            [("1", "a3", "x"), ("2", "b2", "y"), ("3", "c", "z")],
        ],
    )
    _check_history(full)
    assert full.where("id = '1'").count() == 3


def test_scd2_replay_is_noop(spark):
    b = [("1", "a", "x"), ("2", "b", "y")]
    once = history_after(spark, [b])
    twice = history_after(spark, [b, b])
    cols = ["id", "name", "version_number", "is_current", "effective_date", "expiry_date"]
    assert sorted(once.select(cols).collect()) == sorted(twice.select(cols).collect())


def test_scd2_fold_equals_window_over_change_log(spark):
    batches = [
        [("1", "a", "x"), ("2", "b", "y")],
        [("1", "a2", "x"), ("2", "b", "y")],
        [("1", "a3", "x"), ("2", "b2", "y")],
    ]
    full = history_after(spark, batches)
    # independent derivation: distinct consecutive states per key numbered by time
    from pyspark.sql import Window

    log = None
    for i, rows in enumerate(batches):
        df = batch(spark, rows).withColumn("t", F.lit(i))
        log = df if log is None else log.unionByName(df)
    w = Window.partitionBy("id").orderBy("t")
    changes = log.withColumn("prev", F.lag("record_hash").over(w)).where(
        F.col("prev").isNull() | (F.col("prev") != F.col("record_hash"))
    )
    expected = sorted((r.id, r.name) for r in changes.collect())
    assert sorted((r.id, r.name) for r in full.collect()) == expected
    _check_history(full)


def test_change_detection_classes(spark):
    current = scd.scd2_initial(batch(spark, [("1", "a", "x"), ("2", "b", "y")]), "d", T1)
    out = scd.change_detection(current, batch(spark, [("1", "a", "x"), ("2", "B", "y"), ("3", "c", "z")]), "id")
    assert {r.id: r.change_type for r in out.collect()} == {"1": "unchanged", "2": "changed", "3": "new"}


def test_as_of_view(spark):
    full = history_after(spark, [[("1", "a", "x")], [("1", "b", "x")]])
    assert [r.name for r in scd.as_of_view(full, "2024-01-15 00:00:00").collect()] == ["a"]
    assert [r.name for r in scd.as_of_view(full, T2).collect()] == ["b"]  # half-open interval
    assert scd.as_of_view(full, "2023-12-31 00:00:00").count() == 0


def test_merge_handles_new_column(spark):
    current = scd.scd2_initial(batch(spark, [("1", "a", "x")]), "d", T1)
    inc = add_fingerprint(spark.createDataFrame([("1", "a", "x", "vip")], SCHEMA + ", tier string"))
    out = scd.scd2_merge(current, inc, "id", "d2", T2)
    assert "tier" in out.columns and out.count() == 2


def test_merge_is_one_join(spark):
    current = scd.scd2_initial(batch(spark, [("1", "a", "x")]), "d", T1)
    out = scd.scd2_merge(current, batch(spark, [("1", "b", "x")]), "id", "d2", T2)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


@pytest.mark.parametrize("n", [1, 3])
def test_version_numbers_increase(spark, n):
    batches = [[("1", f"v{i}", "x")] for i in range(n + 1)]
    full = history_after(spark, batches)
    assert sorted(r.version_number for r in full.collect()) == list(range(1, n + 2))


def test_changes_that_are_not_later_go_to_the_side(spark):
    cur = scd.scd2_initial(batch(spark, [("1", "a", "x"), ("2", "b", "y")]), "d", T2)
    inc = batch(spark, [("1", "late", "x"), ("2", "b", "y"), ("3", "new", "z")])
    for as_of in (T1, T2):
        out = scd.scd2_merge(cur, inc, "id", "d2", as_of)
        assert sorted((r.id, r.name, r.version_number, r.is_current) for r in out.collect()) == [
            ("1", "a", 1, True), ("2", "b", 1, True), ("3", "new", 1, True)
        ]
        assert [r.id for r in scd.late_rows(cur, inc, "id", as_of).collect()] == ["1"]
    assert scd.late_rows(cur, inc, "id", T3).count() == 0


def test_repeated_and_missing_keys(spark):
    twice = batch(spark, [("1", "a", "x"), ("1", "b", "x")])
    cur = scd.scd2_initial(batch(spark, [("9", "q", "q")]), "d", T1)
    for build in (lambda: scd.scd2_merge(cur, twice, "id", "d2", T2), lambda: scd.scd2_initial(twice, "d", T1, "id")):
        with pytest.raises(Exception, match="batch repeats id 1"):
            build().collect()
    some = batch(spark, [(None, "a", "x"), ("1", "b", "x")])
    assert [r.id for r in scd.scd2_initial(some, "d", T1, "id").collect()] == ["1"]
    assert sorted(r.id for r in scd.scd2_merge(cur, some, "id", "d2", T2).collect()) == ["1", "9"]
