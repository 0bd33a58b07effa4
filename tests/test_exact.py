"""Exact sums of doubles against math.fsum and big integers."""

import math
import random
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.exact import exact_sums

TINY, HUGE = 5e-324, 1.7976931348623157e308


def exactly(values):
    """The exact sum, rounded once."""
    present = [v for v in values if v is not None]
    if not present:
        return None
    if any(math.isnan(v) for v in present) or {math.inf, -math.inf} <= set(present):
        return math.nan
    if (inf := [v for v in present if math.isinf(v)]):
        return inf[0]
    total = sum(map(Fraction, present))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def sums(spark, groups, slices=3):
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    random.Random(len(rows)).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(slices)
    out = exact_sums(df, ["g"], {"total": "v"}, {"n": (F.count(F.lit(1)), F.sum("n"))}).collect()
    assert {r.g: r.n for r in out} == {g: len(vs) for g, vs in groups.items()}
    return {r.g: r.total for r in out}


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def test_cases(spark):
    rng = random.Random(5)
    groups = {
        "money": [round(rng.uniform(0, 1e5), 2) for _ in range(500)],
        "cancels": [1e33, 1.0, -1e33],
        "tiny beside huge": [HUGE, TINY, -HUGE],
        "subnormal": [TINY * k for k in range(1, 50)],
        "below normal": [2.2250738585072014e-308, -TINY],
        "ties to even": [1.0, 2.0**-53],
        "just above a tie": [1.0, 2.0**-53, 2.0**-200],
        "just below a tie": [1.0, 2.0**-53, -(2.0**-200)],
        "small ones": [4e-7] * 1000,
        "large": [1e33] + [9e31] * 20,
        "overflows": [HUGE, HUGE],
        "overflows below": [-HUGE, -HUGE / 2, -HUGE / 2],
        "nearly overflows": [HUGE, HUGE, -HUGE],
        "negative": [-0.1] * 10,
        "zeros": [0.0, -0.0],
        "nulls": [None, None],
        "null and one": [None, 0.1],
        "nan": [1.0, math.nan],
        "inf": [1.0, math.inf],
        "minus inf": [-math.inf, 1e300],
        "both": [math.inf, -math.inf],
        "wide": [(-1) ** k * 2.0 ** (k * 31 - 1000) for k in range(64)],
        "powers of two": [2.0**k for k in range(-40, 40)] + [-(2.0**k) for k in range(-39, 41)],
    }
    got = sums(spark, groups)
    for g, values in groups.items():
        assert same(got[g], exactly(values)), (g, got[g], exactly(values))


def test_powers_are_exact(spark):
    from strata.functions.exact import BINS, _power

    got = spark.range(-BINS, BINS).selectExpr("id", f"{_power('id')} AS p").collect()
    assert all(r.p == (2.0 ** (16 * r.id) if 16 * r.id < 1024 else math.inf) for r in got)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=12), min_size=20, max_size=60))
def test_any_finite_values(spark, lists):
    groups = {str(i): vs for i, vs in enumerate(lists)}
    got = sums(spark, groups)
    for g, values in groups.items():
        assert same(got[g], exactly(values)), (values, got[g], exactly(values))


def test_several_sums_expressions_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1, 0.1, 1e20), (None, 1, 0.2, 1.0), ("a", 2, None, -1e20)], "g string, h int, x double, y double")
    out = exact_sums(df, ["g", "h"], {"x": F.col("x") * 2, "y": "y"}).collect()
    assert sorted(map(tuple, out), key=repr) == sorted([(None, 1, exactly([0.2, 0.4]), exactly([1e20, 1.0])), ("a", 2, None, -1e20)], key=repr)


def test_an_empty_frame_has_no_groups(spark):
    assert exact_sums(spark.createDataFrame([], "g string, v double"), ["g"], {"v": "v"}).count() == 0


def test_partial_sums_run_before_the_exchange(spark):
    df = spark.range(100).selectExpr("id % 3 AS g", "CAST(id AS DOUBLE) AS v")
    plan = exact_sums(df, ["g"], {"v": "v"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") >= 1 and "PythonUDF" not in plan


@pytest.mark.parametrize("slices", [1, 7])
def test_order_and_partitions_do_not_matter(spark, slices):
    rng = random.Random(1)
    groups = {"g": [rng.uniform(-1, 1) * 10.0 ** rng.randint(-30, 30) for _ in range(400)]}
    assert sums(spark, groups, slices)["g"] == exactly(groups["g"])
