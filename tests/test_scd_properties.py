"""Property-based checks of the SCD2 merge over random batch sequences."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.functions.fingerprint import add_fingerprint
from strata.operators import scd

SCHEMA = "id string, v string"
TIMES = [f"2024-0{i + 1}-01 00:00:00" for i in range(6)]

# a batch: distinct keys from a small pool, values from a tiny alphabet so that
# unchanged, changed, new and absent keys all occur
batch_st = st.dictionaries(st.sampled_from("abcdef"), st.sampled_from("xyz"), min_size=1, max_size=6)
batches_st = st.lists(batch_st, min_size=1, max_size=4)


def _fold(spark, batches):
    def frame(b):
        return add_fingerprint(spark.createDataFrame(sorted(b.items()), SCHEMA))

    full = scd.scd2_initial(frame(batches[0]), TIMES[0][:10], TIMES[0])
    for i, b in enumerate(batches[1:], start=1):
        merged = scd.scd2_merge(full.where("is_current"), frame(b), "id", TIMES[i][:10], TIMES[i])
        full = full.where("NOT is_current").unionByName(merged)
    return [r.asDict() for r in full.collect()]


def _expected_versions(batches):
    """Per key: the sequence of distinct consecutive values, with the batch
    index at which each became current."""
    out = {}
    for i, b in enumerate(batches):
        for k, v in b.items():
            hist = out.setdefault(k, [])
            if not hist or hist[-1][0] != v:
                hist.append((v, i))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=batches_st)
def test_scd2_history_properties(spark, batches):
    rows = _fold(spark, batches)
    expected = _expected_versions(batches)
    by_key = {}
    for r in rows:
        by_key.setdefault(r["id"], []).append(r)
    assert set(by_key) == set(expected)
    for k, versions in by_key.items():
        versions.sort(key=lambda r: r["version_number"])
        assert [r["version_number"] for r in versions] == list(range(1, len(versions) + 1))
        assert [r["v"] for r in versions] == [v for v, _ in expected[k]]
        assert [r["effective_date"].strftime("%Y-%m-%d %H:%M:%S") for r in versions] == [
            TIMES[i] for _, i in expected[k]
        ]
        assert sum(r["is_current"] for r in versions) == 1 and versions[-1]["is_current"]
        for a, b in zip(versions, versions[1:]):
            assert a["expiry_date"] == b["effective_date"]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=batches_st)
def test_replaying_last_batch_changes_nothing(spark, batches):
    once = _fold(spark, batches)
    twice = _fold(spark, batches + [batches[-1]])
    key = ("id", "v", "version_number", "is_current", "effective_date", "expiry_date")
    assert sorted(tuple(r[c] for c in key) for r in once) == sorted(tuple(r[c] for c in key) for r in twice)
