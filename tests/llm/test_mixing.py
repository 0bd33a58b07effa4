from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.llm import mixing
from tests.llm.data import AWKWARD, documents, prose


def fill(sizes, weights=(3, 1, 2), budget=1.5, cap=2):
    """Capped water-filling by its definition: clamp, share again, repeat."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, free, target = budget * sum(sizes.values()), set(names), {}
    while free:
        share = {s: w[s] * left / sum(w[f] for f in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 10, "d": 5000, None: 3},
        {"a": 10, "b": 0, "c": 7},
        {"z": 5},
        {None: 8, "a": 9},
    ],
)
def test_water_filling(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(fill(sizes))


def many(n=900):
    return [(k, prose(k, 5 + 37 * k % 200), "en", ("hot", "hot", "b", "a", None)[k % 5]) for k in range(n)]


def test_take_meets_targets(spark):
    rows = many()
    out = mixing.take(documents(spark, rows, size=F.lit("clash"), copies=F.lit(9))).collect()
    assert len(out) == len(rows)
    sizes, taken, largest = {}, {}, {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
        assert r.size == len(r.text.split()) and r.taken == r.copies * r.size and 0 <= r.copies <= 2
    target = fill(sizes)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2
        assert all(r.target == pytest.approx(target[s]) for r in out if r.source == s)


def test_reruns_agree_and_seeds_differ(spark):
    docs = documents(spark, many(300))
    runs = [sorted((r.doc_id, r.copies) for r in mixing.take(docs.repartition(n), seed).collect()) for n, seed in ((1, 4), (7, 4), (3, 5))]
    assert runs[0] == runs[1] != runs[2]


def test_mixed_repeats_documents(spark):
    docs = documents(spark, many(300))
    want = {r.doc_id: r.copies for r in mixing.take(docs).collect()}
    got = {}
    for r in mixing.mixed(docs).collect():
        got.setdefault(r.doc_id, []).append(r.copy)
    assert {i: len(c) for i, c in got.items()} == {i: c for i, c in want.items() if c}
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in got.values())


def test_awkward_rows(spark):
    rows = [(i, t, "en", s) for (i, t), s in zip(AWKWARD, ["a", "a", None, "b", "b", None, "empty", "a", "a", None], strict=True)]
    out = mixing.take(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    assert all(r.taken == 0 and r.target == 0 for r in out if r.source == "empty")
    assert len({r.copies for r in out if r.doc_id == 6}) <= 2


def test_empty_table(spark):
    docs = documents(spark, [])
    assert mixing.take(docs).collect() == [] and mixing.mixed(docs).collect() == []


def test_rows_that_share_an_id_and_a_size_meet_the_target(spark):
    rows = [(None, f"same {k % 50} size here", "en", "a") for k in range(400)]
    rows += [(7, "equal rows all over", "en", "b") for k in range(300)]
    rows += [(k, prose(k, 20), "en", "c") for k in range(100)]
    runs = []
    for n in (1, 6):
        out = mixing.take(documents(spark, rows).repartition(n), weights=(3, 2, 2), budget=1.2).collect()
        assert sorted((r.doc_id or 0, r.text) for r in out) == sorted((i or 0, text) for i, text, *_ in rows)
        for source in "abc":
            mine = [r for r in out if r.source == source]
            assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine) / 2
        runs.append(sorted((r.doc_id or 0, r.text, r.copies) for r in out))
    assert runs[0] == runs[1]
