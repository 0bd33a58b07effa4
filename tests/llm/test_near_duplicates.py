from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strata.llm import neardup
from tests.llm.data import AWKWARD, documents, prose


def shingle_set(text):
    w = (text or "").encode().lower().split()
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_force(rows):
    sets: dict[int, set] = {}
    for i, text in rows:
        sets[i] = shingle_set(text)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def changed(text, seed, n):
    rng = random.Random(seed)
    w = text.split()
    for k in rng.sample(range(len(w)), n):
        w[k] = f"x{seed}y{k}"
    return " ".join(w)


def family_rows():
    rows, i = [], 0
    for f in range(6):
        base = prose(100 + f, 150)
        for k in range(9):
            rows.append((i, base if k < 3 else changed(base, 10 * f + k, (k % 4) + 1)))
            i += 1
    # a chain: every text is near the next one only
    w = prose(500, 120).split()
    for k in range(8):
        rows.append((i, " ".join(w[6 * k : 6 * k + 70])))
        i += 1
    passage = prose(600, 60)
    for k in range(30):
        rows.append((i, prose(700 + k, 60) + " " + passage + " " + prose(800 + k, 50)))
        i += 1
    rows += [(i, "Same four words here"), (i + 1, "same FOUR words here"), (i + 2, "same four words")]
    random.Random(5).shuffle(rows)
    return rows


def test_groups_equal_brute_force(spark):
    rows = family_rows()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.groups(documents(spark, rows)).collect()}
    assert got == brute_force(rows)


def test_large_family_with_loose_members(spark):
    """Copies of one text, from hardly to heavily changed, cut and extended:
    some link to the rest only through a few others, some to nobody."""
    rng, base = random.Random(11), prose(42, 160).split()
    rows = []
    for k in range(160):
        w = base[rng.randint(0, 30) : len(base) - rng.randint(0, 40)]
        for at in rng.sample(range(len(w)), rng.randint(0, 9)):
            w[at] = f"q{rng.randint(0, 60)}"
        rows.append((k, " ".join(w + prose(k % 7, rng.randint(0, 30)).split())))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.groups(documents(spark, rows)).collect()}
    want = brute_force(rows)
    assert got == want
    assert 10 < len({c for _, c in want.values()}) < 150


def test_awkward_rows(spark):
    out = neardup.groups(documents(spark, AWKWARD, component_id=F.lit("clash"), kept=F.lit(0))).collect()
    assert len(out) == len(AWKWARD)
    by_id = {r.doc_id: r for r in out if r.doc_id is not None}
    for i in (1, 2, 3):
        assert (by_id[i].n_shingles, by_id[i].component_id, by_id[i].kept) == (0, i, True)
    assert by_id[4].n_shingles == 1
    assert all(r.kept and r.component_id is None for r in out if r.doc_id is None)
    assert [r.kept for r in out if r.doc_id == 6] == [True, True]


def test_one_of_each_keeps_a_single_row_per_group(spark):
    left = neardup.one_of_each(documents(spark, AWKWARD + [(9, prose(2, 80)), (8, "one")])).collect()
    ids = sorted(r.doc_id for r in left if r.doc_id is not None)
    assert ids == [1, 2, 3, 4, 5, 6, 7]
    assert sum(r.doc_id is None for r in left) == 2


def test_different_texts_under_one_id_all_stay(spark):
    rows = [(2, prose(50, 70)), (2, prose(51, 70)), (3, prose(52, 70)), (3, prose(53, 70)), (4, None), (4, ""), (None, prose(50, 70))]
    left = neardup.one_of_each(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=repr) == sorted(rows, key=repr)


def test_near_copies_under_repeated_ids(spark):
    base = prose(60, 120)
    near = " ".join(["x", *base.split()[1:]])
    rows = [(5, near), (5, prose(61, 70)), (2, base), (2, prose(62, 70)), (2, base), (7, prose(62, 70))]
    docs = documents(spark, rows).withColumn("source", F.when(F.rand(1) < 2, F.lit("s")))
    left = neardup.one_of_each(docs).collect()
    assert sorted((r.doc_id, r.text) for r in left) == sorted([(5, rows[1][1]), (2, base), (2, rows[3][1])])


def test_each_candidate_pair_is_made_once(spark, monkeypatch):
    """Loose members share many lists; their pair comes from the first alone."""
    seen = []
    real = neardup.confirmed
    monkeypatch.setattr(neardup, "confirmed", lambda pairs, nodes, docs: seen.append(pairs) or real(pairs, nodes, docs))
    rng, base = random.Random(3), prose(42, 160).split()
    rows = []
    for k in range(60):
        w = list(base)
        for at in rng.sample(range(len(w)), 8):
            w[at] = f"q{rng.randint(0, 900)}"
        rows.append((k, " ".join(w)))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.groups(documents(spark, rows)).collect()} == brute_force(rows)
    made = [tuple(r) for r in seen[-1].collect()]
    assert len(made) == len(set(made))


def test_empty_table(spark):
    docs = documents(spark, [])
    assert neardup.groups(docs).collect() == []
    assert neardup.one_of_each(docs).collect() == []


def test_chain_and_star_components(spark):
    links = [(k, k + 1) for k in range(0, 40, 2)] + [(k + 1, k + 2) for k in range(0, 40, 2)] + [(100, k) for k in range(101, 150)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in neardup.components(df).collect()}
    assert all(got[k] == 0 for k in range(1, 41)) and all(got[k] == 100 for k in range(101, 150))


@pytest.mark.parametrize("n", [4, 5, 6])
def test_short_texts_count_as_one_sequence(spark, n):
    text = " ".join("abcdefg"[:n])
    row = neardup.groups(documents(spark, [(1, text)])).first()
    assert row.n_shingles == max(1, n - 4)
