from __future__ import annotations

import math
import os
import tracemalloc
import zlib
from collections import Counter
from dataclasses import replace
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import pitman_yor as py
from tests.llm.data import AWKWARD, documents, prose


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def is_held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def corpus(n=120):
    """Texts in which words follow each other by habit."""
    rng = np.random.default_rng(2)
    vocabulary = prose(1, 400).split()
    rows = []
    for k in range(n):
        at, out = int(rng.integers(len(vocabulary))), []
        for _ in range(80):
            out.append(vocabulary[at])
            at = (at * 7 + 3) % len(vocabulary) if rng.random() < 0.7 else int(rng.zipf(1.5)) % len(vocabulary)
        rows.append((1000 + k, " ".join(out)))
    return rows


def test_base_columns_and_held_out_gain(spark):
    rows = corpus() + [(500, "ZZTOP Unknownword"), *AWKWARD]
    out = py.score(documents(spark, rows, score=F.lit("clash"), n_tokens=F.lit(0))).collect()
    assert len(out) == len(rows)
    c = Counter(t for i, text in rows if not is_held(i) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    got = {}
    for r in out:
        got.setdefault(r.doc_id, []).append(r)
    for i, text in rows:
        want = sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens(text))
        same = [r for r in got[i] if r.n_tokens == len(tokens(text)) and r.base_score == pytest.approx(want)]
        assert same
        for r in same:
            assert (r.held_out, r.train_tokens) == (is_held(i), n)
            assert r.n_known == sum(c[t] > 0 for t in tokens(text))
            assert r.score < 0 and r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens))
    held = [r for r in out if r.held_out and r.n_tokens > 50]
    assert held and sum(r.score for r in held) > 1.05 * sum(r.base_score for r in held)
    assert len({(r.score, r.base_score) for r in got[6]}) == 1


def test_reruns_agree(spark):
    docs = documents(spark, corpus(40))
    a, b = (sorted((r.doc_id, r.score) for r in py.score(d).collect()) for d in (docs, docs.repartition(5)))
    assert [x[0] for x in a] == [x[0] for x in b]
    assert [x[1] for x in a] == pytest.approx([x[1] for x in b], rel=1e-12)


def test_probabilities_of_a_context_sum_to_one():
    """Over the vocabulary and the unknown token, with one bucket."""
    rng = np.random.default_rng(5)
    words, contexts = 60, 3
    pairs = sorted({(int(w), int(u)) for w, u in zip(rng.zipf(1.3, 900) % words, rng.integers(0, contexts, 900))} | {(w, 0) for w in range(words)})
    keys = np.array([(w << 16) | u for w, u in pairs], np.uint64)
    n = rng.integers(1, 40, len(keys))
    u = np.array([p[1] for p in pairs])
    m = py.Model(np.arange(2, dtype=np.uint64), np.bincount(u, n, contexts).astype(float), int(n.sum()), words, 0.6, 0.5, 1, 1,
                 [py.Totals(np.bincount(u, minlength=contexts).astype(float), len(keys), words)])
    for _ in range(py.BURN_IN + py.SAMPLES):
        *_, s = py.sweeps(m, 0, keys, n)
        m.totals.append(py.Totals(np.bincount(s.context, s.tables, contexts), s.parent_customers.sum(), s.parent_tables.sum()))
        assert (s.tables >= 1).all() and (s.tables <= n).all()
        assert (s.parent_tables >= 1).all() and (s.parent_tables <= s.parent_customers).all()
    pair, lower, word = py._probabilities(m, 0, keys, n)
    samples = m.totals[py.BURN_IN + 1 :]
    for c in range(contexts):
        total = pair[u == c].sum()
        unseen = np.setdiff1d(np.arange(words), word[u == c])
        for k, t in enumerate(samples):
            total += m.backoff(t)[c] * (lower[k, unseen].sum() + m.unseen(t)) / len(samples)
        assert total == pytest.approx(1.0)


def test_reseating_keeps_customers_and_reaches_the_known_mean():
    """With a new table's weight 1 and discount 0 this is a Chinese restaurant:
    ``c`` customers use ``sum 1 / i`` tables on average."""
    rng = np.random.Generator(np.random.PCG64(1))
    c = np.full(4000, 12)
    t, sizes, new = np.ones(4000, np.int64), None, np.ones(4000)
    for _ in range(60):
        t, sizes = py.reseat(c, t, new, 1e-9, sizes, rng)
        assert sizes.sum() == c.sum() and len(sizes) == t.sum()
    expected = sum(1 / (1 + i) for i in range(12))
    assert t.mean() == pytest.approx(expected, rel=0.03)
    assert py.seat_in_order(c, new, 1e-9, rng).mean() == pytest.approx(expected, rel=0.03)


def test_large_parties_are_seated_in_blocks():
    rng = np.random.Generator(np.random.PCG64(3))
    t = py.seat_in_order(np.full(200, 100_000), np.full(200, 5.0), 1e-9, rng)
    assert t.mean() == pytest.approx(sum(5 / (5 + i) for i in range(100_000)), rel=0.06)


def test_no_training_text_and_empty_table(spark):
    held = next(k for k in range(100) if is_held(k))
    r = py.score(documents(spark, [(held, "only held out")])).first()
    assert (r.train_tokens, r.n_known, r.base_score) == (0, 0, 0.0) and r.score <= 0
    assert py.score(documents(spark, [])).collect() == []


def test_rare_tokens_have_a_context_of_their_own(spark, monkeypatch):
    """What follows the rare ``aft`` and ``fore`` is learned all the same, with
    or without the broadcast pairs."""
    train, held = [k for k in range(300) if not is_held(k)], [k for k in range(300) if is_held(k)]
    rows = []
    for j, k in enumerate(train):
        parts = [f"aft {'pitch' if j % 2 else 'filler'}", f"x{j % 7}", f"fore {'yaw' if j % 2 else 'filler'}"]
        rows.append((k, " ".join(parts[:: 1 if j % 4 < 2 else -1])))
    rows += [(held[0], "aft pitch"), (held[1], "fore pitch")]
    got = {r.doc_id: r for r in py.score(documents(spark, rows)).collect()}
    assert got[held[0]].base_score == pytest.approx(got[held[1]].base_score, abs=0.3)
    assert got[held[0]].score > got[held[1]].score + 0.7
    monkeypatch.setattr(py, "FREQUENT", 1)
    again = {r.doc_id: r for r in py.score(documents(spark, rows)).collect()}
    assert [again[k].score for k in got] == pytest.approx([got[k].score for k in got], rel=1e-12)


def known_mean(c, new, d):
    """Of the tables of ``c`` customers, from the sum over all seatings."""
    ways = np.zeros(1)
    for v in range(2, c + 1):
        stay = np.append(ways + np.log(v - 1 - d * np.arange(1, v)), -np.inf)
        ways = np.logaddexp(stay, np.append(-np.inf, ways))
    weight = ways + np.arange(c) * math.log(new)
    weight = np.exp(weight - weight.max())
    return (weight * np.arange(1, c + 1)).sum() / weight.sum()


@pytest.mark.parametrize("d", [1e-9, 0.5])
@pytest.mark.parametrize("tables", [1, 300])
def test_large_parties_recover_from_a_wrong_start(d, tables):
    rng = np.random.Generator(np.random.PCG64(4))
    c, new = np.full(200, 300), np.full(200, 5.0)
    t, sizes, late = np.full(200, tables), np.full(200 * tables, 300 // tables), []
    for k in range(100):
        t, sizes = py.reseat(c, t, new, d, sizes, rng)
        assert np.array_equal(np.add.reduceat(sizes, np.cumsum(t) - t), c)
        late += [t.mean()] if k >= 60 else []
    assert np.mean(late) == pytest.approx(known_mean(300, 5.0, d), rel=0.06)


@pytest.mark.parametrize("exact", [1024, 100])
def test_a_sweep_reseats_large_parties_and_their_parent(monkeypatch, exact):
    """Tables follow the weights within a few sweeps, however wrong they were."""
    monkeypatch.setattr(py, "EXACT", exact)
    rng = np.random.Generator(np.random.PCG64(8))
    c, new = np.full(200, 1000), np.full(200, 5.0)
    want = known_mean(1000, 5.0, 0.5)
    t, sizes = py.renew(c, new, 0.5, rng)
    for _ in range(3):
        t, sizes = py.renew(c, new, 0.5, rng, c, t, sizes)
    assert t.mean() == pytest.approx(want, rel=0.08)
    assert sizes.sum() == (0 if exact >= 1000 else c.sum())
    fewer = np.where(np.arange(200) < 100, 700, 1300)
    t, sizes = py.renew(fewer, new, 0.5, rng, c, t, sizes)
    large = fewer > exact
    assert np.array_equal(np.add.reduceat(sizes, np.cumsum(t[large]) - t[large]), fewer[large])
    if exact >= 1000:
        wrong = py.renew(c, new, 0.5, rng, c, np.full(200, 1000), np.zeros(0, np.int64))[0]
        assert wrong.mean() == pytest.approx(want, rel=0.06)


def test_sweeps_read_what_can_move_alone(spark, monkeypatch):
    """Pairs that occur once have one table in every seating: what sweeps hand
    on stays below a byte a pair."""
    sizes, write = Counter(), py.materialize

    def measured(df, name):
        out = write(df, name)
        if "data" in out.columns:
            sizes[name] += out.agg(F.sum(F.length("data"))).first()[0] or 0
        return out

    monkeypatch.setattr(py, "materialize", measured)
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(3000))) for k in range(40)]
    assert len(py.score(documents(spark, rows)).collect()) == 40
    assert 0 < sizes["lm-sweep"] < 120_000 and sizes["lm-scored"] < 120_000


def test_seating_of_the_core_is_that_of_all_pairs():
    rng = np.random.default_rng(6)
    pairs = np.array(sorted({(int(w), int(u)) for w, u in zip(rng.zipf(1.4, 3000) % 200, rng.integers(0, 40, 3000))}))
    n = rng.choice([0, 1, 1, 1, 2, 5, 2000], len(pairs))
    words, per_word = np.unique(pairs[:, 0], return_counts=True)
    full = py.Pairs(words.astype(np.uint64), per_word, pairs[:, 1], n, np.arange(40, dtype=np.uint64))
    _, ones, per_core, context, m, contexts = full.core()
    model = py.Model(full.contexts, full.per_context(n).astype(float), int(n.sum()), len(words), 0.6, 0.5, 1, 1,
                     [py.Totals(full.per_context(n > 0).astype(float), len(n), len(words))] * 2)
    core_model = replace(model, totals=[replace(t, tables=t.tables[contexts.astype(np.int64)]) for t in model.totals])
    a = b = None
    for k in range(2):
        a = py.sweep(model, 0, k, full.context, full.word, full.n, np.zeros(len(words), np.int64), a)
        b = py.sweep(core_model, 0, k, context, np.repeat(np.arange(len(ones)), per_core), m, ones, b)
        whole = full.seating(b.tables, b.parent_tables)
        assert (b.tables > 1).any() and len(b.sizes)
        for x in ("tables", "parent_customers", "parent_tables"):
            assert np.array_equal(getattr(a, x), getattr(whole, x))


def test_packed_arrays_come_back():
    for x in (np.zeros(0, np.int64), np.arange(300) ** 4, np.array([2**63 + 1, 5], np.uint64), np.array([True, False])):
        assert np.array_equal(py._unpacked(pa.py_buffer(py._packed([x])))[0], x)


def test_groups_of_many_buckets(spark, monkeypatch):
    docs = documents(spark, corpus(60) + AWKWARD[:5])
    few = sorted((r.doc_id, r.n_known, r.base_score) for r in py.score(docs).collect())
    for name, value in (("BUCKET_TOKENS", 200), ("SHARD_TOKENS", 900), ("LEAST_BUCKETS", 3), ("FREQUENT", 1)):
        monkeypatch.setattr(py, name, value)
    out = py.score(docs).collect()
    assert sorted(r[:2] for r in few) == sorted((r.doc_id, r.n_known) for r in out)
    assert [r[2] for r in few] == pytest.approx([r.base_score for r in sorted(out, key=lambda r: (r.doc_id, r.n_known, r.base_score))])
    held = [r for r in out if r.held_out and r.n_tokens > 50]
    assert held and sum(r.score for r in held) > 1.05 * sum(r.base_score for r in held)


def test_tables_of_the_sweeps_go_when_they_are_done(spark, monkeypatch):
    gone, drop = [], py.drop
    monkeypatch.setattr(py, "drop", lambda df: (gone.append(df.inputFiles()), drop(df)))
    assert len(py.score(documents(spark, corpus(20))).collect()) == 20
    files = [f.removeprefix("file://") for x in gone for f in x]
    assert len(gone) == 2 + py.SAMPLES and files and not any(os.path.exists(f) for f in files)


def resident():
    """MB of this process that no file backs."""
    with open("/proc/self/status") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("RssAnon")) / 1024


def test_freed_memory_goes_back_to_the_system():
    """Freed pieces below what still is in use would otherwise stay with the worker."""
    held = []

    def run(table):
        pieces = [np.ones(12_000) for _ in range(2000)]
        held.append(pieces[::100])
        return table

    table = pa.table({"x": [1]})
    before = resident()
    assert py._tidy(run)(table) is table
    assert list(py._tidy_batches(lambda batches: (run(b) for b in batches))(iter([table]))) == [table]
    assert len(held) == 2 and resident() - before < 60


def test_a_group_is_scored_bucket_by_bucket():
    """A group of 16 buckets holds the pairs of one at a time, and finds them all."""
    rng, group = np.random.default_rng(9), 16
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 60_000, 4000)) for _ in range(60)]
    batch = pa.record_batch({"row_key": np.arange(60), "held_out": np.zeros(60, bool), "text": texts, "spread": np.zeros(60, np.int32)})
    counted = pa.Table.from_batches(py._count_pairs(group)(iter([batch])))
    rows, size = counted.to_pylist(), 0
    words, customers = [], []
    for bucket, _, _, counts in py._rows(counted):
        x = py.Pairs(*counts)
        ones = np.ones(len(x.contexts), np.int64)
        rows.append(py._row(bucket, py.ALL_TOTALS, 0, x.per_context(x.n), *[ones] * py.SAMPLES))
        core = [np.ones(m.sum(), np.int64) for m in (x.moves, x.word_moves)]
        rows += [py._row(bucket, py.SEATED + k, 0, *core, *[np.zeros(0, np.int64)] * 2) for k in range(py.BURN_IN, py.BURN_IN + py.SAMPLES)]
        words.append(x.words)
        customers.append(x.customers)
        size += len(x.n)
    count = dict(zip(np.concatenate(words).tolist(), np.concatenate(customers).tolist()))
    n_tokens = sum(count.values())
    h = py.Header(n_tokens, len(count), 0.8, 0.5, group, 1, group, 1, 0, [(size, len(count))] * (py.BURN_IN + py.SAMPLES + 1))
    none = py.Frequent([np.zeros(0, np.uint64)], [np.zeros(0)], [np.zeros(0)])
    sent = pa.Table.from_batches(py._send(SimpleNamespace(value=h), SimpleNamespace(value=none))(iter([batch])))
    pairs = pa.Table.from_pylist(rows, schema=py._ROW)
    score = py._score_group(SimpleNamespace(value=h))
    tracemalloc.start()
    try:
        out = score(sent, pairs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n_tokens == 60 * 4001 and size > 200_000 and peak < 30 * size
    got = out.group_by("row_key").aggregate([(x, "sum") for x in ("known", "base", "score")]).sort_by("row_key").to_pydict()
    assert got["known_sum"] == [4001] * 60 and all(x < 0 for x in got["score_sum"])
    (c,) = py.chunks(iter([batch]), max_bytes=1 << 30)
    token, borders = py._tokens(c)
    base = np.log10((np.array([count[t] for t in token.tolist()]) + 1) / (n_tokens + len(count) + 1))
    assert got["base_sum"] == pytest.approx(np.add.reduceat(base, borders[:-1]).tolist())
