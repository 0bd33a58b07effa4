import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import divergence
from tests.llm.data import AWKWARD, documents, prose


def brute(rows):
    """The definition, in plain Python."""
    terms_of = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        groups[lang or "", source or ""].update(t := terms_of(text))
        docs[lang or ""].update(set(t))
    out = []
    for lang in docs.keys() | {g[0] for g in groups}:
        kept = {t for t, n in docs[lang].items() if n >= 10}
        own = {s: {t: c[t] for t in kept} for (g, s), c in groups.items() if g == lang}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}

        def shares(c):
            total = sum(c.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // total for t in kept}

        p, q = {s: shares(c) for s, c in own.items()}, shares(whole)
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in own:
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in own if o != s]
            term = [(f(p[s][t], q[t]), t) for t in kept if own[s][t] > 0 and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, 10)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def sample():
    rows = [(i, prose(i % 7, 20 + i % 5).title() + " ñandú,x-ray", "en", f"s{i % 9}") for i in range(90)]
    rows += [(100 + i, "alpha beta 12 gamma", None, f"s{i % 3}") for i in range(12)]
    rows += [(200, "rare words only", "fr", "a"), (201, None, "fr", "b"), (202, "alone", "de", None), (203, "", "en", "s0")]
    return rows


@pytest.mark.parametrize("group_block,term_block", [(32, 1024), (2, 3), (1, 1)])
def test_equals_brute_force_for_any_cut_of_the_cube(spark, group_block, term_block):
    rows = sample()
    assert rows_of(divergence.audit(documents(spark, rows), group_block, term_block)) == brute(rows)


def test_awkward_rows_and_clashing_columns(spark):
    rows = [(*r, None, None) for r in AWKWARD] * 3 + [(None, None, "xx", "y")]
    clash = {c: F.lit(1) for c in ("term", "n", "d", "block", "rank", "value", "item")}
    assert rows_of(divergence.audit(documents(spark, rows, **clash))) == brute(rows)


def test_empty_table(spark):
    assert divergence.audit(documents(spark, [])).count() == 0


def test_long_division_is_exact(spark):
    cases = [(0, 1), (7, 3), (10**12, 10**12 + 5), (9 * 10**14, 9 * 10**14 + 7)]
    got = spark.createDataFrame(cases, "n long, m long").select(divergence._share("n", "m")).collect()
    assert [r[0] for r in got] == [1 + 10**9 * (n + 2) // m for n, m in cases]
    assert spark.createDataFrame([(1, 0)], "n long, m long").select(divergence._share("n", "m")).first()[0] is None


def test_counts_are_flushed_in_parts(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "FLUSH_BYTES", 5)
    batch = pa.record_batch({"lang": ["a"] * 4, "source": ["s"] * 4, "text": ["x y", "x", None, "y y y"]})
    total = Counter()
    for out in divergence._count(iter([batch])):
        for r in out.to_pylist():
            total[r["term"]] += r["n"]
    assert total == {"": 0, "x": 2, "y": 4}
