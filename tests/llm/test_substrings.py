from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from strata.llm import substrings
from tests.llm.data import AWKWARD, documents, prose


def brute_force(rows):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - 12):
            if i is not None:
                g = tuple(w[k : k + 13])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, w in split:
        kept = [True] * len(w)
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k : k + 13])] < i:
                kept[k : k + 13] = [False] * 13
        left = b" ".join(x for x, ok in zip(w, kept, strict=True) if ok)
        out.append((i, len(w), kept.count(False), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(
        ((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(df).collect()), key=repr
    )


def test_equals_brute_force_on_shifted_passages(spark):
    rng = random.Random(3)
    passages = [prose(900 + k, n) for k, n in enumerate((12, 13, 14, 19, 20, 40, 100))]
    rows = []
    for i in range(60):
        parts = [prose(1000 + i, rng.randint(0, 40))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            parts += [p, prose(2000 + 7 * i, rng.randint(0, 9))]
        rows.append((i, "\n".join(parts)))
    rows += [(100, passages[3] + " " + passages[3]), (101, rows[5][1]), (102, rows[5][1])]
    rng.shuffle(rows)
    assert result(documents(spark, rows)) == brute_force(rows)


def test_awkward_rows(spark):
    extra = [(8, prose(3, 30_000)), (9, prose(1, 60)), (None, prose(1, 60))]
    rows = AWKWARD + extra
    assert result(documents(spark, rows, n_words=F.lit("clash"), row_key=F.lit(1))) == brute_force(rows)


def test_periodic_text(spark):
    rows = [(1, "a b " * 40), (2, "b a " * 30), (3, "a " * 50), (4, "a " * 13), (5, "a " * 12)]
    assert result(documents(spark, rows)) == brute_force(rows)


def test_empty_table(spark):
    assert result(documents(spark, [])) == []
