from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm.chunks import chunks, run_hash, tokenize

TEXT = st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x85 abAB0é日𝄞.", max_size=40))


def batch(texts):
    return pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8), st.booleans(), st.integers(1, 60))
def test_words_are_those_of_bytes_split(texts, lower, size):
    want = [(t or "").encode() for t in texts]
    want = [(w.lower() if lower else w).split() for w in want]
    got = []
    for c in chunks(iter([batch(texts)]), lower=lower, max_bytes=size):
        for r in range(len(c)):
            got.append([c.word(k) for k in range(c.rows[r], c.rows[r + 1])])
    assert got == want


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8), st.integers(1, 4))
def test_equal_runs_and_only_they_share_a_hash(texts, n):
    c = tokenize(batch(texts), "text", False)
    at, grams = c.ngrams(n)
    rows = [(t or "").encode().split() for t in texts]
    want = [tuple(w[i : i + n]) for w in rows for i in range(len(w) - n + 1)]
    assert len(grams) == len(want) == c.ngram_rows(n)[-1]
    assert len(set(zip(want, grams.tolist()))) == len(set(want)) == len(set(grams.tolist()))
    assert np.array_equal(run_hash(c.hashes, at, n), grams)


def test_slices_of_a_batch_and_long_texts():
    texts = ["x y", None, "a" * 300_000 + " b", "", "y x"] * 3
    whole = batch(texts).slice(4, 9)
    words = [c.word(k) for c in chunks(iter([whole]), max_bytes=1000) for k in range(len(c.starts))]
    assert words == [w for t in texts[4:13] for w in (t or "").encode().split()]
