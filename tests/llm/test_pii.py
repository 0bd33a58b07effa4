from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from strata.llm import pii
from tests.llm.data import AWKWARD, documents, prose


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def only_digits(v):
    return re.sub("[^0-9]", "", v)


# the contract's patterns, as written there
BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 13 <= len(only_digits(v)) <= 19 and luhn(only_digits(v))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(only_digits(v)) <= 15),
)


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in BASE for m in re.finditer(p, text or "") if ok(m.group())]


TEXTS = [
    "mail a.b+c@x.example.com, or éa@b.c@d.e and x@y z@-.- q@w..e",
    "a@b.cx_y@d.e a@b.c@d.e @x.y foo@bar",
    "ip 1.2.3.4.5.6.7.8 and 256.1.1.1 0001.002.3.255 1.2.3 9.9.9.99999999999999999999",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 1 2 3 4111111111111111 79927398713",
    "phone +1 (658) 555-4270, +12345678, +1.2.3.4.5.6.7.8.9 ++49 30 1234567 + 1 2345678901",
    "日本 ☎ +1 (468) 555-0333 été 10.0.0.1\u00a0x@y.zz 𝄞 4012888888881881",
    "+1 555 0100 4111 1111 1111 1111 +1.2.3.4@5.6",
    "9" * 5000 + " " + "1.2.3." * 3000 + " " + "a" * 60000 + " " + "x@" * 3000,
    "4" + "-1" * 20000,
]
ROWS = AWKWARD + [(100 + k, t) for k, t in enumerate(TEXTS)]


def test_base_spans_equal_the_written_patterns(spark):
    docs = documents(spark, ROWS, n_email=F.lit("clash"), found=F.lit(0))
    got = {}
    for r in pii.report(docs, pii.SpanModel()).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, text in ROWS:
        want = base_spans(text)
        for r in got[i]:
            if i is not None:
                assert r.spans == ",".join(want), i
                assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
                kinds = [w.split(":")[0] for w in want]
                assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k, *_ in BASE]
    assert sum(map(len, got.values())) == len(ROWS)


def test_expectation_maximisation_finds_the_reliable_labelers():
    rng = np.random.default_rng(4)
    truth = rng.random(20_000) < 0.4
    accuracy = (0.95, 0.9, 0.6, 0.85)
    votes = np.stack([np.where(rng.random(20_000) < a, np.where(truth, 1, -1), np.where(truth, -1, 1)) for a in accuracy], 1)
    votes[rng.random(votes.shape) < 0.3] = 0
    pattern, back, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    q, got = pii.estimate_reliability(pattern, n.astype(float))
    assert np.abs(got - np.array(accuracy)).max() < 0.05
    assert ((q[back] > 0.5) == truth).mean() > 0.9


def secret_rows():
    rng = np.random.default_rng(7)
    rows = []
    for k in range(80):
        key = "".join(rng.choice(list("0123456789abcdef"), 40))
        aws = "AKIA7" + "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), 15))
        secret = (f'token = "{key}"', aws, f"password={key[:18]}")[k % 3]
        rows.append((k, f"{prose(k, 30)} {secret} {prose(200 + k, 20)} chapter{k}section2overview part-2-of-12-volumes"))
    return rows


def test_learned_spans_add_secrets_and_leave_words(spark):
    rows = secret_rows()
    docs = documents(spark, rows)
    model = pii.learn(docs)
    out = {r.doc_id: r.spans for r in pii.report(docs, model).collect()}
    texts = dict(rows)
    found = []
    for i, spans in out.items():
        for s in filter(None, spans.split(",")):
            kind, a, b = s.split(":")
            assert kind == "secret"
            found.append(texts[i][int(a) : int(b)])
    assert len(found) == 80 and not any("chapter" in f or "volumes" in f for f in found)


def candidates(spark, texts):
    rows = pii.candidate_spans(documents(spark, list(enumerate(texts))), ("doc_id",)).select("_in.doc_id", "s_secret").collect()
    out = {r.doc_id: r.s_secret for r in rows}
    for i, t in enumerate(texts):
        assert all(t[x.s : x.e] == x.v and t[: x.s].endswith(x.p) for x in out[i])
    return [[x.v for x in out[i]] for i in range(len(texts))]


def test_announced_values_of_any_length_are_candidates(spark):
    texts = [
        "password=hunter2 and more", "Token: correcthorsebatterystaple", 'API_KEY = "abcdefghijklmnop"', "secrets: x",
        "the password is long", "pass word: no", "auth=", "tokenize: nothing here", "a" * 90 + "1" + "b" * 20, "credential='é'",
    ]
    assert candidates(spark, texts) == [
        ["hunter2"], ["correcthorsebatterystaple"], ["abcdefghijklmnop"], ["x"], [], [], [], [], ["a" * 90 + "1" + "b" * 20], []
    ]


def test_parts_of_a_candidate_outside_base_spans_are_kept(spark):
    key = "deadbeef0123456789abcdef"
    texts = [f"{key}@mail.example.com/x", f"4111111111111111/{key}", f"10.0.0.1-{key} {key}", "password=4111111111111111/ab", f"a@b.cc/{key}"]
    assert candidates(spark, texts) == [[], ["/" + key], ["-" + key, key], [], ["/" + key]]


def test_short_announced_secrets_are_found(spark):
    rows = secret_rows() + [(500 + k, f"{prose(k, 20)} password=hunter{k} {prose(k, 9)}") for k in range(20)]
    rows += [(600, prose(5, 20) + " token: correcthorsebatterystaple " + prose(6, 20))]
    docs = documents(spark, rows)
    out = {r.doc_id: r.n_secret for r in pii.report(docs, pii.learn(docs)).collect()}
    assert all(out[i] == 1 for i, _ in rows)


def test_redact(spark):
    docs = documents(spark, ROWS, s=F.lit("clash"), text2=F.lit(1))
    out = pii.redact(docs, pii.SpanModel())
    assert out.columns == docs.columns
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[1].text is None and by_id[2].text == "" and by_id[6].text == dict(AWKWARD)[6]
    assert by_id[105].text.startswith("日本 ☎ [PHONE] été [IP]\u00a0[EMAIL] 𝄞 [CARD]")
    assert by_id[105].n_chars == len(by_id[105].text)
    assert base_spans(by_id[103].text) == []


def test_empty_table(spark):
    docs = documents(spark, [])
    model = pii.learn(docs)
    assert model == pii.SpanModel()
    assert pii.report(docs, model).collect() == [] and pii.redact(docs, model).collect() == []
