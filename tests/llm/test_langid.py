from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from strata.llm import langid
from tests.llm.data import AWKWARD, documents, prose

SYLLABLES = {"xx": "ka lo mi nu ter sa bri", "yy": "öv ße ünt gra schu lei", "zz": "ción ñe lla que rro dos"}


def rows(n=150):
    return [(k, prose(k, 30, SYLLABLES[lang]), lang, "web") for k in range(n) for lang in [list(SYLLABLES)[k % 3]]]


def test_held_out_accuracy_and_calibration(spark):
    docs = documents(spark, rows())
    out = langid.predict(docs, langid.learn(docs)).collect()
    truth = {r[0]: r[2] for r in rows()}
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {k for k in truth if zlib.crc32(str(k).encode()) % 5 == 0}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_labels_of_held_out_rows_are_not_used(spark):
    plain = documents(spark, rows(90))
    odd = plain.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("wrong")).otherwise(F.col("lang")))
    a, b = langid.learn(plain), langid.learn(odd)
    assert a.languages == b.languages == ("xx", "yy", "zz") and np.array_equal(a.scores, b.scores)


def test_sample_bound(spark):
    model = langid.learn(documents(spark, rows(150)), max_train=20)
    assert model is not None and set(model.languages) <= set(SYLLABLES)


def test_awkward_rows(spark):
    docs = documents(spark, [(50 + k, *r[1:]) for k, r in enumerate(rows(60))] + AWKWARD + [(8, "12 34 ?!"), (9, "é"), (10, "x")], score=F.lit("clash"))
    out = langid.predict(docs, langid.learn(docs)).collect()
    assert len(out) == docs.count()
    by_id = {r.doc_id: r for r in out if r.doc_id is not None}
    for i in (1, 2, 3, 8):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    for i in (4, 5, 6, 7, 9, 10):
        assert by_id[i].lang_pred != "und"
    assert len({(r.lang_pred, r.score) for r in out if r.doc_id == 6}) == 1


def test_nothing_to_learn_from_and_empty_table(spark):
    docs = documents(spark, [(1, "some text", None, "web"), (2, None)])
    assert langid.learn(docs) is None
    assert {(r.lang_pred, r.score) for r in langid.predict(docs, None).collect()} == {("und", 0.0)}
    none = documents(spark, [])
    assert langid.predict(none, langid.learn(none)).collect() == []


def test_rare_languages_are_in_the_sample(spark):
    rare = [(5000 + k, prose(k, 30, SYLLABLES["zz"]), "zz", "web") for k in range(4)]
    common = [(k, text, lang, source) for k, text, lang, source in rows(600) if lang != "zz"]
    model = langid.learn(documents(spark, common + rare), max_train=40)
    assert model.languages == ("xx", "yy", "zz")


def test_a_language_of_one_text_is_trained_on(spark):
    grams = {"aa": [1, 2, 3], "bb": [4, 5, 6]}
    samples = [("bb" if k == 5 else "aa", np.array(grams["bb" if k == 5 else "aa"]), np.ones(3)) for k in range(40)]
    scores = langid.fit(samples).scores
    assert scores[4:7, 1].mean() > scores[4:7, 0].mean() + 1
