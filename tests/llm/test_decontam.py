from __future__ import annotations

from pyspark.sql import functions as F

from strata.llm import decontam
from tests.llm.data import AWKWARD, documents, prose


def shingle_set(text):
    w = (text or "").encode().lower().split()
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def runs(text):
    """All runs of one to five words: items of fewer words are found inside."""
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + m]) for m in range(1, 6) for i in range(len(w) - m + 1)}


def brute_force(docs, items):
    ds, qs = {}, {}
    for i, t in docs:
        if i is not None:
            ds.setdefault(i, set()).update(runs(t))
    for i, t in items:
        if i is not None:
            qs.setdefault(i, set()).update(shingle_set(t))
    return {
        (d, q, len(a & b), len(b)) for d, a in ds.items() for q, b in qs.items() if b and 100 * len(a & b) >= 75 * len(b)
    }


def items_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))


def found(spark, docs, items):
    return {tuple(r) for r in decontam.find(documents(spark, docs), items_table(spark, items)).collect()}


def test_equals_brute_force(spark):
    items = [(k, prose(50 + k, 6 + 5 * k)) for k in range(20)] + [(90, "Four words, no more"), (91, None), (92, ""), (None, "x")]
    docs = list(AWKWARD)
    for k in range(20):
        w = items[k][1].upper().split()
        part = w[: max(5, round(len(w) * (0.65 + 0.02 * k)))]
        docs.append((100 + k, prose(300 + k, 500) + "\n" + " ".join(part) + "\n" + prose(400 + k, 400)))
    # an item split over two places of a long text
    w = items[19][1].split()
    docs.append((200, " ".join(w[:50]) + " " + prose(1, 3000) + " " + " ".join(w[46:])))
    docs += [(201, "four words, no more"), (202, "but four words, no more")]
    got = found(spark, docs, items)
    assert got == brute_force(docs, items)
    assert {d for d, *_ in got} >= {119, 200, 201, 202}


def test_items_of_one_to_four_words_inside_long_documents(spark):
    items = [(1, "Red apples fall"), (2, "solo"), (3, "one two three four"), (4, "x y"), (4, "a b c d e f"), (5, "never here")]
    docs = [
        (10, prose(1, 400) + " red APPLES fall " + prose(2, 400)), (11, "red apples"), (12, "solo"), (13, prose(3, 50) + " solo"),
        (14, "zero one two three four five"), (15, "one two three for"), (16, "x y a b c d e f"), (17, "a b c d e f"), (18, "y x"),
    ]
    got = found(spark, docs, items)
    assert got == brute_force(docs, items)
    assert {(d, q) for d, q, *_ in got} == {(10, 1), (12, 2), (13, 2), (14, 3), (16, 4)}


def test_sketch_misses_no_match(spark):
    """However the missing quarter is chosen, enough sketch entries are left."""
    items = items_table(spark, [(n, prose(n, n)) for n in (5, 6, 9, 12, 19, 36, 70, 150, 400)])
    rows = decontam.sketches(items).groupBy("item_id").agg(F.count("h").alias("k"), F.first("needed").alias("needed")).collect()
    for r in rows:
        n = r.item_id - 4
        assert r.needed >= 1 and r.k - n // 4 >= r.needed


def test_clean_keeps_the_rest(spark):
    item = prose(5, 40)
    docs = documents(spark, AWKWARD + [(50, prose(8, 90) + " " + item)], item_id=F.lit(1))
    left = decontam.clean(docs, items_table(spark, [(1, item)]))
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted((i for i, _ in AWKWARD), key=str)


def test_empty_tables(spark):
    assert found(spark, [], [(1, prose(1, 9))]) == set()
    assert found(spark, AWKWARD, []) == set()
