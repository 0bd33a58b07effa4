from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import mixing, neardup, pii, quality
from strata.llm.queries import LLM_QUERIES
from tests.conftest import SF001
from tests.llm.data import AWKWARD, documents, prose
from tests.llm.test_decontam import brute_force as leaks
from tests.llm.test_near_duplicates import brute_force as families
from tests.llm.test_near_duplicates import changed
from tests.llm.test_pii import base_spans

SF01 = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    """Every stage over the small tables, judged on its own input."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF001)
        rows = out.collect()
        after = {r.doc_id: r for r in rows}
        if name != "mixture":
            assert out.columns == columns and len(after) == len(rows)
        if name == "quality":
            judged = quality.judge(docs, quality.learn(docs, spark.read.parquet(f"{SF001}/labels.parquet"))).collect()
            assert set(after) == {r.doc_id for r in judged if r.kept}
        elif name == "near_duplicates":
            groups = families([(i, r.text) for i, r in before.items()])
            assert set(after) == {i for i, (_, c) in groups.items() if i == c}
        elif name == "decontamination":
            bad = {d for d, *_ in leaks([(i, r.text) for i, r in before.items()], items)}
            assert bad and set(after) == set(before) - bad
        elif name == "personal_data":
            assert set(after) == set(before)
            for i, r in after.items():
                assert base_spans(r.text) == [] and r.n_chars == len(r.text)
                if not base_spans(before[i].text) and not re.search("token|password|AKIA|[0-9]", before[i].text):
                    assert r.text == before[i].text
        else:
            want = {r.doc_id: r.copies for r in mixing.take(docs).collect()}
            assert {i: sum(r.doc_id == i for r in rows) for i in want} == want
        docs = spark.createDataFrame(rows, out.schema)


def test_run_is_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF001)
    assert {"doc_id", "text", "lang", "source", "copies", "copy"} <= set(out.columns)
    assert out.count() == out.select("doc_id", "copy").distinct().count() > 50


def test_awkward_rows_pass_all_stages(spark):
    docs = documents(spark, AWKWARD + [(40 + k, changed(prose(2, 80), k, 2)) for k in range(5)], n_words=F.lit(1), _c=F.lit("x"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF001)
        if name != "mixture":
            assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert {r.doc_id for r in docs.collect()} <= {None, 6, 7}


def test_empty_table_passes_all_stages(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
        assert docs.count() == 0
        docs = spark.createDataFrame([], docs.schema)


def test_stage_names_and_registration():
    import __spark_entry__ as entry

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "mixture"]
    assert {*LLM_QUERIES, "pipeline"} <= set(entry.queries())
    assert {int(re.match(r"op(\d+)_", k)[1]) for k in LLM_QUERIES} == set(range(1, 14))
    assert neardup.PERCENT == 75 and neardup.SHINGLE == 5 and pii.KINDS[:4] == ("email", "ip", "card", "phone")


@pytest.mark.parametrize("key", ["op2_decontamination", "op4_mixture", "op5_substring_dedup", "op6_licenses", "op8_near_duplicates", "op10_url_filter", "op12_prefix_trie", "op13_source_divergence"])
def test_query_equals_its_sql(spark, key):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as entry

    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    want = con.execute(entry.oracle_sql()[key])
    names = [d[0] for d in want.description]
    got = entry.queries()[key](spark, SF001)
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(repr, want.fetchall()))
