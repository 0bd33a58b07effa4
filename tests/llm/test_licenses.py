from __future__ import annotations

from pyspark.sql import functions as F

from strata.llm import licenses
from tests.llm.data import AWKWARD, documents, prose

MIT = dict(licenses.LICENSE_TEXTS)["MIT"]


def test_spellings_and_copyright_lines_do_not_matter(spark):
    rows = [
        (1, MIT),
        (2, "Copyright (c) 2019, Some One\nAll rights reserved.\n\n" + MIT.upper().replace("\n", "\r\n")),
        (3, "© 2020 x\n" + MIT.replace("sublicense", "sub-licence").replace(",", " ;")),
        (4, MIT + " and more"),
        (5, "Released under the MIT LICENCE"),
        (6, prose(1, 30) + "\n  * licensed under the Apache Licence - version 2.0 \n" + prose(2, 30)),
        (7, "licensed under CC BY 4.0\nReleased under the MIT license!\nLicensed under the MIT License"),
        (8, "not released under the MIT license"),
    ]
    got = {r.doc_id: (r.license, r.notices) for r in licenses.scan(documents(spark, rows)).collect()}
    assert got == {
        1: ("MIT", None),
        2: ("MIT", None),
        3: ("MIT", None),
        4: (None, None),
        5: ("MIT", "MIT"),
        6: (None, "Apache-2.0"),
        7: (None, "CC-BY-4.0,MIT"),
        8: (None, None),
    }


def test_notices_belong_to_their_row(spark):
    rows = [(5, "Released under the MIT License."), (5, prose(4, 20)), (None, "Licensed under CC BY 4.0."), (None, "clean")]
    got = sorted(((r.doc_id, r.license, r.notices) for r in licenses.scan(documents(spark, rows)).collect()), key=repr)
    assert got == sorted([(5, "MIT", "MIT"), (5, None, None), (None, "CC-BY-4.0", "CC-BY-4.0"), (None, None, None)], key=repr)


def test_no_known_notices(spark):
    out = licenses.scan(documents(spark, [(1, MIT), (2, "Released under the MIT License.")]), notices=()).collect()
    assert sorted((r.doc_id, r.license, r.notices) for r in out) == [(1, "MIT", None), (2, "MIT", None)]


def test_awkward_rows(spark):
    docs = documents(spark, AWKWARD + [(8, "(c) 2020\n...")], license=F.lit("clash"), notices=F.lit(0))
    out = licenses.scan(docs).collect()
    assert len(out) == len(AWKWARD) + 1 and all(r.license is None and r.notices is None for r in out)
    blank = {r.digest for r in out if r.doc_id in (1, 2, 3, 8)}
    assert len(blank) == 1


def test_empty_table(spark):
    assert licenses.scan(documents(spark, [])).collect() == []
