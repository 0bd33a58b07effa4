"""Licence scan by canonical digest lookup.

A text is brought to a canonical form (case, copyright lines, equivalent
spellings, punctuation and blanks no longer matter), digested, and the digest
is joined to those of known licences.  The same is done for every line of the
text, which finds one-line licence notices inside longer documents.

Defined cases: NULL and empty texts, and texts of punctuation only, have the
digest of the empty string and never match; equal rows match alike, and rows
that share a ``doc_id`` share their notices; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Equivalent spellings, replaced in this order after lower-casing.
EQUIVALENT = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("sub license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("https:", "http:"),
    ("favour", "favor"),
    ("organisation", "organization"),
    ("fulfil ", "fulfill "),
)

# Whole licence texts.
LICENSE_TEXTS = (
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    ),
)

# One-line notices.
LICENSE_NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
)

COPYRIGHT_LINE = (
    r"(?md)^[^\w\n]*(copyright[^\w\n]*(\(c\)|©|[0-9]{4})|\(c\)[^\w\n]*[0-9]{4}|©[^\w\n]*[0-9]{4}"
    r"|all rights reserved)[^\n]*$"
)


def canonical(text: Column) -> Column:
    """Canonical form, line structure kept."""
    out = F.lower(F.coalesce(text, F.lit("")))
    out = F.regexp_replace(out, COPYRIGHT_LINE, "")
    for spelling, standard in EQUIVALENT:
        out = F.replace(out, F.lit(spelling), F.lit(standard))
    return F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")


def digest(canonical_text: Column) -> Column:
    """Digest of a canonical text; line breaks and blanks are one space."""
    return F.sha2(F.trim(F.regexp_replace(canonical_text, r"[ \n]+", " ")), 256)


def known_digests(spark: SparkSession, texts: Sequence[tuple[str, str]], kind: str) -> DataFrame:
    """``_digest, <kind>`` of known texts; the list is a parameter, not data."""
    rows = spark.createDataFrame(list(texts), f"{kind} string, _text string")
    return rows.groupBy(digest(canonical(F.col("_text"))).alias("_digest")).agg(F.min(kind).alias(kind))


def scan(
    docs: DataFrame,
    texts: Sequence[tuple[str, str]] = LICENSE_TEXTS + LICENSE_NOTICES,
    notices: Sequence[tuple[str, str]] = LICENSE_NOTICES,
) -> DataFrame:
    """``doc_id, digest, license, notices`` of every row of ``docs``.

    ``license``: the known licence that the entire text is, else NULL;
    ``notices``: the licences of its notice lines, sorted, comma-joined, looked
    up inside the row, so rows that share an id (or have none) stay apart.
    Texts never leave their row: only ids and digests are joined.
    """
    spark = docs.sparkSession
    # as many rows as the parameter has
    known = known_digests(spark, notices, "notice").collect() if notices else []
    c = docs.select("doc_id", canonical(F.col("text")).alias("_c"))
    lines = F.filter(F.array_distinct(F.split("_c", "\n", -1)), lambda line: F.length(line) > 1)
    found = F.lit(None).cast("string")
    if known:
        names = F.create_map(*(F.lit(v) for r in known for v in (r["_digest"], r["notice"])))
        held = F.array_distinct(F.array_compact(F.transform(lines, lambda line: F.try_element_at(names, digest(line)))))
        found = F.when(F.size(held) > 0, F.array_join(F.array_sort(held), ","))
    judged = c.select("doc_id", digest(F.col("_c")).alias("digest"), found.alias("notices"))
    return judged.join(known_digests(spark, texts, "license"), F.col("digest") == F.col("_digest"), "left").select(
        "doc_id", "digest", "license", "notices"
    )
