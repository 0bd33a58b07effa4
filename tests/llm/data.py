"""Small tables for the training-data operators, with awkward rows."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, syllables: str = "ka lo mi nu ter sa bri ond vel ix pra gu") -> str:
    """``n`` invented words."""
    rng = random.Random(seed)
    parts = syllables.split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))


def documents(spark, rows, **extra):
    """A documents table from ``(doc_id, text)`` or longer rows."""
    full = [(r[0], r[1], *(r[2:] or ("en", "web")), None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    for name, value in extra.items():
        df = df.withColumn(name, value)
    return df


#: NULL, empty and blank texts, a NULL id, repeated rows, odd blanks, a very long text
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (5, "non breaking and wide blanks stay in words"),
    (None, prose(1, 60)),
    (None, None),
    (6, prose(2, 80)),
    (6, prose(2, 80)),
    (7, prose(3, 30_000)),
]
