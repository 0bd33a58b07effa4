"""Divergence of sources from each other and from their language.

A *group* is a (lang, source) pair.  Per language the terms that occur in at
least ``MIN_DOCS`` of its documents are kept (``V`` of them); a group, and the
language as a whole, gives each kept term the smoothed share ``p = 1 +
floor(SCALE * (count + 2) / (N + 2 * V))``.  Two shares differ by ``floor((p -
q)^2 / (p + q))``; the divergence of two groups is that, summed over all kept
terms, in whole numbers throughout.

1. Tasks count terms per group in one pass over the texts (occurrences and
   documents), and partial counts are added up by Spark.
2. The (group, group, term) space of a language is cut into a cube of cells:
   ``GROUP_BLOCK`` groups x ``GROUP_BLOCK`` groups x about ``TERM_BLOCK``
   terms, by hashes.  A slice (group block, term block) is replicated to the
   cells it takes part in, one per group block.  A cell's task fills its two
   slices densely and returns partial divergences of its pairs of groups.
3. Partials are added up along the term axis.  Terms that neither block of a
   cell has seen differ by one constant per pair, which is added by count, so
   the cells hold occurring counts only.

No task sees more than two slices, whatever a language or source holds; counts
are added up before they are shuffled.  Shares are exact for ``N + 2 V`` up to
9 * 10^15 (long division in base 1000).

Defined cases: NULL text, lang and source are the empty string; a group
without terms has all counts 0; a language without kept terms has divergence 0
between all its groups; a language of one group has no pairs; an empty table
gives no rows; repeated rows count each time; doc_id and other columns are not
read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialize

MIN_DOCS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10
GROUP_BLOCK = 32
TERM_BLOCK = 1024
#: Text bytes after which a task hands its counts on.
FLUSH_BYTES = 16 << 20

# Terms are runs of ASCII letters and of characters beyond ASCII; the bytes of
# the latter are all 128 or more, so a table of bytes decides.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("d", pa.int64())])


def _flush(seen: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    """Counts per group; the empty term stands for the group itself."""
    for (lang, source), (n, d) in seen.items():
        terms = pa.array([b"", *n], pa.binary()).cast(pa.string())
        yield pa.record_batch(
            [
                pa.array([lang] * len(terms)),
                pa.array([source] * len(terms)),
                terms,
                pa.array([0, *n.values()], pa.int64()),
                pa.array([0, *(d[t] for t in n)], pa.int64()),
            ],
            schema=_COUNTS,
        )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        lang, source = (pc.fill_null(batch.column(c), "").to_pylist() for c in ("lang", "source"))
        texts = batch.column("text").cast(pa.binary())
        for i in range(batch.num_rows):
            n, d = seen.setdefault((lang[i], source[i]), (Counter(), Counter()))
            text = texts[i].as_py() or b""
            terms = text.translate(_TERM_BYTES).split()
            n.update(terms)
            d.update(set(terms))
            size += len(text)
            if size >= FLUSH_BYTES:
                yield from _flush(seen)
                seen, size = {}, 0
    yield from _flush(seen)


def counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, d``: occurrences and documents of each term of
    each group, and one row with the empty term for the group itself."""
    found = docs.select("lang", "source", "text").mapInArrow(_count, "lang string, source string, term string, n long, d long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def _share(count: str, total: str) -> Column:
    """``1 + floor(SCALE * (count + 2) / total)`` by long division in base
    1000, so no product leaves 64 bits; NULL if ``total`` is 0."""
    total = f"nullif({total}, 0)"
    rest, out = f"({count} + 2)", f"1 + {SCALE} * (({count} + 2) div {total})"
    for place in (1_000_000, 1_000, 1):
        rest = f"({rest} % {total} * 1000)"
        out += f" + {place} * ({rest} div {total})"
    return F.expr(out)


def _difference(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def _cell(key: tuple[pa.Scalar, ...], cell: pa.Table) -> pa.Table:
    """Partial divergences of one (lang, block x, block y, term block) cell.

    Rows are ``source, block, term, p``; a NULL term carries the share of the
    terms that a group has not seen.
    """
    lang, x, y = (k.as_py() for k in key[:3])
    cell = cell.combine_chunks()
    source = cell.column("source").combine_chunks().dictionary_encode()
    term = cell.column("term").combine_chunks().dictionary_encode()
    code, p = source.indices.to_numpy(), cell.column("p").to_numpy()
    unseen = cell.column("term").combine_chunks().is_null().to_numpy(zero_copy_only=False)
    block = np.zeros(len(source.dictionary), np.int64)
    block[code] = cell.column("block").to_numpy()
    shares = np.empty((len(source.dictionary), len(term.dictionary)), np.int64)
    shares[code[unseen]] = p[unseen, None]
    shares[code[~unseen], term.indices.drop_null().to_numpy()] = p[~unseen]
    left, right, value = [], [], []
    ys = np.flatnonzero(block == y)
    for a in np.flatnonzero(block == x):
        others = ys if x != y else ys[ys > a]
        gap = shares[a] - shares[others]
        value.append((gap * gap // (shares[a] + shares[others])).sum(axis=1))
        left.append(np.full(len(others), a))
        right.append(others)
    a, b = (np.concatenate([np.zeros(0, np.int64), *side]) for side in (left, right))
    names = source.dictionary
    return pa.table(
        {
            "lang": pa.array([lang] * len(a), pa.string()),
            "a": names.take(pa.array(a)),
            "b": names.take(pa.array(b)),
            "partial": pa.array(np.concatenate([np.zeros(0, np.int64), *value]), pa.int64()),
            "n_terms": pa.array(np.full(len(a), shares.shape[1]), pa.int64()),
        }
    )


def audit(docs: DataFrame, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every group of ``docs``.

    Part ``pair``: every other source of the language with the divergence,
    largest first.  Part ``term``: the ``TOP_TERMS`` occurring terms that the
    group uses more than its language does, by their difference.
    """
    found = materialize(counts(docs), "div-counts")
    seen = found.where("term <> ''")
    terms = (
        seen.groupBy("lang", "term").agg(F.sum("d").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= MIN_DOCS)
    )
    kept = materialize(seen.join(terms.drop("docs"), ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "div-kept")

    per_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    per_lang = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_total")
    )
    every = found.where("term = ''").select("lang", "source")
    width = every.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / group_block).cast("int").alias("blocks"))
    v = F.coalesce("v", F.lit(0))
    groups = materialize(
        every.join(per_group, ["lang", "source"], "left")
        .join(per_lang, "lang", "left")
        .join(width, "lang")
        .select(
            "lang",
            "source",
            "blocks",
            v.alias("v"),
            F.ceil(v / term_block).cast("int").alias("term_blocks"),
            (F.coalesce("total", F.lit(0)) + 2 * v).alias("m"),
            (F.coalesce("lang_total", F.lit(0)) + 2 * v).alias("lang_m"),
            F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("block"),
        )
        .withColumn("p0", _share("0L", "m")),
        "div-groups",
    )
    shares = kept.join(groups, ["lang", "source"]).withColumn("p", _share("n", "m"))

    # the cube: every slice goes to the cells of its group block with each other
    piece = ["lang", "source", "block", "blocks"]
    slices = shares.select(*piece, F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("t"), "term", "p").unionByName(
        groups.where("term_blocks > 0").select(
            *piece,
            F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("t"),
            F.lit(None).cast("string").alias("term"),
            F.col("p0").alias("p"),
        )
    )
    other = slices.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = other.select(
        "lang", F.least("block", "o").alias("x"), F.greatest("block", "o").alias("y"), "t", "source", "block", "term", "p"
    )
    partial = cells.groupBy("lang", "x", "y", "t").applyInArrow(_cell, "lang string, a string, b string, partial long, n_terms long")
    sums = partial.groupBy("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("partial").alias("s"), F.sum("n_terms").alias("n_terms"))
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "s", "n_terms"))

    one = groups.select("lang", F.col("source").alias("a"), "v", F.col("p0").alias("pa"))
    two = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("pb"))
    pairs = (
        one.join(two, (one["lang"] == two["lang"]) & (F.col("a") != F.col("b")))
        .select(one["lang"], "a", "b", "v", "pa", "pb")
        .join(both, ["lang", "a", "b"], "left")
    )
    rest = (F.col("v") - F.coalesce("n_terms", F.lit(0))) * _difference("pa", "pb")
    pair = pairs.select(
        "lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"),
        F.coalesce(F.coalesce("s", F.lit(0)) + rest, F.lit(0)).alias("value"),
    )
    q = shares.withColumn("q", _share("lang_n", "lang_m")).where("n > 0 AND p > q")
    term = q.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _difference("p", "q").alias("value"))

    by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    top = term.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= TOP_TERMS)
    return pair.withColumn("rank", F.row_number().over(by)).unionByName(top)
