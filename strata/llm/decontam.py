"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so the question is containment:
which share of an item's shingles occurs in the document.  An item is kept as
its ``k`` smallest shingle hashes (a bottom-k MinHash sketch).  Items are
partitioned by size (powers of two), and ``k`` follows the largest size ``u``
of the partition: ``k = floor((1 - t) * u) + 1``.  A document that holds at
least the share ``t`` of an item of ``n`` shingles misses at most
``floor((1 - t) * n)`` of them, so it collides with at least
``k - floor((1 - t) * n)`` (one or more) sketch entries: the search loses no
match, however long the document is.  Documents are searched whole, shingle by
shingle; only colliding shingles leave their row.  Candidates are verified on
the shingles themselves (strings, not hashes).

Texts are compared in lower case (A-Z), by 5-word shingles, ``t = 0.75``.

Defined cases: NULL and blank texts match nothing; an item of one to four
words has its whole sequence as its one shingle and is found wherever a
document holds these words in a row (documents are also searched by shingles
of the lengths that occur among such items); rows with a NULL id are never reported; rows that
share an id are one document (or item); an empty table gives no pairs; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, materialize, words

SHINGLE = 5
#: Largest sketch table that is broadcast (rows of 24 bytes); a larger one is
#: joined by shuffling the documents' shingle hashes.
BROADCAST_ROWS = 400_000


def _starts(n_words: int) -> Column:
    """First words of the shingles of ``n_words``; none in a shorter text."""
    many = F.size("_w") >= n_words
    return F.when(many, F.sequence(F.lit(0), F.size("_w") - n_words)).otherwise(F.array().cast("array<int>"))


def _whole_if_short() -> Column:
    """Number of words of an item's shingles: all it has, or ``SHINGLE``."""
    return F.least(F.size("_w"), F.lit(SHINGLE))


def _word_rows(df: DataFrame, id_col: str) -> DataFrame:
    return df.where(F.col(id_col).isNotNull()).select(id_col, words(ascii_lower(F.col("text"))).alias("_w"))


def _hashes(n_words: int) -> Column:
    return F.transform(_starts(n_words), lambda i: F.xxhash64(*(F.get("_w", i + k) for k in range(n_words))))


def _texts(n_words: int) -> Column:
    return F.transform(_starts(n_words), lambda i: F.array_join(F.slice("_w", i + 1, n_words), " "))


def _of_lengths(make, lengths: Sequence[int]) -> Column:
    return make(lengths[0]) if len(lengths) == 1 else F.concat(*(make(n) for n in lengths))


def _of_item(make) -> Column:
    """The shingles of an item, which may be shorter than ``SHINGLE`` words."""
    out = make(SHINGLE)
    for n in range(1, SHINGLE):
        out = F.when(_whole_if_short() == n, make(n)).otherwise(out)
    return out


def item_lengths(items: DataFrame) -> list[int]:
    """Word counts of shingles that occur among the items: ``SHINGLE`` and
    those of shorter items (at most ``SHINGLE`` numbers)."""
    sizes = _word_rows(items, "item_id").where(F.size("_w") > 0).select(_whole_if_short().alias("n")).distinct().collect()
    return sorted({SHINGLE, *(r["n"] for r in sizes)})


def shingle_hashes(df: DataFrame, id_col: str, lengths: Sequence[int] = (SHINGLE,)) -> DataFrame:
    """One row per shingle of every text, of each of ``lengths``: ``id_col, h``."""
    return _word_rows(df, id_col).select(id_col, F.explode(_of_lengths(_hashes, lengths)).alias("h"))


def shingle_texts(df: DataFrame, id_col: str, lengths: Sequence[int] = (SHINGLE,)) -> DataFrame:
    """The distinct shingles of every text as strings: ``id_col, shingle``."""
    return _word_rows(df, id_col).select(id_col, F.explode(F.array_distinct(_of_lengths(_texts, lengths))).alias("shingle"))


def item_shingles(items: DataFrame) -> DataFrame:
    """``item_id, shingle``, distinct."""
    return _word_rows(items, "item_id").select("item_id", F.explode(_of_item(_texts)).alias("shingle")).distinct()


def sketches(items: DataFrame, percent: int = 75) -> DataFrame:
    """``h, item_id, needed``: the sketch of every item and the number of its
    entries that a matching document must hold."""
    own = _word_rows(items, "item_id").select("item_id", F.explode(_of_item(_hashes)).alias("h"))
    hashed = own.groupBy("item_id").agg(F.sort_array(F.collect_set("h")).alias("_s"))
    n = F.size("_s")
    spare = F.floor(n * F.lit(100 - percent) / 100).cast("int")
    partition = F.floor(F.log2(n.cast("double"))).cast("int")
    largest = F.call_function("shiftleft", F.lit(2), partition) - 1
    k = F.least(n, F.floor(largest * F.lit(100 - percent) / 100).cast("int") + 1)
    return hashed.select(
        "item_id", (k - spare).alias("needed"), F.explode(F.slice("_s", F.lit(1), k)).alias("h")
    )


def find(docs: DataFrame, items: DataFrame, percent: int = 75) -> DataFrame:
    """``doc_id, item_id, n_shared, n_item`` of every contaminated pair."""
    lengths = item_lengths(items)
    sketch = materialize(sketches(items, percent), "bench-sketches")
    small = sketch.count() <= BROADCAST_ROWS
    hits = shingle_hashes(docs, "doc_id", lengths).join(F.broadcast(sketch) if small else sketch, "h")
    candidates = materialize(
        hits.groupBy("doc_id", "item_id", "needed")
        .agg(F.count_distinct("h").alias("n"))
        .where(F.col("n") >= F.col("needed"))
        .select("doc_id", "item_id"),
        "bench-candidates",
    )
    # verification: of each candidate pair, the item's shingles, then the document's own
    theirs = materialize(item_shingles(items), "bench-shingles")
    sizes = theirs.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"))
    ids = materialize(candidates.select("doc_id").distinct(), "bench-candidate-ids")
    mine = shingle_texts(docs.join(ids, "doc_id", "left_semi"), "doc_id", lengths).distinct()
    return (
        candidates.join(theirs, "item_id")
        .join(mine, ["doc_id", "shingle"])
        .groupBy("doc_id", "item_id")
        .agg(F.count(F.lit(1)).alias("n_shared"))
        .join(sizes, "item_id")
        .where(F.col("n_shared") * 100 >= F.col("n_item") * percent)
        .select("doc_id", "item_id", "n_shared", "n_item")
    )


def clean(docs: DataFrame, items: DataFrame, percent: int = 75) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    bad = materialize(find(docs, items, percent).select("doc_id").distinct(), "bench-found")
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
