"""Near-duplicate groups by a signature-coordinate inverted join.

1. Every text becomes its set of distinct ``SHINGLE``-word shingles and a
   MinHash signature of ``COORDS`` coordinates.  Texts with equal sets share
   one node (their smallest id), so exact copies never form pairs.
2. A node is posted under each coordinate-value pair.  Two nodes with at least
   ``MATCHES`` equal coordinates must share one of any
   ``PREFIX = COORDS - MATCHES + 1`` coordinates of either, so only each
   node's rarest ``PREFIX`` postings are merged; the frequent ones (passages
   that many texts share) are skipped.  Values held by one node use up prefix
   places without producing anything.
3. In every posting list the members meet two centres, the smallest node and
   the one with the most popular values (a linear number of pairs); then, for
   lists whose members are still in different groups, pairs of *different
   groups* meet, unless an upper bound of their overlap rules them out.  Pairs
   inside one group need no test, as only groups are wanted, so no link between
   groups can be missed.  The bound is exact: a set is also kept as a bitmap of
   ``BITS`` hashed positions and the number of shingles beyond the set bits;
   two sets share at most as many shingles as bits, plus the smaller rest.
4. A pair is kept as a candidate when the sizes allow the similarity and the
   signatures agree in ``MATCHES`` coordinates, and confirmed on the full
   shingle sets: ``100 * |A & B| >= 75 * |A | B|``.
5. Groups are the connected components of the confirmed links.

With ``COORDS = 48`` and ``MATCHES = 20`` a link at exactly 0.75 agrees in 36
coordinates on average (standard deviation 3); the chance that it agrees in
fewer than 20 is about 1e-6, and less for more similar texts.

Defined cases: NULL or blank text has no shingles and is its own group; a text
of one to four words has its whole sequence as its one shingle; rows with a
NULL id are passed on ungrouped (``component_id`` NULL, kept); rows that share
an id are one node of the graph; equal rows get equal results; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.chunks import chunks, mix, run_hash
from strata.llm.common import materialize

SHINGLE = 5
COORDS = 48
MATCHES = 20
PREFIX = COORDS - MATCHES + 1
PERCENT = 75
BITS = 1024
BIT_WORDS = BITS // 64
#: Members of a posting list that meet all others in one group of the last round.
LIST_BLOCK = 1024

_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(8_151_623))
_MULTIPLY = _RNG.integers(0, 2**63, COORDS, dtype=np.uint64) * _U(2) + _U(1)
_ADD = _RNG.integers(0, 2**63, COORDS, dtype=np.uint64)


def _shingles(chunk) -> tuple[np.ndarray, np.ndarray]:
    """All shingle hashes of a chunk, row after row, and the rows' borders."""
    at, grams = chunk.ngrams(SHINGLE)
    n = chunk.n_words()
    counts = np.maximum(n - SHINGLE + 1, 0)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        whole = np.array(
            [run_hash(chunk.hashes, chunk.rows[r : r + 1], int(n[r]))[0] for r in short], np.uint64
        )
        place = np.concatenate([[0], np.cumsum(counts)])[short]
        grams = np.insert(grams, place, whole)
        counts[short] = 1
    return grams, np.concatenate([[0], np.cumsum(counts)])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
         ("sig", pa.list_(pa.int32())), ("spare", pa.int32()), ("bits", pa.list_(pa.int64()))]
    )
    for c in chunks(batches, lower=True, max_bytes=2 << 20):
        grams, borders = _shingles(c)
        sizes = np.zeros(len(c), np.int64)
        prints = np.zeros((2, len(c)), np.uint64)
        bits = np.zeros((len(c), BITS), bool)
        for r in range(len(c)):
            if borders[r + 1] > borders[r]:
                distinct = np.unique(grams[borders[r] : borders[r + 1]])
                sizes[r] = len(distinct)
                bits[r, (distinct >> _U(65 - BITS.bit_length())).astype(np.int64)] = True
                prints[0, r] = mix(distinct ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
                prints[1, r] = mix(distinct * _U(0x2545F4914F6CDD1D)).sum(dtype=np.uint64)
        full = np.flatnonzero(sizes)
        sig = np.zeros((len(full), COORDS), np.int32)
        if len(full):
            cut = borders[full]
            for k in range(COORDS):
                low = np.minimum.reduceat((grams * _MULTIPLY[k] + _ADD[k]) >> _U(32), cut)
                sig[:, k] = low.astype(np.uint32).view(np.int32)
        ends = np.zeros(len(c) + 1, np.int32)
        ends[1:] = np.cumsum((sizes > 0) * COORDS)
        sigs = pa.ListArray.from_arrays(pa.array(ends), pa.array(sig.reshape(-1)))
        packed = np.packbits(bits[full], axis=1).view(np.int64).reshape(-1)
        bitmaps = pa.ListArray.from_arrays(pa.array(ends // COORDS * BIT_WORDS), pa.array(packed))
        yield pa.record_batch(
            [c.batch.column("doc_id").cast(pa.int64()), pa.array(sizes), pa.array(prints[0].view(np.int64)),
             pa.array(prints[1].view(np.int64)), sigs, pa.array((sizes - bits.sum(axis=1)).astype(np.int32)), bitmaps],
            schema=schema,
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted distinct shingle hashes of each text, as bytes."""
    for c in chunks(batches, lower=True, max_bytes=2 << 20):
        grams, borders = _shingles(c)
        sets = [np.unique(grams[borders[r] : borders[r + 1]]).tobytes() for r in range(len(c))]
        yield pa.record_batch([c.batch.column("doc_id").cast(pa.int64()), pa.array(sets, pa.binary())],
                              names=["node", "items"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column("left_items"), batch.column("right_items")
        keep = np.zeros(batch.num_rows, bool)
        for r in range(batch.num_rows):
            x = np.frombuffer(left[r].as_buffer(), np.uint64)
            y = np.frombuffer(right[r].as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep[r] = 100 * both >= PERCENT * (len(x) + len(y) - both)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, f1, f2, sig, spare, bits``; ``f1, f2`` fingerprint
    the set, ``spare`` is how many shingles share a bit with another."""
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return thin.mapInArrow(_signatures, "doc_id long, n_shingles long, f1 long, f2 long, sig array<int>, spare int, bits array<long>")


def rare_postings(nodes: DataFrame) -> DataFrame:
    """``key, node, weight`` of the rarest ``PREFIX`` coordinates of each node,
    without the lists that have one member only; ``weight`` adds up the lengths
    of all lists of the node."""
    post = nodes.select(
        "node",
        F.explode(
            F.transform("sig", lambda v, i: i.cast("long") * F.lit(1 << 32) + v.cast("long") + F.lit(1 << 31))
        ).alias("key"),
    )
    shared = post.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    mine = post.join(shared, "key").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("l"))
    room = F.size("l") - F.lit(COORDS - PREFIX)
    weight = F.aggregate("l", F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    kept = mine.where(room > 0).select("node", weight.alias("weight"), F.slice("l", F.lit(1), room)["key"].alias("keys"))
    return kept.select("node", "weight", F.explode("keys").alias("key"))


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of the distinct pairs ``a, b`` that are links."""
    side = nodes.select("node", "n_shingles", "sig")
    x = side.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa"))
    y = side.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb"))
    fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT
    agree = F.size(F.filter(F.zip_with("sa", "sb", lambda p, q: p == q), lambda same: same))
    likely = materialize(
        pairs.join(x, "a").join(y, "b").where(fits & (agree >= MATCHES)).select("a", "b").distinct(), "dup-likely"
    )
    # full sets of the documents that occur in a likely pair
    wanted = materialize(
        likely.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "dup-wanted"
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        wanted, F.col("doc_id") == F.col("node"), "left_semi"
    )
    items = materialize(texts.mapInArrow(_sets, "node long, items binary"), "dup-sets")
    both = likely.join(items.select(F.col("node").alias("a"), F.col("items").alias("left_items")), "a").join(
        items.select(F.col("node").alias("b"), F.col("items").alias("right_items")), "b"
    )
    return both.mapInArrow(_confirm, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node, component``: smallest node reachable over ``a, b`` links.

    Alternates large-star and small-star steps (each joins neighbours to the
    smallest one they know) until the links no longer change; every step is a
    grouped minimum and a join, and is written to shared storage.
    """
    edges = materialize(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "cc",
    )

    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    known = state(edges)
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(
            small.unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct(), "cc"
        )
        now = state(edges)
        if now == known:
            break
        known = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``."""
    signed = materialize(signatures(docs), "dup-signatures")
    full = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    same = ["f1", "f2", "n_shingles"]
    nodes = materialize(
        full.groupBy(*same).agg(
            F.min("doc_id").alias("node"), *(F.first(c).alias(c) for c in ("sig", "spare", "bits"))
        ),
        "dup-nodes",
    )
    post = materialize(rare_postings(nodes), "dup-postings")

    # linear round: every member of a list meets two members of it
    centre = post.groupBy("key").agg(
        F.min("node").alias("c1"), F.max_by("node", F.struct("weight", "node")).alias("c2")
    )
    met = post.join(centre, "key").select("node", F.explode(F.array("c1", "c2")).alias("c"))
    star = met.where(F.col("node") != F.col("c")).select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b"))
    links = materialize(confirmed(star.distinct(), nodes, docs), "dup-links")
    first = components(links)

    # exhaustive round: members of one list that are in different groups
    grouped = post.join(first, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("g")
    )
    # every pair of different groups has a member outside the list's largest one
    open_lists = (
        grouped.groupBy("key", "g")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("key")
        .agg(F.max_by("g", F.struct("n", "g")).alias("major"), F.sum("n").alias("members"), F.count(F.lit(1)).alias("k"))
        .where("k > 1")
        .select("key", "major", F.ceil(F.col("members") / LIST_BLOCK).cast("int").alias("blocks"))
    )
    about = nodes.select("node", "n_shingles", "spare", *(F.get("bits", k).alias(f"w{k}") for k in range(BIT_WORDS)))
    posted = post.groupBy("node").agg(F.collect_list("key").alias("keys"))  # at most PREFIX
    rest = materialize(grouped.join(open_lists, "key").join(about, "node").join(posted, "node"), "dup-open")

    def side(name: str, block: Column) -> DataFrame:
        return rest.select(
            F.col("key").alias(f"key_{name}"),
            block.alias(f"block_{name}"),
            F.col("node").alias(name),
            *(F.col(c).alias(f"{c}_{name}") for c in ("g", "major", "n_shingles", "spare", "keys", *(f"w{k}" for k in range(BIT_WORDS)))),
        )

    n_a, n_b = F.col("n_shingles_a"), F.col("n_shingles_b")
    overlap = F.least("spare_a", "spare_b").cast("long")
    for k in range(BIT_WORDS):
        overlap = overlap + F.bit_count(F.col(f"w{k}_a").bitwiseAND(F.col(f"w{k}_b")))
    may_link = (
        (F.col("g_a") != F.col("g_b"))
        & ((F.col("g_b") == F.col("major_b")) | (F.col("g_a") < F.col("g_b")))
        & (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * PERCENT)
        & (overlap * 100 >= (n_a + n_b - overlap) * PERCENT)
    )
    # a long list is cut into blocks on one side, and each block meets the whole
    # list; a pair is made only in the first of the lists that hold both
    first_list = F.col("key_a") == F.array_min(F.array_intersect("keys_a", "keys_b"))
    x = side("a", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).where("g_a != major_a")
    y = side("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    same_list = (F.col("key_a") == F.col("key_b")) & (F.col("block_a") == F.col("block_b"))
    tried = star.distinct().select(F.col("a").alias("_a"), F.col("b").alias("_b"))
    cross = (
        x.join(y, same_list & may_link & first_list)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .join(tried, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left_anti")
    )
    more = materialize(confirmed(cross, nodes, docs), "dup-links")
    final = components(
        first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
    )

    named = nodes.join(final, "node", "left").select(
        F.col("f1").alias("_f1"),
        F.col("f2").alias("_f2"),
        F.col("n_shingles").alias("_n"),
        F.coalesce("component", "node").alias("_c"),
    )
    on = (F.col("f1") == F.col("_f1")) & (F.col("f2") == F.col("_f2")) & (F.col("n_shingles") == F.col("_n"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", "doc_id"))
    return (
        signed.select("doc_id", *same)
        .join(named, on, "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of every group: the one with the smallest id.

    A document is an id with a text: rows that share an id but not the text are
    documents of their own, and go only if another of their group stays (the
    one with the smallest id, then the smallest digest).  Of rows that repeat
    both, the smallest by all columns stays.  Rows without an id stay.
    """
    named = docs.where(F.col("doc_id").isNotNull())
    if named.groupBy("doc_id").count().where(F.col("count") > 1).isEmpty():
        dropped = materialize(groups(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_dropped")), "dup-dropped")
        return docs.join(dropped, F.col("doc_id") == F.col("_dropped"), "left_anti")
    digest = F.sha2(F.concat(F.col("text").isNull().cast("string"), F.coalesce("text", F.lit(""))), 256).alias("_digest")
    rows = materialize(
        named.select(F.col("doc_id").alias("_id"), digest).distinct().withColumn("_row", F.monotonically_increasing_id()), "dup-rows"
    )
    by_text = named.select("*", digest)
    numbered = by_text.join(rows.withColumnRenamed("_digest", "_d"), (F.col("doc_id") == F.col("_id")) & (F.col("_digest") == F.col("_d")))
    component = groups(numbered.select(F.col("_row").alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), "component_id")
    best = (
        component.distinct().join(rows, "_row").groupBy("component_id").agg(F.min(F.struct("_id", "_digest")).alias("b")).select("b._id", F.col("b._digest").alias("_d"))
    )
    stay = by_text.join(best, (F.col("doc_id") == F.col("_id")) & (F.col("_digest") == F.col("_d")), "left_semi")
    one = stay.groupBy("doc_id", "_digest").agg(F.min(F.struct(*docs.columns)).alias("_one")).select("_one.*")
    return one.unionByName(docs.where(F.col("doc_id").isNull()))
