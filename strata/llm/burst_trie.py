"""Prefix trie of conversations, built as a burst trie.

A conversation is the sequence of its turns; a turn's id is a digest of role
and text.  A trie node is a distinct sequence of first turns, its members are
the conversations that begin with it.

1. Turns are gathered per conversation as ids and text lengths (no texts), and
   equal sequences become one *suffix* with a count and its smallest member,
   added up before the shuffle, so a group of copies weighs as much as one.
2. All suffixes start in one container under the empty head.  A container of
   more than ``CONTAINER`` turns that holds different suffixes *bursts*: its
   head grows by the turns that all of it shares (the common prefix of its
   least and greatest suffix), and its suffixes move to one container per next
   turn id.  The nodes of the head are kept with the burst; rounds go on until
   nothing bursts.  A round costs a few shuffles of the suffixes still moving,
   so their number is that of the branchings on the heaviest path.
3. The remaining containers are dealt by head, sorted, and swept: a container's
   nodes come from the common prefixes of neighbours in order.  A task holds one
   container at a time: ``CONTAINER`` turns, or one suffix if that is longer.
4. Totals of subtrees are carried from the containers to the bursts above them,
   last round first.
5. Which conversations end at a node is digested in a sweep over (suffix,
   conversation) in order, one running digest per suffix.  SHA-256 is
   sequential, so ids of one hot suffix pass through one task, as a stream.

Bounds: a conversation is one row of 32-character ids.  Nothing but the number
of bursts of a round is brought to the driver.

Defined cases: NULL role and text are empty; turns are ordered by turn (NULL
first), turns that tie by their ids; rows without a conv_id belong to no
conversation and are left out; an empty table has no nodes; other columns are
ignored; repeated rows are turns of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialize

#: Turns of a container beyond which it bursts.
CONTAINER = 32_768
#: Hex digits of a turn id (128 bits of a SHA-256 digest).
ID_DIGITS = 32
NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODES = pa.schema(
    [(c, pa.string()) for c in ("parent",)]
    + [(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string()), ("top", pa.bool_())]
)
_NODE_COLUMNS = (
    "parent string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, top boolean"
)


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, seq``: every conversation's turns in order, as structs of
    ``turn, id, n`` (``n``: code points of the text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn_id = F.substring(F.sha2(F.concat_ws(":", F.char_length(role).cast("string"), F.concat(role, text)), 256), 1, ID_DIGITS)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn"), turn_id.alias("id"), F.char_length(text).cast("long").alias("n")).alias("t"),
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("seq"))


def shared_openings(seqs: DataFrame) -> DataFrame:
    """Conversation c with the first h turns of conversation ``c - c % 100``
    in front of its own turns after its first h; ``h = crc32(c) % 6``."""
    heads = seqs.where(F.col("conv_id") % 100 == 0).select(F.col("conv_id").alias("base"), F.slice("seq", 1, 5).alias("opening"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    joined = seqs.join(heads, F.col("base") == F.col("conv_id") - F.col("conv_id") % 100, "left")
    none = F.slice("seq", 1, 0)
    own = F.slice("seq", h + 1, F.greatest(F.size("seq"), F.lit(1)))
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("opening", none), F.lit(1), h), own).alias("seq"))


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key of rows that arrive sorted by key and conv_id."""
    key, state = None, None
    for batch in batches:
        keys, digests = [], []
        run_keys = batch.column("key").dictionary_encode()
        codes, ids = run_keys.indices.to_numpy(), batch.column("conv_id").to_pylist()
        cuts = [0, *(i for i in range(1, len(codes)) if codes[i] != codes[i - 1]), len(codes)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            now, text = run_keys.dictionary[codes[a]].as_py(), ",".join(map(str, ids[a:b]))
            if now == key:
                state.update(("," + text).encode())
                continue
            if key is not None:
                keys.append(key)
                digests.append(state.hexdigest())
            key, state = now, hashlib.sha256(text.encode())
        yield pa.record_batch([pa.array(keys, pa.string()), pa.array(digests, pa.string())], names=["key", "ends"])
    if key is not None:
        yield pa.record_batch([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "ends"])


def suffixes(seqs: DataFrame) -> DataFrame:
    """Distinct sequences: ``path`` (turn ids), ``chars`` (text lengths), ``n``
    conversations, the smallest ``conv_id`` and the digest of all, ``ends``."""
    flat = materialize(
        seqs.select("conv_id", F.col("seq.id").alias("path"), F.col("seq.n").alias("chars")).withColumn(
            "key", F.sha2(F.array_join("path", ""), 256)
        ),
        "trie-paths",
    )
    distinct = flat.groupBy("key").agg(
        F.first("path").alias("path"), F.first("chars").alias("chars"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id")
    )
    ordered = flat.select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
    return distinct.join(ordered.mapInArrow(_end_digests, "key string, ends string"), "key").drop("key")


class _Container:
    """Rows of one container in order; :meth:`nodes` sweeps them."""

    def __init__(self, head: str, depth: int, parent: str | None):
        self.head, self.depth, self.parent = head, depth, parent
        self.rows: list[tuple[list[str], list[int], int, int, str]] = []

    def nodes(self) -> Iterator[tuple]:
        depth, up, own, n, low, ends = [], [], [], [], [], []
        stack: list[int] = []  # nodes of the current path, from the top down
        last: list[str] = []
        for path, chars, count, conv_id, digest in self.rows:
            same = 0
            if stack:
                same, most = self.depth, min(len(last), len(path))
                while same < most and last[same] == path[same]:
                    same += 1
                del stack[same - self.depth + 1 :]
            for d in range(self.depth + len(stack), len(path) + 1):
                up.append(stack[-1] if stack else -1)
                stack.append(len(depth))
                depth.append(d)
                own.append(chars[d - 1] if d else 0)
                n.append(0)
                low.append(conv_id)
                ends.append(NO_ENDS)
            at = stack[-1]
            n[at], low[at], ends[at] = count, min(low[at], conv_id), digest
            last = path
        children, leaves, saved = ([0] * len(depth) for _ in range(3))
        for i in range(len(depth) - 1, -1, -1):  # children stand after their parent
            leaves[i] = leaves[i] or 1
            saved[i] += (n[i] - 1) * own[i]
            if (p := up[i]) >= 0:
                n[p] += n[i]
                low[p] = min(low[p], low[i])
                children[p] += 1
                leaves[p] += leaves[i]
                saved[p] += saved[i]
        for i, p in enumerate(up):
            yield (
                self.parent if p < 0 else None, low[i], depth[i], None if p < 0 else low[p], n[i], children[i], leaves[i],
                saved[i], ends[i], p < 0,
            )


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _NODES)], schema=_NODES)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose suffixes arrive sorted by (cid, path)."""
    open_: _Container | None = None
    out: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("cid", "depth", "parent", "path", "chars", "n", "conv_id", "ends"))):
            cid, depth, parent, *rest = row
            if open_ is None or open_.head != cid:
                if open_ is not None:
                    out.extend(open_.nodes())
                open_ = _Container(cid, depth, parent)
            open_.rows.append(tuple(rest))
            if len(out) >= 10_000:
                yield _table(out)
                out = []
    if open_ is not None:
        out.extend(open_.nodes())
    if out:
        yield _table(out)


def _overfull(items: DataFrame, limit: int) -> DataFrame:
    """Containers that burst, with their head's new depth ``to``."""
    load = F.sum(F.size("path") - F.col("depth") + 1)
    stats = items.groupBy("cid").agg(
        load.alias("load"),
        F.min("path").alias("lo"),
        F.max("path").alias("hi"),
        F.first("depth").alias("depth"),
        F.first("parent").alias("parent"),
        F.sum("n").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.min_by("chars", "path").alias("chars"),
    )
    shared = (F.array_position(F.zip_with("lo", "hi", lambda a, b: a.eqNullSafe(b)), F.lit(False)) - 1).cast("int")
    return (
        stats.where((F.col("load") > limit) & (F.col("lo") != F.col("hi")))
        .withColumn("to", shared)
        .withColumn("chars", F.slice(F.concat(F.array(F.lit(0).cast("long")), "chars"), F.col("depth") + 1, F.col("to") - F.col("depth") + 1))
        .select("cid", "parent", "depth", "to", "n_convs", "conv_id", "chars")
    )


def _burst(items: DataFrame, limit: int) -> tuple[list[DataFrame], DataFrame]:
    """Bursts of every round, and the suffixes in their final containers."""
    rounds: list[DataFrame] = []
    settled: DataFrame | None = None
    while True:
        big = materialize(_overfull(items, limit), "trie-bursts")
        still = items.join(big.select("cid"), "cid", "left_anti")
        settled = still if settled is None else settled.unionByName(still)
        if big.isEmpty():
            return rounds, settled
        hit = items.drop("depth", "parent").join(big.select("cid", "to"), "cid")
        ended = hit.where(F.size("path") == F.col("to")).select("cid", "ends")
        rounds.append(materialize(big.join(ended, "cid", "left"), "trie-burst"))
        items = materialize(
            hit.where(F.size("path") > F.col("to")).select(
                F.md5(F.concat("cid", F.get("path", F.col("to")))).alias("cid"),
                (F.col("to") + 1).alias("depth"),
                F.col("cid").alias("parent"),
                *("path", "chars", "n", "conv_id", "ends"),
            ),
            "trie-moved",
        )


def _burst_nodes(rounds: list[DataFrame], tops: DataFrame) -> list[DataFrame]:
    """Nodes of the bursts' heads, with totals carried up from ``tops``."""
    below = tops.where(F.col("parent").isNotNull()).select("parent", "n_leaves", "saved_tokens")
    out = []
    for bursts in reversed(rounds):
        sums = below.groupBy(F.col("parent").alias("cid")).agg(
            F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below")
        )
        chain = bursts.join(sums, "cid").select("*", F.posexplode("chars").alias("k", "own"))
        down = Window.partitionBy("cid").orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)
        end = F.col("depth") + F.col("k") == F.col("to")
        nodes = materialize(
            chain.select(
                F.when(F.col("k") == 0, F.col("parent")).alias("parent"),
                "conv_id",
                (F.col("depth") + F.col("k")).cast("long").alias("depth"),
                F.when(F.col("k") > 0, F.col("conv_id")).alias("parent_conv_id"),
                "n_convs",
                F.when(end, F.col("n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"),
                "n_leaves",
                (F.col("below") + (F.col("n_convs") - 1) * F.sum("own").over(down)).alias("saved_tokens"),
                F.coalesce(F.when(end, F.col("ends")), F.lit(NO_ENDS)).alias("ends_sha256"),
                (F.col("k") == 0).alias("top"),
            ),
            "trie-heads",
        )
        out.append(nodes)
        above = nodes.where("top AND parent IS NOT NULL").select("parent", "n_leaves", "saved_tokens")
        below = below.unionByName(above)
    return out


def trie(seqs: DataFrame, container: int = CONTAINER) -> DataFrame:
    """Nodes of the trie of ``conv_id, seq`` rows: ``conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    start = suffixes(seqs).select(
        F.lit("").alias("cid"), F.lit(0).alias("depth"), F.lit(None).cast("string").alias("parent"),
        "path", "chars", "n", "conv_id", "ends",
    )
    rounds, settled = _burst(materialize(start, "trie-suffixes"), container)
    low = settled.repartition("cid").sortWithinPartitions("cid", "path").mapInArrow(_sweep, _NODE_COLUMNS)
    swept = materialize(low, "trie-swept")
    nodes = swept
    if rounds:
        for part in _burst_nodes(rounds, swept.where("top")):
            nodes = nodes.unionByName(part)
        bursts = rounds[0]
        for more in rounds[1:]:
            bursts = bursts.unionByName(more)
        above = bursts.select(F.col("cid").alias("parent"), F.col("conv_id").alias("_above"))
        nodes = nodes.join(above, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
