"""Repeated passages by fixed-block anchors.

A window is ``WINDOW`` (13) consecutive words.  Every word covered by a window
that also occurs in a document with a smaller id is removed; windows are
judged on the input.

1. *Anchors.*  Each text is cut into non-overlapping blocks of ``BLOCK`` (7)
   words, and its rolling 7-word windows probe the blocks of all texts.  Any 13
   words contain a whole block of the text they stand in, so two texts that
   share a window share an anchor: a block of the one that is a rolling
   window of the other.
2. *Extension.*  Around an anchor, each of the seven 13-word windows that
   contain it is looked up among the windows around all anchors.  A window's
   smallest document keeps it; everywhere else its words go.  Runs of such
   windows are the maximal exact repeats.

Hashes travel packed: a task describes a chunk of texts (a few MB) as one row
per bucket, holding the distinct hashes of the chunk that belong there.  A
hash that many texts of the chunk share is resolved inside the chunk and
travels once per chunk, so a passage in a third of all texts loads its
bucket with one entry a chunk, not one a text.  Anchors are found by 39 hash bits besides
the bucket's (a false anchor only costs a look-up); windows are compared by
64 bits.  The number of buckets follows the number of words, so a bucket has a
bounded size.

Only texts with an anchor are read a second time, and only those that lose
words a third time.  A Bloom filter of a fixed size spares the others the
shuffle.

Defined cases: NULL text has no words and keeps the digest of the empty
string; texts under 13 words are untouched; rows with a NULL id neither give
nor lose words; rows that share an id never remove each other's words;
repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import bloom
from strata.llm.chunks import chunks
from strata.llm.common import materialize, partitions, words

WINDOW = 13
BLOCK = 7
#: Distinct hashes a bucket is meant to hold at most.
BUCKET_WORDS = 3_000_000

_U = np.uint64
_ANCHOR_BITS = 39
_ANCHOR_MASK = _U((1 << _ANCHOR_BITS) - 1)
_PLACED = np.dtype([("hash", "<u8"), ("place", "<u4")])

#: One record describes the entries of some texts of one chunk in one bucket:
#: ``rows`` and ``ids`` (8 bytes each) and ``counts`` (4) per text, then the
#: texts' ``items``.  ``settled`` items need no look-up and pass through.
PACKED = "bucket int, settled boolean, rows binary, ids binary, counts binary, items binary"
_SCHEMA = pa.schema(
    [("bucket", pa.int32()), ("settled", pa.bool_()), ("rows", pa.binary()), ("ids", pa.binary()),
     ("counts", pa.binary()), ("items", pa.binary())]
)


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def _heads(ordered: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before it."""
    head = np.ones(len(ordered), bool)
    head[1:] = ordered[1:] != ordered[:-1]
    return head


def _groups(ordered: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of every run of equal values."""
    start = np.flatnonzero(_heads(ordered)).tolist()
    return list(zip(start, [*start[1:], len(ordered)], strict=True)) if start else []


def _pack(bucket: np.ndarray, row: np.ndarray, items: np.ndarray, keys: np.ndarray, ids: np.ndarray | None,
          settled: bool) -> list[dict]:
    """Records of entries, given their bucket and row number in the chunk."""
    order = np.lexsort((row, bucket))
    bucket, row, items = bucket[order], row[order], items[order]
    out = []
    for lo, hi in _groups(bucket):
        first = np.flatnonzero(_heads(row[lo:hi]))
        who = row[lo:hi][first]
        out.append({
            "bucket": int(bucket[lo]),
            "settled": settled,
            "rows": keys[who].tobytes(),
            "ids": b"" if ids is None else ids[who].tobytes(),
            "counts": np.diff(np.append(first, hi - lo)).astype(np.uint32).tobytes(),
            "items": items[lo:hi].tobytes(),
        })
    return out


def _unpack(table: pa.Table, settled: bool) -> Iterator[tuple[np.ndarray, np.ndarray, bytes]]:
    """Row key and id (if any) of every entry, and the items."""
    for k, flag in enumerate(table.column("settled").to_pylist()):
        if flag == settled:
            rows, ids, counts, items = (
                table.column(n)[k].as_py() for n in ("rows", "ids", "counts", "items")
            )
            n = np.frombuffer(counts, np.uint32)
            yield np.repeat(np.frombuffer(rows, np.int64), n), (
                np.repeat(np.frombuffer(ids, np.int64), n) if ids else np.zeros(0, np.int64)
            ), items


def _five_bytes(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])


def _from_five_bytes(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(blob, np.uint8).reshape(-1, 5)
    return wide.view("<u8").reshape(-1)


def _anchor_bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    return ((grams >> _U(40)) % _U(buckets)).astype(np.int64)


def _anchor_item(bucket: np.ndarray | int, grams: np.ndarray) -> np.ndarray:
    """What is known of an anchor after its look-up: bucket and hash bits."""
    return (np.asarray(bucket).astype(np.uint64) << _U(_ANCHOR_BITS)) | (grams & _ANCHOR_MASK)


def _probe(buckets: int):
    """Describe the rolling windows of each chunk; bit 39 marks blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            at, grams = c.ngrams(BLOCK)
            if not len(at):
                continue
            keys = c.batch.column("row_key").to_numpy(zero_copy_only=False)
            row = np.searchsorted(c.rows, at, "right") - 1
            block = (at - c.rows[row]) % BLOCK == 0
            order = np.argsort(grams, kind="stable")
            grams, row, block = grams[order], row[order], block[order]
            head = _heads(grams)
            start = np.flatnonzero(head)
            blocks = np.logical_or.reduceat(block, start).astype(np.uint64)
            several = np.maximum.reduceat(row, start) != row[start]
            bucket = _anchor_bucket(grams, buckets)
            # a hash travels once a chunk, under the first of its texts ...
            entry = (grams[start] & _ANCHOR_MASK) | (blocks << _U(_ANCHOR_BITS))
            out = _pack(bucket[start], row[start], _five_bytes(entry), keys, None, False)
            # ... and where the chunk has several, they have met already
            met = several[np.cumsum(head) - 1]
            if met.any():
                item = _anchor_item(bucket[met], grams[met])
                out += _pack(keys[row[met]] % buckets, row[met], item, keys, None, True)
            yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)

    return run


def _match_anchors(row: np.ndarray, entry: np.ndarray, bucket: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts and anchors: hashes that are a block of one text and occur in another."""
    order = np.argsort(entry & _ANCHOR_MASK, kind="stable")
    row, entry = row[order], entry[order]
    code = entry & _ANCHOR_MASK
    head = _heads(code)
    start = np.flatnonzero(head)
    found = np.maximum.reduceat(entry >> _U(_ANCHOR_BITS), start) > 0
    found &= np.maximum.reduceat(row, start) != np.minimum.reduceat(row, start)
    hit = found[np.cumsum(head) - 1]
    return row[hit], _anchor_item(bucket, code[hit])


def _match_windows(row: np.ndarray, ids: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts and starts of the windows that a smaller document has too."""
    order = np.lexsort((ids, entry["hash"]))
    row, ids, entry = row[order], ids[order], entry[order]
    head = _heads(entry["hash"])
    lost = ids > ids[np.flatnonzero(head)][np.cumsum(head) - 1]
    return row[lost], entry["place"][lost]


def _look_up(buckets: int, kind: str):
    """One bucket of hashes: what it tells each text, packed by the texts'
    own bucket.  Settled records are there already and pass through."""

    def run(table: pa.Table) -> pa.Table:
        settled = table.filter(table.column("settled"))
        looked = list(_unpack(table, False))
        if not looked:
            return settled.cast(_SCHEMA)
        row, ids = (np.concatenate(x) for x in list(zip(*looked, strict=True))[:2])
        if kind == "anchors":
            entry = np.concatenate([_from_five_bytes(blob) for *_, blob in looked])
            row, item = _match_anchors(row, entry, table.column("bucket")[0].as_py())
        else:
            row, item = _match_windows(row, ids, np.concatenate([np.frombuffer(blob, _PLACED) for *_, blob in looked]))
        keys, number = np.unique(row, return_inverse=True)
        told = _pack(keys[number] % buckets, number, item, keys, None, True)
        return pa.concat_tables([settled.cast(_SCHEMA), pa.Table.from_pylist(told, schema=_SCHEMA)])

    return run


def _gather(name: str, item: str):
    """One bucket of texts: all items of each text in one row."""

    def run(table: pa.Table) -> pa.Table:
        parts = [(row, np.frombuffer(blob, item)) for row, _, blob in _unpack(table, True)]
        row, items = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(row, kind="stable")
        row, items = row[order], items[order]
        runs = _groups(row)
        blobs = [items[a:b].tobytes() for a, b in runs]
        return pa.table({"row_key": pa.array([int(row[a]) for a, _ in runs], pa.int64()), name: pa.array(blobs, pa.binary())})

    return run


def _told(entries: DataFrame, buckets: int, name: str, item: str) -> DataFrame:
    """``row_key`` and its items (``name``), one row per text that has any."""
    looked = entries.groupBy("bucket").applyInArrow(_look_up(buckets, name), PACKED)
    gathered = looked.groupBy("bucket").applyInArrow(_gather(name, item), f"row_key long, {name} binary")
    return materialize(gathered, f"repeat-{name}")


def _extend(buckets: int):
    """Describe the 13-word windows around the anchors of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            keys = c.batch.column("row_key").to_numpy(zero_copy_only=False)
            ids = c.batch.column("doc_id").to_numpy(zero_copy_only=False)
            at, grams = c.ngrams(BLOCK)
            borders = c.ngram_rows(BLOCK)
            item = _anchor_item(_anchor_bucket(grams, buckets), grams)
            anchored = np.zeros(len(c.hashes) + 1, np.int64)
            for r in range(len(c)):
                mine = slice(borders[r], borders[r + 1])
                known = np.frombuffer(c.batch.column("anchors")[r].as_buffer(), np.uint64)
                anchored[at[mine] + 1] = np.isin(item[mine], known)
            before = np.cumsum(anchored)
            at, grams = c.ngrams(WINDOW)
            near = before[at + WINDOW - BLOCK + 1] > before[at]
            at, grams = at[near], grams[near]
            if not len(at):
                continue
            row = np.searchsorted(c.rows, at, "right") - 1
            order = np.lexsort((ids[row], grams))
            at, grams, row = at[order], grams[order], row[order]
            entry = np.zeros(len(at), _PLACED)
            entry["hash"], entry["place"] = grams, at - c.rows[row]
            head = _heads(grams)
            least = ids[row[np.flatnonzero(head)]][np.cumsum(head) - 1]
            # only the smallest document of the chunk needs the look-up
            lost = ids[row] > least
            bucket = (grams % _U(buckets)).astype(np.int64)
            out = _pack(bucket[~lost], row[~lost], entry[~lost], keys, ids, False)
            if lost.any():
                out += _pack(keys[row[lost]] % buckets, row[lost], entry["place"][lost], keys, None, True)
            yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)

    return run


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words that their lost windows cover."""
    for batch in batches:
        removed, texts = [], []
        for text, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist(), strict=True):
            all_words = text.encode().split()
            change = np.zeros(len(all_words) + 1, np.int64)
            starts = np.frombuffer(places, np.uint32).astype(np.int64)
            np.add.at(change, starts, 1)
            np.add.at(change, starts + WINDOW, -1)
            kept = np.cumsum(change[:-1]) == 0
            removed.append(int((~kept).sum()))
            texts.append(b" ".join(compress(all_words, kept)).decode())
        yield pa.record_batch(
            [batch.column("row_key"), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
            names=["row_key", "n_removed", "stripped"],
        )


def _with(docs: DataFrame, told: DataFrame) -> DataFrame:
    """Documents that were told something, with it."""
    bits, blocks = bloom.build(told, "row_key", bloom.MAX_BLOCKS * 32)
    told = told.withColumnRenamed("row_key", "_key")
    return bloom.possible(docs, "row_key", bits, blocks).join(told, F.col("row_key") == F.col("_key")).drop("_key")


def stripped(docs: DataFrame, n_words: int) -> DataFrame:
    """``row_key, n_removed, stripped`` of the rows that lose words.

    ``n_words``: words of all texts; it sets the number of buckets.
    """
    buckets = max(partitions(docs.sparkSession), -(-n_words // BUCKET_WORDS))
    known = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        _row_key().alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    probes = known.select("row_key", "text").mapInArrow(_probe(buckets), PACKED)
    anchors = _told(probes, buckets, "anchors", "<u8")
    windows = _with(known, anchors).mapInArrow(_extend(buckets), PACKED)
    places = _told(windows, buckets, "places", "<u4")
    return _with(known, places).mapInArrow(_strip, "row_key long, n_removed long, stripped string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row of ``docs``."""
    base = materialize(
        docs.select(_row_key().alias("row_key"), "doc_id", words(F.col("text")).alias("_w")).select(
            "row_key",
            "doc_id",
            F.size("_w").cast("long").alias("n_words"),
            F.sha2(F.array_join("_w", " "), 256).alias("_sha"),
        ),
        "repeat-base",
    )
    total = base.agg(F.sum("n_words")).first()[0] or 0
    lost = stripped(docs, total).select(
        F.col("row_key").alias("_key"), "n_removed", F.sha2("stripped", 256).alias("_new")
    )
    return base.join(lost.dropDuplicates(["_key"]), F.col("row_key") == F.col("_key"), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("_new", "_sha").alias("kept_sha256"),
    )
