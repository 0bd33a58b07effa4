"""Token ids in ORC files, in ascending document order.

``write`` encodes every text, appends an end id, and writes one ORC file per
task.  Rows are dealt by ranges of ``(doc_id, hash of the text, row number)``,
so files follow each other in document order and repeated or NULL ids cannot
pile up in one task; a file's rows are sorted.  A row is ``part, doc_id,
local_start, n_tokens, ids``: ``part`` numbers the files in order and
``local_start`` counts the ids before the row in its file, so a place in the
whole stream is the file's base plus ``local_start``.  The bases come from a
column-pruned read of ``part, n_tokens`` (one row per file).

What the format gives: ``ids`` and the counters are run-length encoded
integers; stripes of ``STRIPE_BYTES`` are the unit of a split, so one large
file is read by many tasks; row indexes every ``INDEX_ROWS`` rows and Bloom
filters on ``doc_id`` let a reader skip stripes and row groups.  ``read(...,
doc_ids=[...])`` pushes its ids down to both.

Defined cases: NULL and empty texts are the end id alone; NULL ids come first;
rows that share an id are ordered by hash and text; equal rows are
interchangeable; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import codecs
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence
from itertools import chain, islice, repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import partitions, scratch_path

END_ID = 0
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1000
#: Rows after which the writer looks whether a stripe is full (texts may be long).
STRIPE_CHECK_ROWS = 100
BLOOM_FPP = 0.01
#: Pieces whose ids a worker remembers before it starts anew.
CACHE_PIECES = 1 << 18
#: Pieces longer than this are encoded but not remembered.
CACHE_CHARS = 64
#: Ids a worker holds after which it starts anew as well (those of whole texts count).
CACHE_IDS = 1 << 23
#: Text bytes that are cut into pieces at once.
TEXT_BYTES = 4 << 20
SCHEMA = "part int, doc_id long, local_start long, n_tokens int, ids array<int>"

# --- fixed values: how the byte-level vocabulary cuts a text into pieces, for
# --- texts of ASCII and Latin letters only (others are left to the library)
_PLAIN = re.compile("[\\x00-\\x7fÀ-ÖØ-öø-ɏ]*")
_BLANKS, _DIGITS, _LETTERS = b"\t\n\v\f\r ", b"0123456789", bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
#: what an apostrophe that begins a piece takes along
_ENDINGS = (b"s", b"t", b"m", b"d", b"re", b"ve", b"ll")
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
# --- end of fixed values ---


def _letters_of_bytes() -> str:
    """The vocabulary's letter for each byte: itself if it can be shown, else
    the next free one from 256 on."""
    hidden = [b for b in range(256) if b not in set(_SHOWN)]
    letters = {**{b: b for b in _SHOWN}, **{b: 256 + i for i, b in enumerate(hidden)}}
    return "".join(chr(letters[b]) for b in range(256))


#: Kinds of bytes: blanks, letters, digits, others.
_BLANK, _KINDS = 0, np.full(256, 3, np.uint8)
for _kind, _bytes in enumerate((_BLANKS, _LETTERS, _DIGITS)):
    _KINDS[list(_bytes)] = _kind


def piece_starts(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin; the texts are the bytes between ``cuts``.

    A piece is a run of letters, digits or others, with the space before it; of
    several blanks between two of them the last is a piece of its own or that
    space.  An apostrophe that begins a piece takes an ending along and no more.
    """
    kind = _KINDS[data]
    start = np.ones(len(data), bool)
    start[1:] = kind[1:] != kind[:-1]
    first = np.zeros(len(data) + 1, bool)
    first[cuts] = True
    start |= first[:-1]
    after = np.flatnonzero((kind[1:] != _BLANK) & (kind[:-1] == _BLANK) & ~first[1:-1]) + 1
    start[after - 1] = True
    start[after] = data[after - 1] != ord(" ")
    for ending in _ENDINGS:
        at = np.flatnonzero((data[: -len(ending)] == ord("'")) & start[: -len(ending)])
        for k, byte in enumerate(ending, 1):
            at = at[(data[at + k] == byte) & ~first[at + k]]
        start[at + 1] = False
        at = at[at + len(ending) + 1 < len(data)]
        start[at + len(ending) + 1] = True
    return np.flatnonzero(start)


class _Known(dict):
    """Numbers of remembered pieces; ``lists`` has the ids of every number."""

    #: between pieces; no text that is cut here has this letter
    BETWEEN = "\u3000"

    def __init__(self, tokenizer):
        super().__init__()
        self.model = tokenizer.model
        self.letters = _letters_of_bytes()
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.full = False
        self.sizes, self.ids = [np.ones(1, np.int64)], [np.array([END_ID], np.int32)]
        self.numbers = 1

    def add(self, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Numbers of new lists of ``sizes``; number 0 is the end id alone."""
        self.sizes.append(sizes)
        self.ids.append(ids)
        self.numbers += len(sizes)
        return np.arange(self.numbers - len(sizes), self.numbers)

    def lists(self) -> pa.ListArray:
        self.sizes, self.ids = [np.concatenate(self.sizes)], [np.concatenate(self.ids)]
        ends = np.cumsum(np.append(0, self.sizes[0]))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(self.ids[0]))

    def _spelt(self, text: str) -> str:
        """``text`` in the vocabulary's letters."""
        return codecs.charmap_decode(text.encode(), "strict", self.letters)[0]

    def of(self, pieces: list[str]) -> np.ndarray:
        """Numbers of different pieces; those not remembered are encoded."""
        found = np.fromiter(map(self.get, pieces, repeat(-1)), np.int64, len(pieces))
        at = np.flatnonzero(found < 0)
        new = [pieces[k] for k in at]
        if new:
            spelt = self._spelt(self.BETWEEN.join(new)).split(self._spelt(self.BETWEEN))
            sizes, ids = array("q"), array("i")
            for k in range(0, len(spelt), 1000):
                tokens = list(map(self.model.tokenize, spelt[k : k + 1000]))
                sizes.extend(map(len, tokens))
                ids.extend(map(attrgetter("id"), chain.from_iterable(tokens)))
            found[at] = self.add(np.array(sizes), np.array(ids))
            room = CACHE_PIECES - len(self)
            self.full = len(new) > room
            self.update(islice(((p, n) for p, n in zip(new, found[at].tolist(), strict=True) if len(p) <= CACHE_CHARS), room))
        return found


class PieceEncoder:
    """A byte-level tokenizer that remembers the ids of the pieces of texts.

    Texts of ASCII and Latin letters are cut as the vocabulary's pattern cuts
    them, all texts of a batch at once; a different piece of the batch is looked
    up once, and goes to the library's model if it is not remembered.  Any other
    text, and one that spells out a special token, goes to the library whole.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = _Known(self.tokenizer)

    def encode_all(self, texts: pa.Array) -> pa.ListArray:
        """Ids of every text (NULL: empty), each with the end id."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = [
            k for k, t in enumerate(x.as_py() for x in texts) if not _PLAIN.fullmatch(t) or any(s in t for s in self.special)
        ]
        if self.known.full or len(self.known.ids[0]) > CACHE_IDS:
            self.known.forget()
        # what ends a text comes after its pieces: the end id, or all ids of a text encoded whole
        end = np.zeros(len(texts), np.int64)
        if whole:
            ids = [[*self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids, END_ID] for k in whole]
            end[whole] = self.known.add(np.array([len(x) for x in ids]), np.array([i for x in ids for i in x], np.int32))
            texts = pc.if_else(pa.array(end > 0), "", texts)
        cuts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[cuts[0] : cuts[-1]]
        cuts = cuts - cuts[0]
        starts = piece_starts(data, cuts)
        pieces = pa.Array.from_buffers(
            pa.large_string(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)]
        ).dictionary_encode()
        numbers = self.known.of(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        last = np.searchsorted(starts, cuts[1:])
        order = np.insert(numbers[pieces.indices.to_numpy(zero_copy_only=False)], last, end)
        taken = self.known.lists().take(pa.array(order))
        borders = taken.offsets.to_numpy()[np.concatenate([[0], last + np.arange(1, len(last) + 1)])]
        return pa.ListArray.from_arrays(pa.array(borders), taken.values)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, with the end id."""
        return self.encode_all(pa.array([text])).values.to_numpy()


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder_of(vocabulary: str) -> PieceEncoder:
    """The worker's encoder, which later tasks of the worker use again."""
    if vocabulary not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocabulary] = PieceEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def _slices(column: pa.Array, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Borders of runs of rows of about ``max_bytes`` (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(total, total[at] + max_bytes, "right")) - 1)
        yield at, end
        at = end


def _encoder(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder_of(vocabulary.value)
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            for begin, end in _slices(batch.column("text"), TEXT_BYTES):
                n = end - begin
                ids = encoder.encode_all(batch.column("text").slice(begin, n))
                borders = ids.offsets.to_numpy()
                yield pa.record_batch(
                    [
                        pa.array(np.full(n, part, np.int32)),
                        batch.column("doc_id").slice(begin, n).cast(pa.int64()),
                        pa.array(start + borders[:-1].astype(np.int64)),
                        pa.array(np.diff(borders)),
                        ids,
                    ],
                    names=["part", "doc_id", "local_start", "n_tokens", "ids"],
                )
                start += int(borders[-1])

    return run


def write(docs: DataFrame, path: str, vocabulary: str) -> None:
    """Encode ``doc_id, text`` of ``docs`` into ORC files under ``path``.

    ``vocabulary`` is a byte-level tokenizers JSON file; only the driver reads
    it.  The number of files is the session's number of shuffle partitions.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.xxhash64("text").alias("h"),
        F.monotonically_increasing_id().alias("n"),
    )
    dealt = rows.repartitionByRange(partitions(spark), "doc_id", "h", "n").sortWithinPartitions("doc_id", "h", "text")
    (
        dealt.select("doc_id", "text")
        .mapInArrow(_encoder(shared), SCHEMA)
        .write.option("compression", "zstd")
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .option("orc.rows.between.memory.checks", str(STRIPE_CHECK_ROWS))
        .option("orc.row.index.stride", str(INDEX_ROWS))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(BLOOM_FPP))
        .orc(path)
    )


def parts(spark: SparkSession, path: str) -> DataFrame:
    """``part, base``: ids in all files before a file; one row per file."""
    sums = spark.read.schema(SCHEMA).orc(path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of all documents, or of ``doc_ids``
    alone: those ids reach the ORC reader, which skips the stripes and row
    groups whose statistics or Bloom filters rule them out."""
    rows = spark.read.schema(SCHEMA).orc(path)
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin([int(i) for i in doc_ids]))
    # one row per file: the size of what is broadcast is the number of files
    return rows.join(F.broadcast(parts(spark, path)), "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids"
    )


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        borders = lists.offsets.to_numpy()
        raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<u4")).cast("B")
        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(borders[:-1], borders[1:])]
        yield pa.record_batch(
            [*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(sums, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def checksums(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of rows of :func:`read`."""
    return tokens.mapInArrow(_checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write ``docs`` under the shared checkpoint folder, read the files back
    and return the checksums of what they hold."""
    spark = docs.sparkSession
    path = scratch_path(spark, "orc-tokens")
    write(docs, path, vocabulary)
    return checksums(read(spark, path))
