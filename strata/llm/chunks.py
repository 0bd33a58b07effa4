"""Word hashing of Arrow batches, vectorised in numpy.

Used inside ``mapInArrow`` tasks.  A batch is cut into chunks of a bounded
number of text bytes (one text at least, so a text is never cut), all words of
a chunk are found and hashed at once, and n-gram hashes are taken over runs of
consecutive words of one text.

Word hashes are 64-bit polynomials over random byte values, finished with a
bit mixer; n-gram hashes combine word hashes in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20

_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20_240_601))
_BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_ORDER = 0xD6E8FEB86659FD93
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finisher."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start, start + count)`` of all pairs."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


@dataclass
class Chunk:
    """Some rows of a batch: ``first`` .. of the batch, with their words."""

    batch: pa.RecordBatch
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    #: word numbers where each row begins; one more than rows
    rows: np.ndarray
    hashes: np.ndarray

    def __len__(self) -> int:
        return self.batch.num_rows

    def n_words(self) -> np.ndarray:
        return np.diff(self.rows)

    def word(self, k: int) -> bytes:
        return self.data[self.starts[k] : self.ends[k]].tobytes()

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions (word numbers in the chunk) of all n-grams inside one row
        and their hashes; a row of ``m`` words has ``max(0, m - n + 1)``."""
        counts = np.maximum(self.n_words() - n + 1, 0)
        at = spans(self.rows[:-1], counts)
        return at, run_hash(self.hashes, at, n)

    def ngram_rows(self, n: int) -> np.ndarray:
        """Border of each row's n-grams among those of :meth:`ngrams`."""
        return np.concatenate([[0], np.cumsum(np.maximum(self.n_words() - n + 1, 0))])


def run_hash(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words that begin at each position."""
    out = np.full(len(at), n, np.uint64)
    for k in range(n):
        out = out * _U(_ORDER) + hashes[at + k]
    return mix(out)


def tokenize(batch: pa.RecordBatch, text_col: str, lower: bool) -> Chunk:
    text = batch.column(text_col)
    if text.null_count:
        text = pc.fill_null(text, "")
    if not pa.types.is_large_string(text.type):
        text = text.cast(pa.large_string())
    _, offsets, values = text.buffers()
    cuts = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
    raw = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    data = raw[cuts[0] : cuts[-1]]
    cuts = cuts - cuts[0]
    if lower:
        data = _LOWER[data]
    n = len(data)
    word = ~_BLANK[data]
    # a word begins after a blank or at the border of a text, and ends likewise
    border = np.zeros(n + 1, bool)
    border[cuts] = True
    left, right = border[:-1].copy(), border[1:].copy()
    if n:
        left[1:] |= ~word[:-1]
        right[:-1] |= ~word[1:]
    starts = np.flatnonzero(word & left)
    ends = np.flatnonzero(word & right) + 1
    summed = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers(_BASE, n), out=summed[1:])
    back = powers(_BASE_INVERSE, n)
    hashes = mix((summed[ends] - summed[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    return Chunk(batch, data, starts, ends, np.searchsorted(starts, cuts), hashes)


def chunks(
    batches: Iterator[pa.RecordBatch], text_col: str = "text", lower: bool = False, max_bytes: int = CHUNK_BYTES
) -> Iterator[Chunk]:
    """Cut batches into chunks of about ``max_bytes`` of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0)
        total = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + max_bytes, "right")))
            yield tokenize(batch.slice(at, end - at), text_col, lower)
            at = end
