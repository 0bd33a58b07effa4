"""Language-model scoring by a hierarchical Pitman-Yor model.

Tokens are words in lower case (A-Z) and one end mark a text.  The model has a
restaurant for every context, a parent restaurant that all contexts share,
and a uniform base over the ``V`` known tokens and one unknown.  A context is
the preceding token, however rare (the end mark precedes a text's first token).
Dishes are all tokens of the vocabulary.

*Seating.*  A new table has weight ``(theta + d * T) * P``, where ``T`` counts
the context's tables and ``P`` is the parent's probability of the token, a
seat at a table ``size - d``.  A sweep reseats every customer.  The number of
tables of a (context, token) pair of up to ``EXACT`` customers is drawn from
its distribution given these weights, whatever it was before.  A larger party is
first seated in order, in growing blocks; every Gibbs sweep then takes all its
customers from their tables, one in ``BLOCKS`` of them at a time, and seats them
again by the sizes of the tables, which are kept from sweep to sweep.  New tables
are customers of the parent, which is seated likewise; between sweeps its
customers come and go as tables open and close.  Within a sweep, context totals and parent probabilities
are those of the sweep before.  Discounts come from the counts of counts.
Predictive probabilities are averaged over the last ``SAMPLES`` sweeps.

*Distribution.*  Pairs are counted over all texts (those of held-out texts only
with no customers) and dealt to buckets by token, so a token's pairs and its
place in the parent restaurant meet in one bucket; a bucket never holds more
than one entry per context and token, however frequent they are.  A pair of one
customer has one table in every seating, and a token of one customer one parent
table, so sweeps read a bucket's *core* alone: its pairs and tokens of two
customers or more, and per token and context how many pairs of one there are.
After every sweep a bucket sends the tables of its core per context to the
contexts' shards, which add them up and answer every bucket that asked; after
the last one they answer for all contexts of all pairs.  Totals are grouped by
context and joined back by context and bucket, and their number grows with the
corpus.  Seating is a function of the counts, the totals, the seating before
and a seed, so a task lost with its executor is repeated exactly.  The driver
gets a few sums per bucket.  Arrays travel byte plane by byte plane, compressed.

*Scoring.*  Every pair of every text has an entry, so all probabilities are
computed once per pair.  Pairs of two customers or more that make up at least
one in ``FREQUENT`` training tokens (at most ``FREQUENT`` of them, the proven
bound under which they are broadcast) are looked up where the text is read; all
other tokens are sent to the group of their bucket, packed, meet the counts and
totals there, one bucket of the group after the other, and come back as one
partial sum per text and group.  Both look the same numbers up.

Word and pair hashes have 64 bits.

Defined cases: NULL text is empty text (one token, the end mark); rows with a
NULL id count as id ``""``; without training texts the base alone scores;
repeated rows get equal scores (and are training texts as often as they
occur); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.chunks import Chunk, chunks, mix
from strata.llm.common import drop, materialize, words

FREQUENT = 1 << 20
BURN_IN = 1
SAMPLES = 3
#: Parties up to this size have their number of tables drawn at once; larger ones
#: are reseated in ``BLOCKS`` blocks a sweep.
EXACT = 1024
BLOCKS = 16
STRENGTH = 1.0
#: Tokens a bucket and a shard are meant to stand for.
BUCKET_TOKENS = 1_000_000
SHARD_TOKENS = 8_000_000
LEAST_BUCKETS = 12
#: Buckets whose tokens are sent together where there are many.
GROUP_BUCKETS = 4
#: Pairs whose probabilities are computed at once.
BLOCK_PAIRS = 1 << 17
#: Text bytes that are cut into tokens at once.
TEXT_BYTES = 1 << 20
#: Entries a counting task gathers before it writes them out.
FLUSH = 4_000_000

_U = np.uint64
END = _U(0xA5F152E3D9C47B17)
_ORDER = _U(0xD6E8FEB86659FD93)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _give_back() -> None:
    """Return freed memory to the system.  Python workers outlive their tasks, and
    the C library keeps much of what these freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _tidy(run):
    """``run``, called on a group's table; what it freed is given back."""

    def tidy(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            _give_back()

    return tidy


def _tidy_batches(run):
    """``run``, called on a task's batches; what it freed is given back."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return tidy


def _heads(ordered: np.ndarray) -> np.ndarray:
    head = np.ones(len(ordered), bool)
    head[1:] = ordered[1:] != ordered[:-1]
    return head


def _sum_pairs(word: np.ndarray, before: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, sorted by token and preceding token, with their counts."""
    order = np.lexsort((before, word))
    word, before, n = word[order], before[order], n[order].astype(np.int64)
    start = np.flatnonzero(_heads(word) | _heads(before))
    return word[start], before[start], np.add.reduceat(n, start) if len(start) else n


# --------------------------------------------------------------------------- tokens


def _tokens(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a chunk, an end mark after each row, and the
    rows' borders."""
    return np.insert(c.hashes, c.rows[1:], END), c.rows + np.arange(len(c) + 1)


def _bucket_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return (((tokens >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)


def _before(tokens: np.ndarray) -> np.ndarray:
    """The token before each one; every row ends with the end mark."""
    before = np.empty_like(tokens)
    before[:1], before[1:] = END, tokens[:-1]
    return before


def _pair_hash(tokens: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mix(tokens * _ORDER + before)


# --------------------------------------------------------------------------- counts


def _count_pairs(buckets: int):
    """Distinct pairs of a task with their counts, one record per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[np.ndarray, ...]]] = [[] for _ in range(buckets)]
        size = 0

        def emptied() -> Iterator[pa.RecordBatch]:
            for b, parts in enumerate(held):
                if parts:
                    word, before, n = _sum_pairs(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                    parts.clear()
                    start = np.flatnonzero(_heads(word))
                    per_word = np.diff(np.append(start, len(word)))
                    contexts, number = np.unique(before, return_inverse=True)
                    row = _row(b, COUNTS, 0, word[start], per_word, number, n, contexts)
                    yield pa.RecordBatch.from_pylist([row], schema=_ROW)

        for c in chunks(batches, lower=True, max_bytes=TEXT_BYTES):
            token, borders = _tokens(c)
            trains = ~c.batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            word, before, n = _sum_pairs(token, _before(token), np.repeat(trains, np.diff(borders)))
            n = _narrow(n)
            # buckets follow the order of tokens
            ends = np.searchsorted(_bucket_of(word, buckets), np.arange(buckets + 1))
            for b in range(buckets):
                mine = slice(ends[b], ends[b + 1])
                if ends[b + 1] > ends[b]:
                    held[b].append((word[mine].copy(), before[mine].copy(), n[mine].copy()))
            size += len(word)
            if size > FLUSH:
                yield from emptied()
                size = 0
        yield from emptied()

    return run


#: What is dealt to buckets and shards: arrays of a kind, from a part.
_ROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("part", pa.int32()), ("data", pa.binary())])
_ROW_SQL = "bucket int, kind int, part int, data binary"
#: Kinds; the seating of sweep ``k`` is ``SEATED + k``, what is asked after it ``ASKED + k + 1``
#: and the answer ``TOTALS + k + 1``; ``ASKED`` and ``TOTALS`` come before the first sweep.
COUNTS, CORE, SUMS, ALL_TOTALS, SEATED, TOTALS, ASKED = 0, 1, 2, 3, 100, 200, 300
_CODEC = pa.Codec("zstd", compression_level=1)


def _narrow(x: np.ndarray) -> np.ndarray:
    """Numbers in as few bytes as their largest needs."""
    return x.astype(np.min_scalar_type(int(x.max()))) if len(x) else x.astype(np.uint8)


def _packed(arrays: Iterable[np.ndarray]) -> bytes:
    """Arrays, byte plane by byte plane, compressed."""
    parts = []
    for x in arrays:
        x = np.ascontiguousarray(x if x.dtype == np.uint64 else _narrow(x))
        parts.append((x.dtype.str, np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)))
    raw = pickle.dumps(parts, 5)
    return len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)


def _unpacked(data: pa.Buffer) -> list[np.ndarray]:
    size = int.from_bytes(data[:8].to_pybytes(), "little")
    return [
        np.ascontiguousarray(planes.T).reshape(-1).view(dtype)
        for dtype, planes in pickle.loads(_CODEC.decompress(data[8:], size))
    ]


def _row(bucket: int, kind: int, part: int, *arrays: np.ndarray) -> dict:
    return {"bucket": bucket, "kind": kind, "part": part, "data": _packed(arrays)}


def _rows(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, int, int, list[np.ndarray]]]:
    for k in range(table.num_rows):
        bucket, kind, part, data = (table.column(x)[k] for x in range(4))
        yield bucket.as_py(), kind.as_py(), part.as_py(), _unpacked(data.as_buffer())


def _merge_counts(table: pa.Table) -> pa.Table:
    parts = [(np.repeat(w, per), contexts[number], n) for _, _, _, (w, per, number, n, contexts) in _rows(table)]
    joined = [np.concatenate(x) for x in zip(*parts, strict=True)]
    del parts
    word, before, n = _sum_pairs(*joined)
    del joined
    start = np.flatnonzero(_heads(word))
    contexts, number = np.unique(before, return_inverse=True)
    bucket = table.column("bucket")[0].as_py()
    return pa.Table.from_pylist(
        [_row(bucket, COUNTS, 0, word[start], np.diff(np.append(start, len(word))), number, n, contexts)], schema=_ROW
    )


# -------------------------------------------------------------------------- seating


def _scatter(count: np.ndarray, first: np.ndarray, last: np.ndarray, weight: np.ndarray,
             rng: np.random.Generator, take: bool = False) -> np.ndarray:
    """Deal ``count`` customers of every party to its tables ``first`` .. ``last``
    by weight, or (``take``) draw them from tables of ``weight`` customers
    without replacement: a multinomial by halving."""
    out = np.zeros(len(weight), np.int64)
    total = np.concatenate([[0], np.cumsum(weight)])
    go = count > 0
    n, a, b = count[go], first[go], last[go]
    while len(n):
        one = b - a == 1
        out[a[one]] += n[one]
        n, a, b = n[~one], a[~one], b[~one]
        mid = (a + b) // 2
        left, right = total[mid] - total[a], total[b] - total[mid]
        k = rng.hypergeometric(left, right, n) if take else rng.binomial(n, left / (left + right))
        n, a, b = np.concatenate([k, n - k]), np.concatenate([a, mid]), np.concatenate([mid, b])
        n, a, b = n[n > 0], a[n > 0], b[n > 0]
    return out


def _parties(who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of tables in party order: the parties, and their borders."""
    first = np.flatnonzero(_heads(who))
    return who[first], first, np.append(first[1:], len(who))


def _in_order(parts: list[tuple[np.ndarray, np.ndarray]], parties: int) -> tuple[np.ndarray, np.ndarray]:
    who, size = (np.concatenate(x) for x in zip(*parts, strict=True))
    return np.bincount(who, minlength=parties).astype(np.int64), size[np.argsort(who, kind="stable")]


def seat(c: np.ndarray, new: np.ndarray, d: float, rng: np.random.Generator, t: np.ndarray | None = None,
         sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Table counts and sizes after seating customers one after the other until
    there are ``c``, from tables ``t`` of ``sizes`` (default: one customer).

    ``new`` is the weight of a new table once all are seated; when ``i`` are, it
    is ``(i / c) ** d`` of that, as those to come prefer full tables.  From the
    17th customer on, blocks of a sixteenth of those seated choose at once.
    """
    t = np.minimum(c, 1) if t is None else t
    who = np.repeat(np.arange(len(c)), t)
    size = np.ones(len(who), np.int64) if sizes is None else sizes.astype(np.int64)
    seated = np.bincount(who, size, minlength=len(c)).astype(np.int64)
    done = []
    while True:
        live = c[who] > seated[who]
        done.append((who[~live], size[~live]))
        who, size = who[live], size[live]
        if not len(who):
            return _in_order(done, len(c))
        party, first, last = _parties(who)
        here = seated[party]
        block = np.minimum(np.maximum(1, here // BLOCKS), c[party] - here)
        opening = new[party] * (here / c[party]) ** d
        opens = rng.binomial(block, opening / (opening + here - d * (last - first)))
        size = size + _scatter(block - opens, first, last, size - d, rng)
        at = np.repeat(last, opens)
        who, size = np.insert(who, at, np.repeat(party, opens)), np.insert(size, at, 1)
        seated[party] += block


def seat_in_order(c: np.ndarray, new: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after seating ``c`` customers one after the other."""
    return seat(c, new, d, rng)[0]


def reseat(c: np.ndarray, t: np.ndarray, new: np.ndarray, d: float, sizes: np.ndarray | None,
           rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """One Gibbs sweep: every customer of every party takes a new seat once.

    ``sizes`` has the tables of all parties in a row (None: one table a party).
    Parties of up to ``BLOCKS`` move one by one, larger ones in ``BLOCKS`` random
    blocks.  Returns the new table counts and sizes.
    """
    who = np.repeat(np.arange(len(c)), t)
    size = c[who].astype(np.int64) if sizes is None else sizes.astype(np.int64)
    old = size.copy()
    done = []
    for k in range(BLOCKS):
        live = c[who] > max(k, 1)
        done.append((who[~live], size[~live]))
        who, size, old = who[live], size[live], old[live]
        if not len(who):
            break
        party, first, last = _parties(who)
        large = c[party] > BLOCKS
        leave = _scatter((~large).astype(np.int64), first, last, old, rng)
        leave += rng.binomial(np.where(np.repeat(large, last - first), old, 0), 1 / (BLOCKS - k))
        size, old = size - leave, old - leave
        gone, tables = np.add.reduceat(leave, first), np.add.reduceat((size > 0).astype(np.int64), first)
        opens = rng.binomial(gone, new[party] / (new[party] + c[party] - 1 - d * tables))
        opens = np.where(tables == 0, np.maximum(opens, 1), opens)
        # who finds all tables gone sits down with those who open one
        joins = np.where(tables == 0, 0, gone - opens)
        size = size + _scatter(joins, first, last, np.where(size > 0, size - d, 0.0), rng)
        at = np.repeat(last, opens)
        heads = np.cumsum(opens) - opens
        fresh = np.ones(len(at), np.int64)
        fresh[heads[tables == 0]] += (gone - opens)[tables == 0]
        who, size, old = np.insert(who, at, np.repeat(party, opens)), np.insert(size, at, fresh), np.insert(old, at, 0)
        who, size, old = who[size > 0], size[size > 0], old[size > 0]
    return _in_order([*done, (who, size)], len(c))


def draw_tables(c: np.ndarray, new: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Table counts of parties of up to ``EXACT`` customers, drawn from where
    Gibbs sweeps lead: ``t`` tables have weight ``new ** t`` times a generalised
    Stirling number, the sum over all seatings at ``t`` tables."""
    t = np.minimum(c, 1).astype(np.int64)
    order = np.argsort(c, kind="stable")
    ends = np.searchsorted(c[order], np.arange(EXACT + 2))
    stirling = np.zeros(1)
    for v in range(2, int(c.max(initial=0)) + 1):
        stay = np.append(stirling + np.log(v - 1 - d * np.arange(1, v)), -np.inf)
        stirling = np.logaddexp(stay, np.append(-np.inf, stirling))
        for at in range(ends[v], ends[v + 1], 1 << 16):
            rows = order[at : min(at + (1 << 16), ends[v + 1])]
            weight = stirling + np.log(new[rows])[:, None] * np.arange(v)
            up_to = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            t[rows] = 1 + (up_to[:, :-1] < rng.random((len(rows), 1)) * up_to[:, -1:]).sum(axis=1)
    return t


def renew(c: np.ndarray, new: np.ndarray, d: float, rng: np.random.Generator, was: np.ndarray | None = None,
          t: np.ndarray | None = None, sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Table counts of all parties after a sweep, and the table sizes of those of
    more than ``EXACT`` customers.

    ``was, t, sizes``: customers, tables and sizes after the sweep before, if
    any; customers have come or gone since where ``c`` differs.
    """
    large = c > EXACT
    out = draw_tables(np.where(large, 0, c), new, d, rng)
    fresh = np.flatnonzero(large if was is None else large & (was <= EXACT))
    parts = [(fresh, np.ones(len(fresh), np.int64))]
    if was is not None:
        # of parties that were large and still are, as many as they are fewer now leave
        who = np.repeat(np.flatnonzero(was > EXACT), t[was > EXACT])
        size = sizes[large[who]].astype(np.int64)
        who = who[large[who]]
        if len(who):
            party, first, last = _parties(who)
            size = size - _scatter(np.maximum(was - c, 0)[party], first, last, size, rng, take=True)
            parts.append((who[size > 0], size[size > 0]))
    n, size = _in_order(parts, len(c))
    n, size = seat(c[large], new[large], d, rng, n[large], size)
    out[large], size = reseat(c[large], n, new[large], d, size, rng)
    return out, size


@dataclass
class Totals:
    """What a sweep needs from all buckets: a number per context and two sums."""

    tables: np.ndarray
    parent_customers: float
    parent_tables: float


@dataclass
class Model:
    """The model as one bucket sees it: ``contexts``, ``customers`` and the
    totals' ``tables`` are those of the contexts that occur in the bucket."""

    contexts: np.ndarray
    customers: np.ndarray
    n_tokens: int
    vocabulary: int
    d_context: float
    d_parent: float
    buckets: int
    seed: int
    #: totals before the first sweep and after each one
    totals: list[Totals]
    #: low bits of a key that number the context; the rest numbers the token
    context_bits: int = 16

    @property
    def base(self) -> float:
        return 1.0 / (self.vocabulary + 1)

    def unseen(self, totals: Totals) -> float:
        """The parent's probability of a token without customers."""
        return (STRENGTH + self.d_parent * totals.parent_tables) / (STRENGTH + totals.parent_customers) * self.base

    def backoff(self, totals: Totals) -> np.ndarray:
        """Per context: the share of probability that comes from the parent."""
        return (STRENGTH + self.d_context * totals.tables) / (STRENGTH + self.customers)


@dataclass
class Seating:
    """One bucket after some sweeps."""

    context: np.ndarray
    word: np.ndarray
    tables: np.ndarray
    parent_customers: np.ndarray
    parent_tables: np.ndarray
    #: table sizes of the large parties, in a row
    sizes: np.ndarray
    parent_sizes: np.ndarray


def _places(m: Model, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = _U(m.context_bits)
    context = (keys & ((_U(1) << bits) - _U(1))).astype(np.int64)
    return context, np.cumsum(_heads(keys >> bits)) - 1


def sweep(m: Model, bucket: int, k: int, context: np.ndarray, word: np.ndarray, n: np.ndarray, ones: np.ndarray,
          before: Seating | None) -> Seating:
    """The bucket's seating after sweep ``k``; pairs without customers have no tables.

    ``ones``: per word, tables of pairs of one customer that are left out.
    """
    totals, rng = m.totals[k], np.random.Generator(np.random.PCG64([m.seed, bucket, k]))
    if before is None:
        tables = np.minimum(n, 1).astype(np.int64)
        guests = _guests(word, tables, ones)
        parent, seated, parent_seated = np.minimum(guests, 1), (), ()
    else:
        tables, guests, parent = before.tables, before.parent_customers, before.parent_tables
        seated, parent_seated = (n, tables, before.sizes), (guests, parent, before.parent_sizes)
    p = (guests - m.d_parent * parent) / (STRENGTH + totals.parent_customers) + m.unseen(totals)
    new = (STRENGTH + m.d_context * totals.tables)[context] * p[word]
    tables, sizes = renew(n, new, m.d_context, rng, *seated)
    guests = _guests(word, tables, ones)
    opening = np.full(len(guests), (STRENGTH + m.d_parent * totals.parent_tables) * m.base)
    parent, parent_sizes = renew(guests, opening, m.d_parent, rng, *parent_seated)
    return Seating(context, word, tables, guests, parent, sizes, parent_sizes)


def _guests(word: np.ndarray, tables: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return ones + np.bincount(word, tables, minlength=len(ones)).astype(np.int64)


def sweeps(m: Model, bucket: int, keys: np.ndarray, n: np.ndarray) -> Iterator[Seating]:
    """The bucket's seating after each sweep that ``m.totals`` allows."""
    s, (context, word) = None, _places(m, keys)
    for k in range(min(len(m.totals), BURN_IN + SAMPLES)):
        s = sweep(m, bucket, k, context, word, n, np.zeros(word.max(initial=-1) + 1, np.int64), s)
        yield s


def _probabilities(m: Model, bucket: int, keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`_averaged` over seatings found by repeating the sweeps."""
    return _averaged(m, n, (s for k, s in enumerate(sweeps(m, bucket, keys, n)) if k >= BURN_IN))


def _averaged(m: Model, n: np.ndarray, seated: Iterable[Seating]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of every pair, averaged over the samples ``seated``; the parent's
    probability of every word of the bucket, per sample; each pair's word."""
    seated = list(seated)
    totals = m.totals[BURN_IN + 1 :][: len(seated)]
    lower = [
        (s.parent_customers - m.d_parent * s.parent_tables) / (STRENGTH + after.parent_customers) + m.unseen(after)
        for s, after in zip(seated, totals, strict=False)
    ]
    backoff = [m.backoff(after) for after in totals]
    context, word = seated[0].context, seated[0].word
    pair = np.zeros(len(n))
    for a in range(0, len(n), BLOCK_PAIRS):
        here = slice(a, a + BLOCK_PAIRS)
        customers = STRENGTH + m.customers[context[here]]
        for s, p, b in zip(seated, lower, backoff, strict=False):
            own = (n[here] - m.d_context * s.tables[here]) / customers
            pair[here] += own + b[context[here]] * p[word[here]]
    return pair / len(lower), np.array(lower), word


# ------------------------------------------------------------------ buckets and shards


@dataclass
class Header:
    """What all buckets know of the model."""

    n_tokens: int
    vocabulary: int
    d_context: float
    d_parent: float
    buckets: int
    shards: int
    #: buckets whose tokens are sent together
    group: int
    seed: int
    #: tokens of one customer
    singles: int
    #: parent customers and parent tables before the first sweep and after each one
    parent: list[tuple[int, int]]

    def model(self, contexts: np.ndarray, customers: np.ndarray, tables: dict[int, np.ndarray]) -> Model:
        """As a bucket of these contexts sees it; ``tables``: by sweep."""
        totals = [Totals(tables.get(k, np.zeros(0)).astype(float), *sums) for k, sums in enumerate(self.parent)]
        return Model(contexts, customers.astype(float), self.n_tokens, self.vocabulary, self.d_context, self.d_parent,
                     self.buckets, self.seed, totals)


def _by_kind(table: pa.Table) -> dict[int, dict[int, dict[int, list[np.ndarray]]]]:
    """Arrays by bucket, kind and part."""
    got: dict[int, dict[int, dict[int, list[np.ndarray]]]] = {}
    for bucket, kind, part, data in _rows(table):
        got.setdefault(bucket, {}).setdefault(kind, {})[part] = data
    return got


def _joined(parts: dict[int, list[np.ndarray]] | None) -> list[np.ndarray]:
    """Answers of all shards, which follow the order of contexts."""
    return [np.concatenate(x).astype(np.int64) for x in zip(*(p for _, p in sorted((parts or {}).items())), strict=True)]


def _first_asks(bucket: int, shards: int, contexts: np.ndarray, *sums: np.ndarray) -> list[dict]:
    """Numbers per context to the shards of the contexts."""
    ends = np.searchsorted(_bucket_of(contexts, shards), np.arange(shards + 1))
    return [
        _row(s, ASKED, bucket, *(x[ends[s] : ends[s + 1]] for x in (contexts, *sums)))
        for s in range(shards) if ends[s + 1] > ends[s]
    ]


class Pairs:
    """A bucket's pairs, from its counts."""

    def __init__(self, words: np.ndarray, per_word: np.ndarray, context: np.ndarray, n: np.ndarray, contexts: np.ndarray):
        self.words, self.contexts = words, contexts
        self.word = np.repeat(np.arange(len(words), dtype=np.int32), per_word)
        self.context, self.n = context, n
        self.customers = np.bincount(self.word, self.n, len(words)).astype(np.int64)
        #: what sweeps may change
        self.moves, self.word_moves = self.n > 1, self.customers > 1

    def per_context(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.context, x, len(self.contexts)).astype(np.int64)

    def core(self) -> tuple[np.ndarray, ...]:
        """Words, their pairs of one customer, their core pairs; contexts and
        customers of these; contexts."""
        word, live = self.word[self.moves], self.word_moves
        ones, pairs = (np.bincount(x, minlength=len(self.words))[live] for x in (self.word[self.n == 1], word))
        used, context = np.unique(self.context[self.moves], return_inverse=True)
        return self.words[live], ones, pairs, context, self.n[self.moves], self.contexts[used]

    def seating(self, core_tables: np.ndarray, core_parent: np.ndarray, *_) -> Seating:
        """Of all pairs, from that of the core."""
        # in the type of the customers, which are as many as tables at least
        tables = np.minimum(self.n, 1)
        tables[self.moves] = core_tables
        guests = _guests(self.word, tables, np.zeros(len(self.words), np.int64))
        parent = np.minimum(guests, 1)
        parent[self.word_moves] = core_parent
        none = np.zeros(0, np.int64)
        return Seating(self.context, self.word, tables, guests, parent, none, none)


class Core:
    """A bucket's core with its totals and seatings, from its rows."""

    def __init__(self, table: pa.Table, h: Header):
        ((self.number, got),) = _by_kind(table).items()
        self.words, ones, per_word, context, n, self.contexts = got[CORE][0]
        self.word = np.repeat(np.arange(len(self.words)), per_word)
        self.ones, self.context, self.n = (x.astype(np.int64) for x in (ones, context, n))
        # a bucket without core pairs has asked for nothing
        single, moving, customers, _ = _joined(got.get(TOTALS)) or [np.zeros(0, np.int64)] * 4
        #: per shard, the steps from each of its contexts here to the next
        self.steps = {shard: p[3] for shard, p in sorted(got.get(TOTALS, {}).items())}
        tables = {0: single + moving}
        for kind in got:
            if TOTALS < kind < ASKED:
                tables[kind - TOTALS] = single + _joined(got[kind])[0]
        self.model = h.model(self.contexts, customers, tables)
        self.seated = {kind - SEATED: self._seating(*p[0]) for kind, p in sorted(got.items()) if SEATED <= kind < TOTALS}

    def asks(self, kind: int, tables: np.ndarray) -> list[dict]:
        """Tables per context to the shards of the contexts, which know them by place."""
        own = np.bincount(self.context, tables, len(self.contexts)).astype(np.int64)
        ends = np.cumsum([0] + [len(x) for x in self.steps.values()])
        return [
            _row(shard, kind, self.number, steps, own[ends[k] : ends[k + 1]])
            for k, (shard, steps) in enumerate(self.steps.items())
        ]

    def _seating(self, tables: np.ndarray, parent: np.ndarray, sizes: np.ndarray, parent_sizes: np.ndarray) -> Seating:
        tables = tables.astype(np.int64)
        return Seating(self.context, self.word, tables, _guests(self.word, tables, self.ones), parent.astype(np.int64),
                       sizes, parent_sizes)


def _start(shards: int):
    """Before the first sweep every pair has one table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, _, _, counts in _rows(batch):
                x = Pairs(*counts)
                types = np.bincount(x.word[x.n > 0], minlength=len(x.words))
                sums = [(x.n > 0).sum(), (types > 0).sum(), (x.n == 1).sum(), (x.n == 2).sum(),
                        (types == 1).sum(), (types == 2).sum(), (x.customers == 1).sum()]
                per_context = [x.per_context(v) for v in (x.n == 1, x.moves, x.n)]
                yield pa.RecordBatch.from_pylist(
                    [_row(bucket, CORE, 0, *x.core()), _row(bucket, SUMS, 0, np.array(sums)),
                     *_first_asks(bucket, shards, x.contexts, *per_context)],
                    schema=_ROW,
                )

    return run


def _places_of(asked: list) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of a shard, from all first asks; each ask's contexts among them, in a row."""
    return np.unique(np.concatenate([d[0] for *_, d in asked]), return_inverse=True)


def _summed(at: np.ndarray, asked: list, i: int, size: int) -> np.ndarray:
    return np.bincount(at, np.concatenate([d[i] for *_, d in asked]), size).astype(np.int64)


def _first_answer(table: pa.Table) -> pa.Table:
    """Sums per context of one shard, for every bucket and the contexts of its
    core, and the steps between their places in the shard."""
    asked = sorted(_rows(table), key=lambda r: r[2])
    contexts, at = _places_of(asked)
    sums = [_summed(at, asked, i, len(contexts)) for i in (1, 2, 3)]
    rows, end = [], 0
    for shard, _, bucket, (own, _, moving, _) in asked:
        begin, end = end, end + len(own)
        if len(core := at[begin:end][moving > 0]):
            rows.append(_row(bucket, TOTALS, shard, *(x[core] for x in sums), np.diff(core, prepend=0)))
    return pa.Table.from_pylist(rows, schema=_ROW)


def _answer(step: int):
    """Tables per context of one shard, for every bucket that asked."""

    def run(table: pa.Table) -> pa.Table:
        asked = sorted(_rows(table), key=lambda r: r[2])
        places = [np.cumsum(steps, dtype=np.int64) for *_, (steps, _) in asked]
        sums = _summed(np.concatenate(places), asked, 1, 0)
        return pa.Table.from_pylist(
            [_row(bucket, TOTALS + step, shard, sums[at]) for at, (shard, _, bucket, _) in zip(places, asked, strict=True)],
            schema=_ROW,
        )

    return run


def _answer_all(table: pa.Table) -> pa.Table:
    """Customers per context of one shard, and its tables in every sample, for
    every bucket and all its contexts."""
    got = sorted(_rows(table), key=lambda r: (r[1], r[2]))
    asked = [r for r in got if r[1] == ASKED]
    contexts, at = _places_of(asked)
    ones, customers = (_summed(at, asked, i, len(contexts)) for i in (1, 3))
    columns = [customers, *(ones.copy() for _ in range(SAMPLES))]
    for _, kind, _, data in got[len(asked) :]:
        columns[kind - ASKED - BURN_IN][np.cumsum(data[0], dtype=np.int64)] += data[1].astype(np.int64)
    cut = np.cumsum([0] + [len(d[0]) for *_, d in asked])
    return pa.Table.from_pylist(
        [_row(bucket, ALL_TOTALS, shard, *(x[at[cut[k] : cut[k + 1]]] for x in columns))
         for k, (shard, _, bucket, _) in enumerate(asked)],
        schema=_ROW,
    )


def _sweep(shared, k: int):
    def run(table: pa.Table) -> pa.Table:
        h = shared.value
        x = Core(table, h)
        s = sweep(x.model, x.number, k, x.context, x.word, x.n, x.ones, x.seated.get(k - 1))
        return pa.Table.from_pylist(
            [_row(x.number, SEATED + k, 0, s.tables, s.parent_tables, s.sizes, s.parent_sizes),
             *x.asks(ASKED + k + 1, s.tables),
             _row(x.number, SUMS, 0, np.array([s.parent_customers.sum(), s.parent_tables.sum()]))],
            schema=_ROW,
        )

    return run


def _frequent_pairs(shared):
    """Core pairs with at least one in ``FREQUENT`` training tokens, scored."""

    def run(table: pa.Table) -> pa.Table:
        h = shared.value
        x = Core(table, h)
        p, _, _ = _averaged(x.model, x.n, x.seated.values())
        count = x.ones + np.bincount(x.word, x.n, len(x.words)).astype(np.int64)
        often = x.n * FREQUENT >= h.n_tokens
        word = x.word[often]
        key = _pair_hash(x.words[word], x.contexts[x.context[often]])
        return pa.table({
            "bucket": pa.array(np.full(len(key), x.number, np.int64)), "key": pa.array(key.view(np.int64)),
            "score": pa.array(np.log10(p[often])), "base": pa.array(_base(h, count[word])),
        })

    return run


def _sums(df: DataFrame) -> list[int]:
    """The buckets' sums, added up: a few numbers per bucket."""
    rows = [_unpacked(pa.py_buffer(r["data"]))[0] for r in df.where(F.col("kind") == SUMS).select("data").collect()]
    return [sum(map(int, x)) for x in zip(*rows, strict=True)]


def _estimate(once: int, twice: int) -> float:
    """Discount from the counts of counts."""
    return float(np.clip(once / max(1, once + 2 * twice), 0.05, 0.95))


@dataclass
class Learned:
    """The model: its header; cores, totals and seatings of the samples, from
    which frequent pairs are scored; counts, totals of all contexts and
    seatings, from which all pairs are; tables that ``core`` alone reads."""

    header: Header
    core: DataFrame
    pairs: DataFrame
    of_core: list[DataFrame]


def learn(texts: DataFrame, n_tokens: int, seed: int = 1) -> Learned:
    """The model of the training texts among ``texts`` (``held_out, text``), with
    all pairs of ``texts``."""
    spark = texts.sparkSession
    buckets, shards = (max(LEAST_BUCKETS, -(-n_tokens // x)) for x in (BUCKET_TOKENS, SHARD_TOKENS))
    counts = materialize(
        texts.mapInArrow(_tidy_batches(_count_pairs(buckets)), _ROW_SQL).groupBy("bucket").applyInArrow(_tidy(_merge_counts), _ROW_SQL),
        "lm-counts",
    )

    def union(frames: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, frames)

    def of_kind(rows: DataFrame, kind: int) -> DataFrame:
        return rows.where(F.col("kind") == kind)

    def answers(asked: DataFrame, answer) -> DataFrame:
        return materialize(asked.groupBy("bucket").applyInArrow(_tidy(answer), _ROW_SQL), "lm-totals")

    start = materialize(counts.mapInArrow(_tidy_batches(_start(shards)), _ROW_SQL), "lm-start")
    pairs, types, n1, n2, m1, m2, singles = _sums(start) or [0] * 7
    group = max(1, min(GROUP_BUCKETS, buckets // LEAST_BUCKETS))
    h = Header(n_tokens, types, _estimate(n1, n2), _estimate(m1, m2), buckets, shards, group, seed, singles, [(pairs, types)])
    asked = [of_kind(start, ASKED)]
    core = [of_kind(start, CORE), answers(asked[0], _first_answer)]
    last, seated, totals = [], [], []
    for k in range(BURN_IN + SAMPLES):
        shared = spark.sparkContext.broadcast(h)
        swept = materialize(union(core + last).groupBy("bucket").applyInArrow(_tidy(_sweep(shared, k)), _ROW_SQL), "lm-sweep")
        h = replace(h, parent=[*h.parent, tuple(x + singles for x in _sums(swept) or (0, 0))])
        ask = of_kind(swept, ASKED + k + 1)
        last = [answers(ask, _answer(k + 1)), of_kind(swept, SEATED + k)]
        if k >= BURN_IN:
            asked.append(ask)
            totals.append(last[0])
            seated.append(last[1])
    everywhere = answers(union(asked), _answer_all)
    return Learned(h, union(core + totals + seated), union([counts, everywhere, *seated]), [start, core[1], *totals])


# -------------------------------------------------------------------------- scoring


def _base(h: Header, count: np.ndarray) -> np.ndarray:
    return np.log10((count + 1.0) / (h.n_tokens + h.vocabulary + 1.0))


@dataclass
class Frequent:
    """Scored pairs, sorted by key within each group of buckets."""

    keys: list[np.ndarray]
    score: list[np.ndarray]
    base: list[np.ndarray]


_SENT = pa.schema(
    [("bucket", pa.int32()), ("rows", pa.binary()), ("counts", pa.binary()), ("keys", pa.binary()), ("sums", pa.binary())]
)
_SUMS = np.dtype([("known", "<i8"), ("base", "<f8"), ("score", "<f8")])


def _send(shared, scored):
    """Score frequent pairs; send the other tokens to the groups of their buckets.

    A record has a chunk's tokens in the order of buckets, and how many of each
    text (``rows``) are in each bucket of the group.  Sums of the scored tokens
    ride along in a group of the row's own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, known = shared.value, scored.value
        for c in chunks(batches, lower=True, max_bytes=TEXT_BYTES):
            token, borders = _tokens(c)
            rows = c.batch.column("row_key").to_numpy(zero_copy_only=False)
            key, bucket = _pair_hash(token, _before(token)), _bucket_of(token, h.buckets)
            row = np.repeat(np.arange(len(c)), np.diff(borders))
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(len(known.keys) + 1) * h.group)
            done = np.zeros(len(c), _SUMS)
            out = []
            for g in range(len(known.keys)):
                mine = order[ends[g] : ends[g + 1]]
                k, r, b = key[mine], row[mine], bucket[mine] - g * h.group
                if len(known.keys[g]) and len(k):
                    at = np.minimum(np.searchsorted(known.keys[g], k), len(known.keys[g]) - 1)
                    hit = known.keys[g][at] == k
                    done["known"] += np.bincount(r[hit], minlength=len(c))
                    done["base"] += np.bincount(r[hit], known.base[g][at[hit]], minlength=len(c))
                    done["score"] += np.bincount(r[hit], known.score[g][at[hit]], minlength=len(c))
                    k, r, b = k[~hit], r[~hit], b[~hit]
                if len(k):
                    counts = np.bincount(b * len(c) + r, minlength=h.group * len(c)).reshape(h.group, len(c))
                    some = np.flatnonzero(counts.any(axis=0))
                    out.append({
                        "bucket": g,
                        "rows": rows[some].tobytes(),
                        "counts": _narrow(counts[:, some].reshape(-1)).tobytes(),
                        "keys": k.tobytes(),
                        "sums": b"",
                    })
            out.append({"bucket": int(c.batch.column("spread")[0].as_py()), "rows": rows.tobytes(), "counts": b"",
                        "keys": b"", "sums": done.tobytes()})
            yield pa.RecordBatch.from_pylist(out, schema=_SENT)

    return run


@dataclass
class Sent:
    """A record of :func:`_send`: texts, their tokens by bucket, and the sums so far."""

    rows: np.ndarray
    counts: np.ndarray
    keys: np.ndarray
    sums: np.ndarray

    @staticmethod
    def read(rows: pa.Buffer, counts: pa.Buffer, keys: pa.Buffer, sums: pa.Buffer, group: int) -> Sent:
        who = np.frombuffer(rows, np.int64)
        if sums.size:
            return Sent(who, np.zeros((group, 0), np.uint8), np.zeros(0, np.uint64), np.frombuffer(sums, _SUMS))
        n = np.frombuffer(counts, f"u{counts.size // (group * len(who))}").reshape(group, len(who))
        return Sent(who, n, np.frombuffer(keys, np.uint64), np.zeros(len(who), _SUMS))

    def add(self, place: int, scorer: Scorer) -> None:
        """Sums of the tokens in one bucket of the group."""
        texts = np.flatnonzero(self.counts[place])
        n = self.counts[place][texts].astype(np.int64)
        begin = int(self.counts[:place].sum(dtype=np.int64))
        one = scorer.look_up(self.keys[begin : begin + int(n.sum())])
        for f in _SUMS.names:
            self.sums[f][texts] += np.add.reduceat(one[f], np.cumsum(n) - n)


class Scorer:
    """Looks tokens up among the pairs of a bucket."""

    def __init__(self, h: Header, table: pa.Table):
        """Hash, log10 probability and the token's count of the bucket's pairs."""
        self.h = h
        ((_, got),) = _by_kind(table).items()
        x = Pairs(*got[COUNTS][0])
        customers, *tables = _joined(got[ALL_TOTALS])
        model = h.model(x.contexts, customers, dict(enumerate(tables, BURN_IN + 1)))
        seated = (x.seating(*p[0]) for kind, p in sorted(got.items()) if SEATED <= kind < TOTALS)
        score = np.log10(_averaged(model, x.n, seated)[0])
        keys = np.empty(len(x.n), np.uint64)
        for a in range(0, len(keys), BLOCK_PAIRS):
            here = slice(a, a + BLOCK_PAIRS)
            keys[here] = _pair_hash(x.words[x.word[here]], x.contexts[x.context[here]])
        order = np.argsort(keys)
        self.keys, self.score, self.count = keys[order], score[order], x.customers[x.word[order]]

    def look_up(self, key: np.ndarray) -> np.ndarray:
        """Known or not, base and model log10 probability of every token."""
        at = np.searchsorted(self.keys, key)
        out = np.zeros(len(key), _SUMS)
        out["known"], out["score"], out["base"] = self.count[at] > 0, self.score[at], _base(self.h, self.count[at])
        return out


def _scored(h: Header, sent: pa.Table, pairs: pa.Table) -> pa.Table:
    """One group of buckets, one bucket after the other: a partial sum per text, record after record."""
    records = [
        Sent.read(*(sent.column(x)[k].as_buffer() for x in ("rows", "counts", "keys", "sums")), h.group)
        for k in range(sent.num_rows)
    ]
    for place in range(h.group):
        asking = [r for r in records if r.counts[place].any()]
        if asking:
            here = pc.equal(pairs.column("bucket"), sent.column("bucket")[0].as_py() * h.group + place)
            scorer = Scorer(h, pairs.filter(here))
            _give_back()
            for r in asking:
                r.add(place, scorer)
    rows = np.concatenate([np.zeros(0, np.int64), *(r.rows for r in records)])
    return pa.table({"row_key": pa.array(rows)} | {
        f: pa.array(np.concatenate([np.zeros(0, _SUMS[f]), *(r.sums[f] for r in records)])) for f in _SUMS.names
    })


def _score_group(shared):
    def run(sent: pa.Table, pairs: pa.Table) -> pa.Table:
        try:
            return _scored(shared.value, sent, pairs)
        finally:
            _give_back()

    return run


def score(docs: DataFrame, seed: int = 1) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity`` of every row of ``docs``."""
    spark = docs.sparkSession
    texts = docs.select(
        F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("row_key"),
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    about = materialize(
        texts.select("row_key", "doc_id", "held_out", (F.size(words(F.col("text"))) + 1).cast("long").alias("n_tokens")),
        "lm-texts",
    )
    n_tokens = about.where(~F.col("held_out")).agg(F.sum("n_tokens")).first()[0] or 0
    learned = learn(texts.select("held_out", "text"), n_tokens, seed)
    h = learned.header
    groups = -(-h.buckets // h.group)
    shared = spark.sparkContext.broadcast(h)

    often = learned.core.groupBy("bucket").applyInArrow(
        _tidy(_frequent_pairs(shared)), "bucket long, key long, score double, base double"
    ).toArrow()
    for spent in learned.of_core:
        drop(spent)
    bucket, key, logp, base = (often.column(x).to_numpy() for x in ("bucket", "key", "score", "base"))
    key, group = key.view(np.uint64), bucket // h.group
    order = np.lexsort((key, group))
    cut = np.searchsorted(group[order], np.arange(groups + 1))
    parts = [order[cut[g] : cut[g + 1]] for g in range(groups)]
    scored = spark.sparkContext.broadcast(Frequent(*([x[o] for o in parts] for x in (key, logp, base))))

    sent = texts.select(
        "row_key", "text", F.pmod("row_key", F.lit(groups)).cast("int").alias("spread")
    ).mapInArrow(_tidy_batches(_send(shared, scored)), "bucket int, rows binary, counts binary, keys binary, sums binary")
    partial = (
        sent.groupBy("bucket")
        .cogroup(learned.pairs.withColumn("group", F.floor(F.col("bucket") / h.group).cast("int")).groupBy("group"))
        .applyInArrow(_score_group(shared), "row_key long, known long, base double, score double")
    )
    # equal rows share a key: their sums come together and are told apart again
    rows = about.groupBy(F.col("row_key").alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    sums = partial.groupBy("row_key").agg(*(F.sum(x).alias(x) for x in ("known", "base", "score")))
    sums = sums.join(rows, F.col("row_key") == F.col("_key")).select(
        "_key", (F.col("known") / F.col("_rows")).cast("long").alias("n_known"), *(
            (F.col(x) / F.col("_rows")).alias(y) for x, y in (("base", "base_score"), ("score", "score"))
        )
    )
    return about.join(sums, F.col("row_key") == F.col("_key")).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
