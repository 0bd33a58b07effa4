"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is the mean of the embeddings of its byte n-grams (lengths ``NGRAMS``,
never reaching over a word border), hashed to ``BUCKETS`` rows; a linear
softmax on that mean gives the language.  Both layers are trained together by
stochastic gradient descent in numpy on at most ``max_train`` labelled texts
(the ones with the smallest seeded hash, of each language first, so that none
with labelled texts is left out; only their hashed n-gram counts reach the
driver).  A fifth of them is held back: a temperature fitted there
calibrates the probabilities, and the smallest confidence at which the
accepted held-back texts reach ``target`` accuracy becomes the rejection level.

Because the model is linear in the mean, prediction needs one score per
n-gram and language, looked up and averaged over the whole text.

Defined cases: a NULL text or one without any letter is ``und`` with score 0;
without labelled texts every text is; rows with a NULL ``doc_id`` count as id
``""``; repeated rows get equal results; a text whose n-grams are all unknown
gets the prior; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.chunks import mix
from strata.llm.common import materialize

NGRAMS = (2, 3, 4)
BUCKETS = 1 << 16
DIMENSIONS = 16
#: Upper bound of texts the model is trained on (documented parameter).
MAX_TRAIN = 2_000
#: Every language has one in so many places of the sample, if it has the texts.
LEAST_SHARE = 20
UNKNOWN = "und"

_U = np.uint64
# letters and bytes of multi-byte characters stay, everything else is a border
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 256)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For some texts: hashed n-grams of one length and the text of each."""
    lower = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    _, offsets, values = lower.buffers()
    cuts = np.frombuffer(offsets, np.int64)[lower.offset : lower.offset + len(lower) + 1]
    raw = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    data = _FOLD[raw[cuts[0] : cuts[-1]]]
    cuts = cuts - cuts[0]
    border = data == 0x20
    wide = data.astype(np.uint64)
    row = np.repeat(np.arange(len(lower)), np.diff(cuts))
    for n in NGRAMS:
        size = len(data) - n + 1
        if size <= 0:
            continue
        ok = row[:size] == row[n - 1 :]
        code = np.full(size, n, np.uint64)
        for k in range(n):
            code = code * _U(257) + wide[k : k + size]
            if 0 < k < n - 1:
                ok &= ~border[k : k + size]
        ok &= ~(border[:size] & border[n - 1 :])
        yield (mix(code[ok]) & _U(BUCKETS - 1)).astype(np.int64), row[:size][ok]


def _pieces(batches: Iterator[pa.RecordBatch], max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + max_bytes, "right")))
            yield batch.slice(at, end - at)
            at = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket counts of each text, as arrays."""
    for piece in _pieces(batches):
        rows: list[list[np.ndarray]] = [[] for _ in range(piece.num_rows)]
        for code, row in _grams(piece.column("text")):
            ends = np.searchsorted(row, np.arange(piece.num_rows + 1))
            for r in range(piece.num_rows):
                rows[r].append(code[ends[r] : ends[r + 1]])
        found = [np.unique(np.concatenate(r) if r else np.zeros(0, np.int64), return_counts=True) for r in rows]
        yield pa.record_batch(
            [piece.column("h"), piece.column("lang"),
             pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
             pa.array([f[1].astype(np.int32) for f in found], pa.list_(pa.int32()))],
            names=["h", "lang", "bucket", "n"],
        )


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    #: score of every bucket and language
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = (logits + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def mean_scores(self, texts: pa.Array) -> np.ndarray:
        total = np.zeros((len(texts), len(self.languages)))
        count = np.zeros(len(texts))
        for code, row in _grams(texts):
            count += np.bincount(row, minlength=len(texts))
            for k in range(len(self.languages)):
                total[:, k] += np.bincount(row, self.scores[code, k], minlength=len(texts))
        return total / np.maximum(count, 1)[:, None]


def fit(
    samples: list[tuple[str, np.ndarray, np.ndarray]],
    epochs: int = 12,
    rate: float = 2.0,
    target: float = 0.98,
    seed: int = 3,
) -> LanguageModel | None:
    """Train on ``(language, buckets, counts)`` samples; every fifth calibrates."""
    if not samples:
        return None
    languages = tuple(sorted({s[0] for s in samples}))
    number = {name: k for k, name in enumerate(languages)}
    rng = np.random.Generator(np.random.PCG64(seed))
    embed = rng.normal(0.0, 0.1, (BUCKETS, DIMENSIONS))
    weight, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    weight += rng.normal(0.0, 0.1, weight.shape)
    train = [s for k, s in enumerate(samples) if k % 5 or len(samples) < 10]
    # a language all of whose texts would be held back is trained on them instead
    missing = set(languages) - {s[0] for s in train}
    train += [s for s in samples if s[0] in missing]
    held = [s for k, s in enumerate(samples) if k % 5 == 0 and s[0] not in missing] or train
    steps = epochs * len(train)
    for step in range(steps):
        if step % len(train) == 0:
            order = rng.permutation(len(train))
        name, at, n = train[order[step % len(train)]]
        if not len(at):
            continue
        eta = rate * (1 - step / steps)
        share = n / n.sum()
        hidden = share @ embed[at]
        z = hidden @ weight + bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[number[name]] -= 1.0
        back = weight @ p
        weight -= eta * np.outer(hidden, p)
        bias -= eta * 0.01 * p
        embed[at] -= eta * np.outer(share, back)
    scores = embed @ weight
    logits = np.array([(n @ scores[at]) / max(n.sum(), 1) for _, at, n in held])
    truth = np.array([number[s[0]] for s in held])

    def loss(t: float) -> float:
        z = (logits + bias) / t
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]).mean())

    temperature = min(np.geomspace(0.05, 20.0, 80), key=loss)
    model = LanguageModel(languages, scores.astype(np.float32), bias, float(temperature), 0.0)
    p = model.probabilities(logits)
    sure, right = p.max(axis=1), p.argmax(axis=1) == truth
    order = np.argsort(-sure)
    good = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= target
    level = float(sure[order][np.flatnonzero(good).max()]) if good.any() else 1.0
    return LanguageModel(languages, model.scores, bias, float(temperature), level)


def learn(docs: DataFrame, max_train: int = MAX_TRAIN, seed: int = 3) -> LanguageModel | None:
    """Fit on labelled, not held-out documents."""
    known = docs.where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    ).select(F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"), "lang", "text")
    each = materialize(known.groupBy("h").agg(F.min("lang").alias("_l")), "lang-hashes")
    # the first few of every language go before all others
    least = max(1, max_train // LEAST_SHARE)
    rank = F.row_number().over(Window.partitionBy("_l").orderBy("h"))
    first = each.withColumn("_k", rank).where(F.col("_k") <= least).select("h", "_k")
    others = each.orderBy("h").limit(max_train).select("h", F.lit(least + 1).alias("_k"))
    chosen = first.unionByName(others).groupBy("h").agg(F.min("_k").alias("_k")).orderBy("_k", "h").limit(max_train)
    chosen = materialize(chosen.select(F.col("h").alias("_h")), "lang-sample")
    texts = known.join(F.broadcast(chosen), F.col("h") == F.col("_h")).select("h", "lang", "text").dropDuplicates(["h"])
    rows = texts.mapInArrow(_counted, "h long, lang string, bucket array<int>, n array<int>").toArrow()
    rows = rows.sort_by("h").to_pydict()
    samples = [
        (lang, np.array(at, np.int64), np.array(n, np.float64))
        for lang, at, n in zip(rows["lang"], rows["bucket"], rows["n"], strict=True)
    ]
    return fit(samples, seed=seed)


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every row."""
    thin = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    if model is None:
        none = thin.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
        return none.withColumn("rejected", F.lit(True))
    # one score per bucket and language: a fixed size, whatever the corpus
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for piece in _pieces(batches):
            p = m.probabilities(m.mean_scores(piece.column("text")))
            best = p.argmax(axis=1)
            score = p[np.arange(len(p)), best]
            written = np.array(
                [t is not None and any(map(str.isalpha, t)) for t in piece.column("text").to_pylist()], bool
            )
            names = [m.languages[k] if ok else UNKNOWN for k, ok in zip(best, written, strict=True)]
            score = np.where(written, score, 0.0)
            yield pa.record_batch(
                [piece.column("doc_id"), piece.column("held_out"), pa.array(names, pa.string()), pa.array(score),
                 pa.array(~written | (score < m.reject_below))],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    kind = thin.schema["doc_id"].dataType.simpleString()
    return thin.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
