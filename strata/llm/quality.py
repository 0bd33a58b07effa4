"""Quality rules as a learned decision list (sequential covering).

``text_statistics`` computes, with built-in functions only, interpretable
statistics of each whole text.  ``fit_decision_list`` grows and prunes threshold
conjunctions on labelled statistics, and ``DecisionList.verdict`` emits them
as one ordered Spark conditional expression.

Defined cases: a NULL or blank text has zero words and all statistics zero;
rows whose label or text is missing, and documents with contradicting labels,
teach nothing; without any label (or without both classes) the list is empty
and keeps every document that passes the base rules; repeated rows are judged
one by one, alike; columns other than the id and the text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialize, words

#: Upper bound of labelled rows the list is learned from (documented parameter).
MAX_LABELLED = 20_000

FEATURES = (
    "n_words",
    "mean_word",
    "symbol_rate",
    "dup_line_rate",
    "repeat_rate",
    "upper_rate",
    "bang_rate",
    "distinct_rate",
    "bar_rate",
    "line_words",
)


def _sorted_windows(grams: str) -> Column:
    """Window hashes of the array column ``grams`` sorted with their positions.

    NULL when no window repeats, which spares most short texts the sort.
    """
    g = F.col(grams)
    pairs = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(g)) < F.size(g), pairs)


def text_statistics(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Base counts and the learner's features of every row of ``docs.text``.

    No shuffle: everything is computed inside the row, beside the columns
    named in ``carry``.  Windows are compared by their 64-bit hash within one
    text.
    """
    blankless = r"[^\x20\x09-\x0D]"
    docs_cols = [f"_in.{c}" for c in carry]
    base = docs.select(F.struct(*carry).alias("_in"), F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    cut = base.select(
        "_in",
        "_t",
        words(F.col("_t")).alias("_w"),
        F.filter(F.split("_t", "\n", -1), lambda line: line.rlike(blankless)).alias("_l"),
    )
    grams = cut.select(
        "*",
        F.size("_w").cast("long").alias("n_words"),
        F.when(
            F.size("_w") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.size("_w") - 3, F.lit(0))),
                lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)),
            ),
        ).alias("_g"),
    )
    # equal neighbours among the sorted windows are the repeated ones; each
    # covers three words, less what the next repeated window covers too
    paired = grams.withColumn("_s", _sorted_windows("_g"))
    repeated = paired.withColumn(
        "_p",
        F.sort_array(
            F.transform(
                F.filter(
                    "_s",
                    lambda x, i: ((i > 0) & (F.get("_s", i - 1)["h"] == x["h"]))
                    | F.coalesce(F.get("_s", i + 1)["h"] == x["h"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    )
    covered = F.aggregate(
        F.transform("_p", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_p", k + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda acc, x: acc + x,
    )

    def count(pattern: str) -> Column:
        return F.length(F.regexp_replace("_t", pattern, "")).cast("long")

    counted = repeated.select(
        "_in",
        "n_words",
        F.length(F.concat_ws("", "_w")).cast("long").alias("word_chars"),
        count(r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("_lines"),
        count(r"[^\p{Lu}]+").alias("_upper"),
        count(r"[^!]+").alias("_bangs"),
        count(r"[^|]+").alias("_bars"),
        F.size(F.array_distinct("_w")).cast("long").alias("_distinct"),
    )
    per_word = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    features = F.struct(
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("word_chars") / per_word).alias("mean_word"),
        (F.col("n_symbols") / per_word).alias("symbol_rate"),
        (F.col("n_dup_lines") / F.greatest("_lines", F.lit(1))).alias("dup_line_rate"),
        (F.col("n_repeat_words") / per_word).alias("repeat_rate"),
        (F.col("_upper") / F.greatest(F.col("word_chars"), F.lit(1))).alias("upper_rate"),
        (F.col("_bangs") / per_word).alias("bang_rate"),
        (F.col("_distinct") / per_word).alias("distinct_rate"),
        (F.col("_bars") / per_word).alias("bar_rate"),
        (F.col("n_words") / F.greatest("_lines", F.lit(1))).alias("line_words"),
    )
    # A filter on the statistics must not be pushed below them, where it would
    # be rewritten into nested expressions that are evaluated per element: it
    # cannot pass a generator whose output it reads.
    return counted.select(*docs_cols, F.inline(F.array(features)))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature).cast("double")
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def mask(self, stats: dict[str, np.ndarray]) -> np.ndarray:
        v = stats[self.feature]
        return v > self.threshold if self.above else v <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered conjunctions; the first that holds rejects, otherwise keep."""

    rules: tuple[tuple[Condition, ...], ...] = field(default=())

    def rule_number(self) -> Column:
        """Number (from 1) of the first rule that holds, else NULL."""
        out = None
        for k, rule in enumerate(self.rules, 1):
            hit = rule[0].column()
            for cond in rule[1:]:
                hit = hit & cond.column()
            out = F.when(hit, F.lit(k)) if out is None else out.when(hit, F.lit(k))
        return F.lit(None).cast("int") if out is None else out

    def verdict(self) -> Column:
        """True where the document is kept."""
        return self.rule_number().isNull()


def _precision(p: float, n: float) -> float:
    return p / (p + n) if p + n else 0.0


def fit_decision_list(
    stats: dict[str, np.ndarray],
    bad: np.ndarray,
    prune_part: np.ndarray,
    max_rules: int = 12,
    max_conditions: int = 4,
    cuts: int = 24,
    min_support: int = 3,
    min_precision: float = 0.95,
) -> DecisionList:
    """Sequential covering.

    ``bad`` marks the rows to reject, ``prune_part`` the rows held back for
    pruning.  Each round grows one conjunction by information gain on the
    growing part, drops trailing conditions while that does not lower its worth on
    the pruning part, accepts it if its precision over both parts reaches
    ``min_precision`` and removes the rows it covers.
    """
    literals: list[Condition] = []
    for f in stats:
        v = stats[f][bad]
        if not len(v):
            return DecisionList()
        for q in np.unique(np.quantile(v, np.linspace(0.0, 1.0, cuts), method="lower")):
            others = stats[f]
            for above in (True, False):
                # cut half-way to the next value on the other side of the literal
                beyond = others[others < q] if above else others[others > q]
                edge = (q + (beyond.max() if above else beyond.min())) / 2 if len(beyond) else q
                if len(beyond):
                    literals.append(Condition(f, above, float(edge)))
    if not literals:
        return DecisionList()
    held = np.column_stack([c.mask(stats) for c in literals])
    grow, left = ~prune_part, np.ones(len(bad), bool)
    rules: list[tuple[Condition, ...]] = []
    while len(rules) < max_rules:
        inside, chosen = left & grow, []
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        if p0 < min_support:
            break
        while len(chosen) < max_conditions and n0 > 0:
            p = held[inside & bad].sum(axis=0)
            n = held[inside & ~bad].sum(axis=0)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -1.0)
            best = int(np.argmax(gain))
            if gain[best] <= 1e-9 or p[best] < min_support:
                break
            chosen.append(best)
            inside = inside & held[:, best]
            p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        if not chosen:
            break

        def worth(lits: list[int]) -> float:
            hit = left & prune_part & held[:, lits].all(axis=1)
            p, n = (hit & bad).sum(), (hit & ~bad).sum()
            return (p - n) / (p + n) if p + n else 0.0

        while len(chosen) > 1 and worth(chosen[:-1]) >= worth(chosen):
            chosen = chosen[:-1]
        hit = left & held[:, chosen].all(axis=1)
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        if p < min_support or _precision(p, n) < min_precision:
            break
        rules.append(tuple(literals[k] for k in chosen))
        left &= ~hit
    return DecisionList(tuple(rules))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = MAX_LABELLED,
    seed: int = 9,
    **fit: float,
) -> DecisionList:
    """Learn the list from at most ``max_labelled`` labelled documents.

    The sample is the labelled ids with the smallest seeded hash.  Only their
    statistics (a few numbers a row, so a bounded table) reach the driver.
    """
    ids = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_q"), F.max("quality").alias("_q2"))
        .where(F.col("_q") == F.col("_q2"))
        .select(F.col("doc_id").alias("_id"), "_q", F.xxhash64(F.lit(seed), "doc_id").alias("_h"))
        .orderBy("_h", "_id")
        .limit(max_labelled)
    )
    ids = materialize(ids, "quality-labels")
    known = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
    stats = text_statistics(known.where(F.col("text").isNotNull())).where(~base_failed())
    rows = (
        # of rows that repeat an id, the one with the smallest statistics
        stats.groupBy("doc_id")
        .agg(F.min(F.struct(*FEATURES)).alias("_f"))
        .select("doc_id", "_f.*")
        .join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
        .select("_h", "_q", *(F.col(f).cast("double").alias(f) for f in FEATURES))
        .collect()
    )
    if not rows:
        return DecisionList()
    rows.sort(key=lambda r: r["_h"])
    bad = np.array([r["_q"] == 0 for r in rows])
    held_back = np.array([r["_h"] % 3 == 0 for r in rows])
    return fit_decision_list({f: np.array([r[f] for r in rows]) for f in FEATURES}, bad, held_back, **fit)


def judge(docs: DataFrame, rules: DecisionList, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Base counts, base verdict, matching rule and ``kept`` of every row."""
    return text_statistics(docs, carry).select(
        *carry,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        rules.rule_number().alias("rule"),
        (~base_failed() & rules.verdict()).alias("kept"),
    )


def keep(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """The rows of ``docs`` that pass, unchanged."""
    rows = docs.select(F.struct("*").alias("_row"), F.col("text"))
    return judge(rows, rules, ("_row",)).where("kept").select("_row.*")
