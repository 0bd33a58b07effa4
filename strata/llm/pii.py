"""Personal-data spans: fixed patterns plus a weakly supervised classifier.

Base spans (``email``, ``ip``, ``card``, ``phone``) follow fixed patterns and
checks.  Further spans of kind ``secret`` (keys, tokens, passwords) are found
by weak supervision: every candidate, a long run of letters and digits, gets
the votes of regex, gazetteer, context and shape labelers;
expectation-maximisation over the counts of vote patterns estimates how
reliable each labeler is, without any labelled data; the resulting
probabilities train a logistic classifier of interpretable span features, which
becomes one Spark expression.

All counts cover all documents.  What reaches the driver is bounded by
construction: at most ``3 ** len(LABELERS)`` vote patterns and
``2 ** len(FEATURES)`` feature patterns.

Positions are code points, end exclusive.  The patterns below are rewritten so
that no text makes them backtrack (possessive runs; a run is entered at its
start or where the last match ended), which leaves their matches unchanged.

Defined cases: NULL text is empty text (``redact`` leaves it NULL); without
candidates, or where the classifier finds none likely, only base spans are
reported; repeated rows are judged one by one, alike; other columns are
carried or ignored as the caller names them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialize

KINDS = ("email", "ip", "card", "phone", "secret")
_LOCAL, _DIGIT, _TOKEN = r"[A-Za-z0-9._%+-]", "[0-9]", r"[A-Za-z0-9_/+-]"

# Words that announce a secret.
GAZETTEER = ("password", "passwd", "pwd", "token", "secret", "apikey", "api_key", "access_key", "auth", "credential")
_WORDS = "|".join(GAZETTEER)
#: An announcing word and an assignment, as they stand right before a value.
_ASSIGNED = rf"(?i:{_WORDS})s?[\x20\"']{{0,2}}[=:][\x20\"']{{0,2}}"
# cheap first: something assigned, then what to
_AFTER_ANNOUNCEMENT = rf"(?<=[=:]|[=:][\x20\"']|[=:][\x20\"'][\x20\"'])(?<={_ASSIGNED})"


def _run_start(chars: str) -> str:
    return rf"(?:(?<!{chars})|\G)"


PATTERNS = {
    "email": _run_start(_LOCAL) + _LOCAL + r"++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _run_start(_DIGIT) + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # a run of twelve or more with a digit, or any run that is announced
    "secret": _run_start(_TOKEN) + rf"(?:(?=[A-Za-z_/+-]*+[0-9]){_TOKEN}{{12,}}+|{_AFTER_ANNOUNCEMENT}{_TOKEN}++)",
}
#: A text without a match of this cannot match the kind's pattern.
REQUIRES = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]", "secret": rf"[0-9]|{_ASSIGNED}"}
SPAN = "array<struct<s:int,e:int,v:string,p:string>>"


def _matches(kind: str) -> tuple[Column, Column]:
    """All matches of the kind in ``_t`` and the pieces of text around them."""
    may = F.col("_t").rlike(REQUIRES[kind])
    return (
        F.when(may, F.regexp_extract_all("_t", F.lit(PATTERNS[kind]), F.lit(0))),
        F.when(may, F.split("_t", PATTERNS[kind], -1)),
    )


def _located(kind: str) -> Column:
    """Matches with start, end, value and the 24 characters before them."""
    m, p = f"_m_{kind}", f"_p_{kind}"

    def step(acc: Column, i: Column) -> Column:
        start = acc["pos"] + F.length(F.get(p, i))
        end = start + F.length(F.get(m, i))
        span = F.struct(start.alias("s"), end.alias("e"), F.get(m, i).alias("v"), F.right(F.get(p, i), F.lit(24)).alias("p"))
        return F.struct(end.alias("pos"), F.concat(acc["out"], F.array(span)).alias("out")).cast(
            f"struct<pos:int,out:{SPAN}>"
        )

    none = F.array().cast(SPAN)
    start = F.struct(F.lit(0).alias("pos"), none.alias("out")).cast(f"struct<pos:int,out:{SPAN}>")
    found = F.aggregate(F.sequence(F.lit(0), F.size(m) - 1), start, step, lambda acc: acc["out"])
    return F.when(F.size(m) > 0, found).otherwise(none)


def _valid(kind: str, v: Column) -> Column:
    digits = F.regexp_replace(v, "[^0-9]", "")
    if kind == "ip":
        parts = F.split(v, r"\.")
        value = F.transform(parts, lambda x: F.regexp_replace(x, "^0+", ""))
        return F.forall(value, lambda x: (F.length(x) < 3) | ((F.length(x) == 3) & (x <= "255")))
    if kind == "card":

        def luhn(k: Column) -> Column:
            d = F.substring(digits, -k, F.lit(1)).cast("int")
            return F.when(k % 2 == 1, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))

        total = F.aggregate(
            F.sequence(F.lit(1), F.least(F.length(digits), F.lit(19))), F.lit(0), lambda acc, k: acc + luhn(k)
        )
        return F.when(F.length(digits).between(13, 19), total % 10 == 0).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _checked(kind: str) -> Column:
    return F.filter(f"_s_{kind}", lambda x: _valid(kind, x["v"]))


def candidate_spans(docs: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """``carry`` columns, ``_t`` and one span array per kind (``s_<kind>``).

    ``s_secret`` holds the candidates, without what lies in base spans.
    """
    t = docs.select(F.struct(*carry).alias("_in"), F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    cut = t
    for kind in KINDS:
        m, p = _matches(kind)
        cut = cut.withColumns({f"_m_{kind}": m, f"_p_{kind}": p})
    spans = cut.select("_in", "_t", *(_located(kind).alias(f"_s_{kind}") for kind in KINDS))
    base = spans.select(
        "_in",
        "_t",
        "_s_secret",
        *(_checked(k).alias(f"s_{k}") for k in KINDS[:-1]),
    ).withColumn("_base", F.flatten(F.array(*(F.col(f"s_{k}") for k in KINDS[:-1]))))
    def outside(c: Column) -> Column:
        """The parts of a candidate outside base spans, if they would be
        candidates by themselves."""
        hit = F.array_sort(F.filter("_base", lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"])))
        state = f"struct<pos:int,out:{SPAN}>"

        def part(start: Column, end: Column) -> Column:
            before = F.substring("_t", F.greatest(start - 24, F.lit(0)) + 1, F.least(start, F.lit(24)))
            span = F.struct(start.alias("s"), end.alias("e"), F.substring("_t", start + 1, end - start).alias("v"), before.alias("p"))
            return F.when(end > start, F.array(span)).otherwise(F.array().cast(SPAN)).cast(SPAN)

        def step(acc: Column, b: Column) -> Column:
            return F.struct(
                F.greatest(acc["pos"], b["e"]).alias("pos"), F.concat(acc["out"], part(acc["pos"], b["s"])).alias("out")
            ).cast(state)

        start = F.struct(c["s"].alias("pos"), F.array().cast(SPAN).alias("out")).cast(state)
        parts = F.aggregate(hit, start, step, lambda acc: F.concat(acc["out"], part(acc["pos"], c["e"])))
        whole = F.filter(parts, lambda x: ((F.length(x["v"]) >= 12) & x["v"].rlike("[0-9]")) | x["p"].rlike(f"{_ASSIGNED}$"))
        return F.when(F.size(hit) == 0, F.array(c)).otherwise(whole)

    free = F.flatten(F.transform("_s_secret", outside))
    return base.select("_in", "_t", *(f"s_{k}" for k in KINDS[:-1]), free.alias("s_secret"))


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1 where ``yes``, -1 where ``no``, else 0 (abstain)."""
    out = F.when(yes, 1)
    return (out if no is None else out.when(no, -1)).otherwise(0)


def _announced(p: Column) -> Column:
    return F.lower(p).rlike(rf"(?:{_WORDS})")


#: Labelers of a candidate with value ``v`` and preceding text ``p``.
LABELERS = (
    ("regex", lambda v, p: _vote(v.rlike(r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|[0-9a-f]{32,64})$"))),
    ("gazetteer", lambda v, p: _vote(_announced(p))),
    ("context", lambda v, p: _vote(p.rlike(r"[=:]\x20?[\"']?$"), p.rlike(r"[A-Za-z0-9.]$"))),
    ("shape", lambda v, p: _vote(v.rlike(r"(?:[0-9]+[A-Za-z]+){3}"), v.rlike(r"^[0-9-]+$|^[A-Za-z]+[0-9]{1,4}$"))),
    ("wording", lambda v, p: _vote(v.rlike(r"^[0-9A-Z]{16,}$"), v.rlike(r"[a-z]{8}"))),
)

#: Binary features of the span classifier.
FEATURES = (
    ("announced", lambda v, p: _announced(p)),
    ("assigned", lambda v, p: p.rlike(r"[=:]\x20?[\"']?$")),
    ("quoted", lambda v, p: p.rlike(r"[\"']$")),
    ("hexadecimal", lambda v, p: v.rlike("^[0-9a-f]+$") & v.rlike("[a-f]")),
    ("capitals", lambda v, p: v.rlike("^[0-9A-Z]+$") & v.rlike("[A-Z]")),
    ("mixed", lambda v, p: v.rlike(r"(?:[0-9]+[A-Za-z]+){3}")),
    ("digits", lambda v, p: v.rlike("^[0-9-]+$")),
    ("wordlike", lambda v, p: v.rlike("[a-z]{6}")),
    ("long", lambda v, p: F.length(v) >= 16),
    ("path", lambda v, p: v.rlike("/")),
)


@dataclass(frozen=True)
class SpanModel:
    """Reliabilities of the labelers and the classifier's weights."""

    reliability: tuple[tuple[str, float], ...] = ()
    weights: tuple[float, ...] = ()
    bias: float = -1.0

    def likely(self, v: Column, p: Column) -> Column:
        if not self.weights:
            return F.lit(False)
        total = F.lit(self.bias)
        for (_, feature), w in zip(FEATURES, self.weights, strict=True):
            total = total + F.when(feature(v, p), F.lit(w)).otherwise(F.lit(0.0))
        return total > 0


def estimate_reliability(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Two-class expectation-maximisation over vote patterns.

    ``votes`` is patterns x labelers in {-1, 0, 1}.  Returns each pattern's
    probability of being personal data and each labeler's accuracy when it
    votes.  Starts from the votes' sum.
    """
    q = np.clip(0.5 + votes.sum(axis=1) / 4.0, 0.05, 0.95)
    values = np.array([-1, 0, 1])
    seen = votes[:, :, None] == values
    for _ in range(rounds):
        yes, no = q * counts, (1 - q) * counts
        prior = (yes.sum() + 1) / (counts.sum() + 2)
        p_yes = (np.einsum("i,ijk->jk", yes, seen) + 0.5) / (yes.sum() + 1.5)
        p_no = (np.einsum("i,ijk->jk", no, seen) + 0.5) / (no.sum() + 1.5)
        gap = np.log(prior) - np.log1p(-prior) + np.einsum("ijk,jk->i", seen, np.log(p_yes) - np.log(p_no))
        new = 1 / (1 + np.exp(-np.clip(gap, -40, 40)))
        if np.abs(new - q).max() < 1e-9:
            break
        q = new
    right = (counts * q) @ (votes == 1) + (counts * (1 - q)) @ (votes == -1)
    said = counts @ (votes != 0)
    return q, np.where(said > 0, right / np.maximum(said, 1), 0.5)


def train_classifier(x: np.ndarray, yes: np.ndarray, counts: np.ndarray, steps: int = 2000) -> tuple[np.ndarray, float]:
    """Logistic regression on feature patterns with fractional labels."""
    w, b, total = np.zeros(x.shape[1]), 0.0, counts.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -40, 40)))
        gap = (counts * p - yes) / total
        w -= 2.0 * (x.T @ gap + 1e-4 * w)
        b -= 2.0 * gap.sum()
    return w, float(b)


def learn(docs: DataFrame) -> SpanModel:
    """Learn from all candidates of all documents; no labels are needed."""
    spans = candidate_spans(docs, ("text",)).select(F.explode("s_secret").alias("c")).select("c.v", "c.p")
    v, p = F.col("v"), F.col("p")
    vote_names = [f"vote_{name}" for name, _ in LABELERS]
    feature_names = [f"has_{name}" for name, _ in FEATURES]
    patterns = materialize(
        spans.select(
            *(f(v, p).alias(n) for n, (_, f) in zip(vote_names, LABELERS, strict=True)),
            *(f(v, p).cast("int").alias(n) for n, (_, f) in zip(feature_names, FEATURES, strict=True)),
        )
        .groupBy(*vote_names, *feature_names)
        .agg(F.count(F.lit(1)).alias("n")),
        "pii-patterns",
    )
    by_vote = patterns.groupBy(*vote_names).agg(F.sum("n").alias("n")).orderBy(*vote_names).collect()
    if not by_vote:
        return SpanModel()
    votes = np.array([[r[n] for n in vote_names] for r in by_vote])
    q, accuracy = estimate_reliability(votes, np.array([float(r["n"]) for r in by_vote]))
    # probability of every vote pattern, as an expression over the votes
    code = F.concat_ws(",", *vote_names)
    known = F.create_map(*(F.lit(x) for row, prob in zip(votes, q, strict=True) for x in (",".join(map(str, row)), float(prob))))
    by_feature = (
        patterns.groupBy(*feature_names)
        .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.element_at(known, code)).alias("yes"))
        .orderBy(*feature_names)
        .collect()
    )
    x = np.array([[float(r[n]) for n in feature_names] for r in by_feature])
    w, b = train_classifier(x, np.array([r["yes"] for r in by_feature]), np.array([float(r["n"]) for r in by_feature]))
    names = tuple((name, round(float(a), 4)) for (name, _), a in zip(LABELERS, accuracy, strict=True))
    return SpanModel(names, tuple(round(float(c), 6) for c in w), round(b, 6))


def find(docs: DataFrame, model: SpanModel, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns and ``found``: all spans as ``kind, s, e`` structs, by
    kind and then start; ``n_base`` of them, the first ones, are base spans."""
    c = candidate_spans(docs, carry).withColumn(
        "s_secret", F.filter("s_secret", lambda x: model.likely(x["v"], x["p"]))
    )

    def named(kind: str) -> Column:
        return F.transform(f"s_{kind}", lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))

    return c.select(
        *(f"_in.{name}" for name in carry),
        *(F.size(f"s_{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.flatten(F.array(*(named(k) for k in KINDS))).alias("found"),
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def report(docs: DataFrame, model: SpanModel) -> DataFrame:
    """Counts, digest of the base spans and all spans of every document."""
    n_base = F.size("found") - F.col("n_secret").cast("int")
    return find(docs, model).select(
        "doc_id",
        "n_email",
        "n_ip",
        "n_card",
        "n_phone",
        F.sha2(_joined(F.slice("found", F.lit(1), n_base)), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        "n_secret",
    )


def redact(docs: DataFrame, model: SpanModel) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping
    spans become one.  ``n_chars``, where present, follows the new text."""
    rows = docs.select(F.struct("*").alias("_row"), F.col("text"))
    found = find(rows, model, ("_row", "text")).select(
        "_row",
        "text",
        F.sort_array(
            F.transform("found", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")))
        ).alias("_spans"),
    )
    state = "struct<pos:int,out:string>"

    def step(acc: Column, x: Column) -> Column:
        before = F.substring("text", acc["pos"] + 1, x["s"] - acc["pos"])
        mark = F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))
        inside = x["s"] < acc["pos"]
        return F.struct(
            F.greatest(acc["pos"], x["e"]).alias("pos"),
            F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], before, mark)).alias("out"),
        ).cast(state)

    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")).cast(state)
    rest = F.aggregate(
        "_spans", start, step, lambda acc: F.concat(acc["out"], F.substring("text", acc["pos"] + 1, F.length("text")))
    )
    some = F.size("_spans") > 0
    out = found.select("_row", some.alias("_some"), F.when(some, rest).otherwise(F.col("text")).alias("_new"))
    row = F.col("_row").withField("text", F.col("_new"))
    if "n_chars" in docs.columns:
        length = F.when(F.col("_some"), F.length("_new").cast("long")).otherwise(F.col("_row.n_chars"))
        row = row.withField("n_chars", length)
    return out.select(row.alias("_row")).select("_row.*")
