"""Exact sums of doubles: the rounded sum of the values, not a sum of roundings.

A double is an integer times a power of two.  Each finite value is split into a
*bin*, a power ``2 ** (32 * bin)`` small enough that the value is a whole
multiple of it, and that multiple as four limbs of 22 bits.  Limbs of a bin are
added up as longs, which is exact in any order and over any partial sums, so a
hot group is summed map-side.  A group's bins (at most ``BINS``, few in
practice: values between 2^-12 and 2^20 share one) are then combined once, with
carries, and rounded to the nearest double, ties to even.

NULLs do not count; no value at all gives NULL.  A NaN, or infinities of both
signs, give NaN; infinities of one sign give that infinity; a sum beyond the
largest double is infinite.  Zeros sum to 0.0.

Bounds: a bin holds at most 2^38 values of a group, beyond which Spark raises
an overflow (ANSI) rather than giving a wrong sum.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN_BITS = 32
LIMB_BITS = 22
LIMBS = 4
#: A bin is chosen from a logarithm that may be off by one either way.
_SLACK = 54
LOWEST = -36  # (-1074 - 54) // 32
HIGHEST = 30  # (1023 + 1 - 54) // 32
BINS = HIGHEST - LOWEST + 1
NAN, PLUS, MINUS = HIGHEST + 1, HIGHEST + 2, HIGHEST + 3
_WIDE = "DECIMAL(38,0)"
_BASE = 1 << BIN_BITS

# The expressions are SQL text: it is parsed at once, where a tree of this size
# built call by call takes longer than the sum.


def _power(half_bins: str) -> str:
    """``2.0 ** (16 * half_bins)``, exactly (tested over the whole range)."""
    return f"power(2.0D, ({half_bins}) * {BIN_BITS // 2})"


def _let(value: str, name: str, body: str) -> str:
    """``body`` of a value that is evaluated once, as ``name``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _bin(v: str) -> str:
    """Bin of a double column; NULL stays NULL, zero goes where money mostly is."""
    finite = f"CAST(floor((floor(log2(abs({v}))) - {_SLACK}) / {BIN_BITS}) AS INT)"
    return (
        f"CASE WHEN isnan({v}) THEN {NAN} WHEN {v} = double('Infinity') THEN {PLUS} WHEN {v} = double('-Infinity') THEN {MINUS} "
        f"WHEN abs({v}) > 0 THEN greatest({finite}, {LOWEST}) WHEN {v} IS NOT NULL THEN -2 END"
    )


def _limbs(scaled: str) -> list[str]:
    """Signed limbs of a multiple of a bin's power, lowest first."""
    # below 2^87: an upper part of 43 bits and a lower one of 44, both whole
    half, mask = f"{float(1 << 2 * LIMB_BITS)!r}D", (1 << LIMB_BITS) - 1
    upper = f"floor(abs({scaled}) / {half})"
    lower = f"CAST(abs({scaled}) - CAST({upper} AS DOUBLE) * {half} AS BIGINT)"
    limbs = [f(part) for part in (lower, upper) for f in (lambda x: f"({x} & {mask}L)", lambda x: f"shiftright({x}, {LIMB_BITS})")]
    return [f"CASE WHEN {scaled} < 0 THEN -{limb} ELSE {limb} END" for limb in limbs]


def _whole(limbs: Sequence[str]) -> str:
    out = f"CAST({limbs[-1]} AS {_WIDE})"
    for limb in reversed(limbs[:-1]):
        out = f"CAST(CAST({out} * {1 << LIMB_BITS} AS {_WIDE}) + {limb} AS {_WIDE})"
    return out


def _digits(sign: int) -> str:
    """Of the array ``parts``: digits in base 2^32, lowest first, and the
    ``carry`` above them.  Four places above the highest bin hold every carry."""
    start = f"named_struct('carry', CAST(0 AS {_WIDE}), 'digits', CAST(array() AS ARRAY<BIGINT>))"
    here = f"aggregate(parts, acc.carry, (s, p) -> CASE WHEN p.b = place THEN CAST(s + p.t * {sign} AS {_WIDE}) ELSE s END)"
    carry = f"CAST(CAST(here - digit AS {_WIDE}) / CAST({_BASE} AS DECIMAL(10,0)) AS {_WIDE})"
    split = f"named_struct('carry', {carry}, 'digits', concat(acc.digits, array(CAST(digit AS BIGINT))))"
    step = _let(here, "here", _let(f"pmod(here, CAST({_BASE} AS {_WIDE}))", "digit", split))
    return f"aggregate(sequence(array_min(parts.b), array_max(parts.b) + 4), {start}, (acc, place) -> {step})"


def _rounded(digits: str) -> str:
    """The digits as a double, rounded once, ties to even."""
    lead = (
        f"aggregate(reverse(slice({digits}, above + 1, top - above + 1)), CAST(0 AS {_WIDE}), "
        f"(s, x) -> CAST(CAST(s * CAST({_BASE} AS DECIMAL(10,0)) AS {_WIDE}) + x AS {_WIDE}))"
    )
    # 65 bits or more stand in front; any rest makes the last one odd
    rest = f"exists(slice({digits}, 1, above), x -> x != 0)"
    sticky = _let(lead, "n", f"CASE WHEN {rest} AND pmod(n, CAST(2 AS {_WIDE})) = 0 THEN CAST(n + 1 AS {_WIDE}) ELSE n END")
    power = _power("array_min(parts.b) + above")
    value = _let("greatest(top - 2, 0)", "above", f"CAST({sticky} AS DOUBLE) * {power} * {power}")
    return f"coalesce({_let(f'array_max(transform({digits}, (x, i) -> CASE WHEN x != 0 THEN i END))', 'top', value)}, 0.0D)"


def combine(column: str) -> Column:
    """One sum from a group's parts: an array column of structs of bin ``b``
    and total ``t``."""
    has = lambda k: f"array_contains(parts.b, {k})"
    single = _let("get(parts, 0)", "one", f"CAST(one.t AS DOUBLE) * {_power('one.b')} * {_power('one.b')}")
    minus = f"-({_let(_digits(-1), 'minus', _rounded('minus.digits'))})"
    carried = _let(_digits(1), "plus", f"CASE WHEN plus.carry >= 0 THEN {_rounded('plus.digits')} ELSE {minus} END")
    body = (
        "CASE WHEN size(parts) = 0 THEN NULL "
        f"WHEN array_max(parts.b) > {HIGHEST} THEN CASE WHEN {has(NAN)} OR ({has(PLUS)} AND {has(MINUS)}) THEN double('NaN') "
        f"WHEN {has(PLUS)} THEN double('Infinity') ELSE double('-Infinity') END "
        f"WHEN size(parts) = 1 THEN {single} ELSE {carried} END"
    )
    return F.expr(_let(f"`{column}`", "parts", body))


def _binned(df: DataFrame, sums: Mapping[str, Column | str]) -> DataFrame:
    """``df`` with the bin ``_b_<sum>`` and the value ``_v_<sum>`` of each sum,
    and the value as a multiple of its bin's power, ``_m_<sum>``."""
    columns = {n: F.col(c) if isinstance(c, str) else c for n, c in sums.items()}
    valued = df.select("*", *(c.cast("double").alias(f"_v_{n}") for n, c in columns.items()))
    binned = valued.select("*", *(F.expr(_bin(f"`_v_{n}`")).alias(f"_b_{n}") for n in columns))
    # in two steps, as the whole power may lie beyond a double
    power = {n: _power(f"-`_b_{n}`") for n in columns}
    return binned.select(
        "*", *(F.expr(f"CASE WHEN `_b_{n}` <= {HIGHEST} THEN `_v_{n}` * {power[n]} * {power[n]} ELSE 0.0D END").alias(f"_m_{n}") for n in columns)
    )


def _limb_columns(name: str) -> list[Column]:
    return [F.expr(limb) for limb in _limbs(f"`_m_{name}`")]


def _parts(name: str) -> Column:
    """A group's bin and its total, or NULL for rows without a value."""
    total = _whole([f"`_l{i}_{name}`" for i in range(LIMBS)])
    return F.expr(f"CASE WHEN `_b_{name}` IS NOT NULL THEN named_struct('b', `_b_{name}`, 't', {total}) END")


def _finished(per_bin: DataFrame, keys: Sequence[str], sums: Sequence[str], merges: Mapping[str, Column]) -> DataFrame:
    """One row per group; at most one entry per combination of bins meets."""
    placed = per_bin.select(*keys, *merges, *(_parts(n).alias(f"_p_{n}") for n in sums))
    merged = placed.groupBy(*keys).agg(
        *(F.collect_list(f"_p_{n}").alias(f"_p_{n}") for n in sums), *(merge.alias(n) for n, merge in merges.items())
    )
    return merged.select(*keys, *(combine(f"_p_{n}").alias(n) for n in sums), *merges)


def exact_sums(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column | str],
    others: Mapping[str, tuple[Column, Column]] | None = None,
) -> DataFrame:
    """``keys``, the exact sums by name, and ``others`` by name: pairs of an
    aggregate over rows and the aggregate that merges its partial results
    (e.g. ``(F.count("x"), F.sum("n"))``), given the partial under its name.

    Two grouped aggregates, both with partial sums before their exchange: by
    key and bins, then by key.
    """
    others = dict(others or {})
    first = _binned(df, sums).groupBy(*keys, *(f"_b_{n}" for n in sums)).agg(
        *(F.sum(limb).alias(f"_l{i}_{n}") for n in sums for i, limb in enumerate(_limb_columns(n))),
        *(rows.alias(n) for n, (rows, _) in others.items()),
    )
    return _finished(first, keys, list(sums), {n: merge for n, (_, merge) in others.items()})


# --------------------------------------------------------------------------
# sums that are kept and changed
# --------------------------------------------------------------------------

SIGN = "_sign"


def signed_state(
    df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column | str], counts: Mapping[str, Column]
) -> DataFrame:
    """Partial sums of rows with a ``_sign`` (1 adds a row, -1 takes it back).

    One row per group and combination of bins: the limbs and number of values
    of each sum, and ``counts`` (whole numbers per row) added up.  A state is
    kept as a table; :func:`merge_states` adds states, :func:`state_totals`
    gives the sums.  Taking back a row that was added leaves no trace of it.
    """
    binned = _binned(df, sums)
    sign = F.col(SIGN)
    columns = [(F.coalesce(c.cast("long"), F.lit(0)) * sign).alias(n) for n, c in counts.items()]
    for n in sums:
        columns += [(limb * sign).alias(f"_l{i}_{n}") for i, limb in enumerate(_limb_columns(n))]
        columns.append((F.col(f"_v_{n}").isNotNull().cast("long") * sign).alias(f"_n_{n}"))
    bins = [f"_b_{n}" for n in sums]
    return _summed(binned.select(*keys, *bins, *columns), [*keys, *bins])


def _summed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    numbers = [c for c in rows.columns if c not in keys]
    out = rows.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in numbers))
    return out.where(F.greatest(*(F.abs(c) for c in numbers)) != 0 if len(numbers) > 1 else F.col(numbers[0]) != 0)


def merge_states(state: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two states as one; groups and bins that cancel out are left out."""
    bins = [c for c in state.columns if c.startswith("_b_")]
    return _summed(state.unionByName(delta), [*keys, *bins])


def state_totals(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys``, the exact sums, ``_n_<sum>`` (values of each) and the counts."""
    sums = [c[3:] for c in state.columns if c.startswith("_b_")]
    counts = [c for c in state.columns if c not in keys and not c.startswith(("_b_", "_l"))]
    live = state
    for n in sums:  # a bin without values left holds nothing
        live = live.withColumn(f"_b_{n}", F.when(F.col(f"_n_{n}") > 0, F.col(f"_b_{n}")))
    return _finished(live, keys, sums, {n: F.sum(n) for n in counts})
