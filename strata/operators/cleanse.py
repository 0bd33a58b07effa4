"""Rule-driven cleansing, generated as one projection (no withColumn loops).

Order of steps follows the reference: drop rows with NULL required values
(before trimming, so blanks survive unless ``blank_as_null``), trim string
columns, lower-case ``lower_cols``, cast timestamps and numerics, add derived
columns, drop bronze-only columns.  Rules only touch columns that exist.
Casts are ``try_cast``: a malformed value becomes NULL instead of failing the
job under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.rules import CleanseRules


def drop_missing_required(df: DataFrame, required: Iterable[str]) -> DataFrame:
    present = [c for c in required if c in df.columns]
    return df.dropna(how="any", subset=present) if present else df


def _clean_column(name: str, rules: CleanseRules) -> Column:
    c = F.col(name)
    if name in rules.string_cols:
        c = F.trim(c)
        if rules.blank_as_null:
            c = F.when(c == "", F.lit(None)).otherwise(c)
    if name in rules.lower_cols and name in rules.string_cols:
        c = F.lower(c)
    if name in rules.ts_cols:
        c = c.try_cast(rules.ts_type)
    if name in rules.numeric_cols:
        c = c.try_cast("double")
    return c.alias(name)


def clean_columns(df: DataFrame, rules: CleanseRules) -> DataFrame:
    """Trim / lower / cast in a single select."""
    return df.select(*[_clean_column(c, rules) for c in df.columns])


def add_derived(df: DataFrame, rules: CleanseRules) -> DataFrame:
    present = set(df.columns)
    extra = [F.expr(d.expr).alias(d.name) for d in rules.derived if set(d.inputs) <= present]
    if not extra:
        return df
    names = {d.name for d in rules.derived if set(d.inputs) <= present}
    return df.select(*[c for c in df.columns if c not in names], *extra)


def cleanse(df: DataFrame, rules: CleanseRules, primary_key: str | None = None) -> DataFrame:
    """Full cleansing pass.  ``primary_key`` is always treated as required."""
    required = list(rules.required)
    if primary_key and primary_key not in required:
        required.insert(0, primary_key)
    out = drop_missing_required(df, required)
    if rules.blank_as_null:
        out = clean_columns(out, rules)
        out = drop_missing_required(out, required)
    else:
        out = clean_columns(out, rules)
    out = add_derived(out, rules)
    drop = [c for c in rules.drop_cols if c in out.columns]
    return out.drop(*drop) if drop else out
