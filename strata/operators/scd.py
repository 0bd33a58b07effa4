"""Slowly changing dimension merges (pure functions; publishing is separate).

SCD Type 1 keeps one row per key: existing rows whose key is absent from the
batch, plus the whole batch stamped with the new load.

SCD Type 2 keeps versions with a validity interval
``[effective_date, expiry_date)``.  The merge reads only the *current* rows
and the batch and performs one full outer join on the key:

====================  ==========================================
current only          kept as is (no delete detection)
batch only            new key -> version 1
both, same hash       kept as is (replaying a batch is a no-op)
both, hash differs    current row closed at ``as_of`` + new version v+1
====================  ==========================================

The 1-2 output rows per key are produced by ``inline`` over an array of
structs, so the join is evaluated once.  Closed history never takes part in
the merge; it is only appended to.  Valid time is processing time (``as_of``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, IntegerType, StringType, TimestampNTZType

from strata.functions.columns import ts_literal
from strata.rules import OPEN_END

SCD2_COLUMNS = ("effective_date", "expiry_date", "is_current", "version_number")
LOAD_COLUMNS = ("pipeline_load_ts", "load_date")
BOOKKEEPING_TYPES: dict[str, DataType] = {
    "effective_date": TimestampNTZType(),
    "expiry_date": TimestampNTZType(),
    "is_current": BooleanType(),
    "version_number": IntegerType(),
    "pipeline_load_ts": TimestampNTZType(),
    "load_date": StringType(),
}


def _content(df: DataFrame) -> list[str]:
    skip = set(SCD2_COLUMNS) | set(LOAD_COLUMNS)
    return [c for c in df.columns if c not in skip]


def require_key(df: DataFrame, key: str) -> DataFrame:
    """Rows with a NULL key can never match a merge and would be re-inserted
    on every load; they are removed before any merge."""
    return df.where(F.col(key).isNotNull())


# --------------------------------------------------------------------------
# Type 1
# --------------------------------------------------------------------------

def stamp_load(df: DataFrame, load_date: str, as_of: str) -> DataFrame:
    keep = [c for c in df.columns if c not in LOAD_COLUMNS]
    return df.select(*keep, ts_literal(as_of).alias("pipeline_load_ts"), F.lit(load_date).alias("load_date"))


def untouched_rows(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Existing rows whose key the batch does not carry (left anti join)."""
    return existing.join(incoming.select(key), key, "left_anti")


def scd1_merge(existing: DataFrame | None, incoming: DataFrame, key: str, load_date: str, as_of: str) -> DataFrame:
    stamped = stamp_load(require_key(incoming, key), load_date, as_of)
    if existing is None:
        return stamped
    return untouched_rows(existing, stamped, key).unionByName(stamped, allowMissingColumns=True)


# --------------------------------------------------------------------------
# Type 2
# --------------------------------------------------------------------------

def unique_batch(incoming: DataFrame, key: str) -> DataFrame:
    """The batch without NULL keys; a repeated key fails the job.

    Two rows of one key would each open a version.  The count runs over the
    exchange and the order by key that the merge's join needs anyway.
    """
    rows = require_key(incoming, key)
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    repeated = F.raise_error(F.concat(F.lit(f"batch repeats {key} "), F.col(key).cast("string"))).cast("boolean")
    return rows.withColumn("_n", n).where(F.when(F.col("_n") > 1, repeated).otherwise(True)).drop("_n")


def scd2_initial(incoming: DataFrame, load_date: str, as_of: str, key: str | None = None) -> DataFrame:
    """First load: every row becomes version 1, open-ended.  With ``key``,
    rows without one are left out and a repeated one fails, as in the merge."""
    if key is not None:
        incoming = unique_batch(incoming, key)
    return incoming.select(
        *_content(incoming),
        ts_literal(as_of).alias("effective_date"),
        ts_literal(OPEN_END).alias("expiry_date"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("version_number"),
        ts_literal(as_of).alias("pipeline_load_ts"),
        F.lit(load_date).alias("load_date"),
    )


def change_detection(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Batch rows classified against the current version of their key.

    A plain left join: the join strategy is Spark's (AQE) to choose.
    """
    cur = current.select(
        F.col(key).alias("_k"),
        F.col("record_hash").alias("previous_hash"),
        F.col("version_number").alias("previous_version"),
    )
    j = incoming.select(key, "record_hash").join(cur, F.col(key) == F.col("_k"), "left")
    kind = (
        F.when(F.col("_k").isNull(), F.lit("new"))
        .when(F.col("record_hash").eqNullSafe(F.col("previous_hash")), F.lit("unchanged"))
        .otherwise(F.lit("changed"))
    )
    return j.select(key, kind.alias("change_type"), "previous_version", "previous_hash", "record_hash")


def late_rows(current: DataFrame, incoming: DataFrame, key: str, as_of: str) -> DataFrame:
    """Changed batch rows whose current version does not begin before
    ``as_of``: closing it would give it an inverted interval.  The merge leaves
    such keys alone; the rows belong in a side output."""
    cur = current.select(F.col(key).alias("_k"), F.col("record_hash").alias("_h"), F.col("effective_date").alias("_from"))
    late = (F.col("_from") >= ts_literal(as_of)) & ~F.col("record_hash").eqNullSafe(F.col("_h"))
    return incoming.join(cur, (F.col(key) == F.col("_k")) & late, "left_semi")


OUTCOME = "_outcome"
CURRENT, CLOSED, LATE = "current", "closed", "late"


def scd2_merge_tagged(current: DataFrame, incoming: DataFrame, key: str, load_date: str, as_of: str) -> DataFrame:
    """Merge a fingerprinted batch into the current rows of an SCD2 table.

    One full outer join on the key gives every output row with its
    ``_outcome``: ``current`` (kept or opened), ``closed`` (ended by this
    merge) or ``late`` (a batch row whose change is not after the begin of the
    version it would close, so it is not applied; its version columns are
    NULL).  One write can deal them to their places.  Replaying a batch changes
    nothing: equal fingerprints are kept.
    """
    incoming = unique_batch(incoming, key)
    out_cols = list(current.columns) + [c for c in incoming.columns if c not in current.columns]
    for c in (*SCD2_COLUMNS, *LOAD_COLUMNS):
        if c not in out_cols:
            out_cols.append(c)
    types: dict[str, DataType] = {f.name: f.dataType for f in incoming.schema.fields}
    types.update({f.name: f.dataType for f in current.schema.fields})
    for name, t in BOOKKEEPING_TYPES.items():
        types.setdefault(name, t)

    def side(prefix: str, frame: DataFrame, name: str) -> Column:
        return F.col(f"{prefix}.{name}") if name in frame.columns else F.lit(None)

    def row(outcome: str, prefix: str, frame: DataFrame, over: dict[str, Column]) -> Column:
        columns = [over.get(n, side(prefix, frame, n)).cast(types[n]).alias(n) for n in out_cols]
        return F.struct(*columns, F.lit(outcome).alias(OUTCOME))

    kept = row(CURRENT, "c", current, {})
    closed = row(CLOSED, "c", current, {"expiry_date": ts_literal(as_of), "is_current": F.lit(False)})
    before = F.coalesce(side("c", current, "version_number").cast("int"), F.lit(0))
    loaded = {"pipeline_load_ts": ts_literal(as_of), "load_date": F.lit(load_date)}
    opened = row(
        CURRENT,
        "i",
        incoming,
        {
            "effective_date": ts_literal(as_of),
            "expiry_date": ts_literal(OPEN_END),
            "is_current": F.lit(True),
            "version_number": before + 1,
            **loaded,
        },
    )
    unapplied = row(LATE, "i", incoming, {**{c: F.lit(None) for c in SCD2_COLUMNS}, **loaded})
    j = current.alias("c").join(incoming.alias("i"), F.col(f"c.{key}") == F.col(f"i.{key}"), "full_outer")
    same = F.col("c.record_hash").eqNullSafe(F.col("i.record_hash"))
    late = F.coalesce(side("c", current, "effective_date").cast("timestamp_ntz") >= ts_literal(as_of), F.lit(False))
    rows = (
        F.when(F.col(f"c.{key}").isNull(), F.array(opened))
        .when(F.col(f"i.{key}").isNull() | same, F.array(kept))
        .when(late, F.array(kept, unapplied))
        .otherwise(F.array(closed, opened))
    )
    return j.select(F.inline(rows))


def scd2_merge(current: DataFrame, incoming: DataFrame, key: str, load_date: str, as_of: str) -> DataFrame:
    """The new current rows *and* the rows closed by this merge
    (``is_current = false``); earlier history is not an input.  See
    :func:`scd2_merge_tagged`; late rows are left out."""
    tagged = scd2_merge_tagged(current, incoming, key, load_date, as_of)
    return tagged.where(F.col(OUTCOME) != LATE).drop(OUTCOME)


def as_of_view(history: DataFrame, at: str) -> DataFrame:
    """Versions valid at time ``at``: ``effective_date <= at < expiry_date``."""
    t = ts_literal(at)
    return history.where((F.col("effective_date") <= t) & (t < F.col("expiry_date")))


def current_view(df: DataFrame) -> DataFrame:
    """Current versions when the table is versioned; the table otherwise."""
    return df.where(F.col("is_current")) if "is_current" in df.columns else df
