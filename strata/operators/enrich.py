"""Bronze enrichment: normalise ids and timestamps, keep a JSON copy, stamp lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import ts_literal

TIMESTAMP_COLUMNS = ("created_at", "updated_at")


def enrich_bronze(
    df: DataFrame,
    collection: str,
    load_date: str,
    as_of: str,
    ts_type: str = "timestamp_ntz",
    run_id: str | None = None,
) -> DataFrame:
    """One projection.  ``raw_document`` is the JSON of the normalised source
    columns, taken before any lineage column is added."""
    cols = []
    for c in df.columns:
        if c == "_id":
            cols.append(F.col(c).cast("string").alias(c))
        elif c in TIMESTAMP_COLUMNS:
            cols.append(F.col(c).try_cast(ts_type).alias(c))
        else:
            cols.append(F.col(c))
    base = df.select(*cols)
    doc = F.to_json(F.struct(*[F.col(c) for c in base.columns]))
    extra = [
        doc.alias("raw_document"),
        F.lit(load_date).alias("load_date"),
        ts_literal(as_of).alias("pipeline_load_ts"),
        F.lit(collection).alias("source_collection"),
    ]
    if run_id is not None:
        extra.append(F.lit(run_id).alias("run_id"))
    return base.select("*", *extra)
