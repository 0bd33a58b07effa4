"""Training-corpus pipeline: filter, deduplicate, decontaminate, redact, mix.

``STAGES`` are ``(name, function)`` pairs; a function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame that is written as Parquet and reread as the
next one's ``docs``.  Every stage works on all that its predecessor kept, and
all but the last return the columns of ``documents``.

- quality: rows that fail the base rules or the learned decision list go;
- near_duplicates: one document of each near-duplicate group stays;
- decontamination: documents that hold a benchmark item go;
- personal_data: spans are replaced by their kind, ``n_chars`` follows;
- mixture: every document once per copy that the mix takes, with ``size,
  source_size, target, copies, taken, copy`` added.

An empty table passes through all stages empty.  ``ORACLE_SQL`` is None: the
decision list and the span classifier are learned, which SQL cannot express;
the tests check the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontam, mixing, neardup, pii, quality
from strata.llm.common import materialize, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, pii.learn(docs))


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("mixture", mixture_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
