"""Bronze, silver and gold runs composed from the operators.

A run is a few plain calls: read registry -> extract -> write -> record.
Each run writes its output first and only then advances the registry mark and
appends its audit row, so a failed run never moves the mark.  Row counts come
from ``observe`` on the single write, not from extra jobs.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.fingerprint import add_fingerprint
from strata.operators import control, marts
from strata.operators.cleanse import cleanse
from strata.operators.dedupe import latest_per_key
from strata.operators.enrich import enrich_bronze
from strata.operators.items import explode_items, item_features
from strata.operators.evolution import DRIFT_LOG_SCHEMA, RESCUED, compare_schemas, drift_events, reconcile
from strata.operators.scd import (
    LOAD_COLUMNS,
    SCD2_COLUMNS,
    CLOSED,
    CURRENT,
    LATE,
    OUTCOME,
    scd1_merge,
    scd2_initial,
    scd2_merge_tagged,
)
from strata.rules import AUDIT_COLUMNS, CollectionSpec
from strata.session import local_frame, materialized
from strata.sources import logs, manifest
from strata.sources.contracts import conform, contract
from strata.sources.extract import effective_upper, incremental_extract, partition_scan
from strata.sources.publish import (
    observed,
    partition_values,
    publish_buckets,
    publish_version,
    read_snapshot,
    write_partition,
)

BOOKKEEPING = (*SCD2_COLUMNS, *LOAD_COLUMNS, "record_hash", RESCUED)
BRONZE_LINEAGE = ("raw_document", "source_collection", "pipeline_load_ts", "load_date", "run_id")


@dataclass
class Lake:
    """Locations of one lake: layer roots plus the control tables."""

    root: str

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    @property
    def registry(self) -> str:
        return f"{self.root}/control/registry"

    @property
    def audit(self) -> str:
        return f"{self.root}/control/audit"

    @property
    def marks(self) -> str:
        return f"{self.root}/control/marks"

    @property
    def drift(self) -> str:
        return f"{self.root}/control/schema_drift"


@dataclass
class RunResult:
    run_id: str
    status: str
    records_extracted: int = 0
    records_loaded: int = 0
    error: str | None = None
    extra: dict = field(default_factory=dict)


def new_run_id() -> str:
    """Run ids start with a letter so partition discovery never reads one as
    a number."""
    return f"run-{uuid.uuid4().hex[:12]}"


def _now() -> str:
    return _dt.datetime.now(_dt.UTC).strftime("%Y-%m-%d %H:%M:%S.%f")


def _append_audit(spark: SparkSession, lake: Lake, row: DataFrame) -> None:
    logs.append(row, lake.audit)


def read_audit(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """All audit rows: those folded so far and those appended since."""
    return logs.read(spark, lake.audit, control.AUDIT_SCHEMA)


def fold_control_logs(spark: SparkSession, lake: Lake) -> None:
    """Fold the logs of marks, audit and drift, so registry and reports read
    one snapshot and the few files appended since."""
    logs.fold(spark, lake.marks, control.MARKS_SCHEMA, control.latest_marks)
    logs.fold(spark, lake.audit, control.AUDIT_SCHEMA)
    logs.fold(spark, lake.drift, DRIFT_LOG_SCHEMA)


def read_registry(spark: SparkSession, lake: Lake) -> DataFrame:
    reg = read_snapshot(spark, lake.registry)
    if reg is None:
        raise RuntimeError(f"no registry published under {lake.registry}")
    return control.with_marks(reg, logs.read(spark, lake.marks, control.MARKS_SCHEMA, control.latest_marks))


def init_registry(spark: SparkSession, lake: Lake, specs: list[CollectionSpec], as_of: str) -> str:
    rows = control.spec_rows(specs, lake.root)
    return publish_version(control.build_registry(spark, rows, None, as_of), lake.registry)


def _spec_row(spark: SparkSession, lake: Lake, name: str):
    rows = control.collection_by_name(read_registry(spark, lake), name).collect()  # one row by key
    if not rows:
        raise KeyError(f"collection {name!r} is not registered")
    return rows[0]


def run_bronze(
    spark: SparkSession,
    lake: Lake,
    spec: CollectionSpec,
    source: DataFrame,
    load_date: str,
    upper: str,
    as_of: str,
    lookback_from: str | None = None,
    dag_id: str | None = None,
    task_id: str | None = None,
) -> RunResult:
    """Extract ``(mark, upper]`` from ``source`` into bronze partition
    ``(load_date, run_id)``, then advance the mark to the largest watermark
    actually loaded.  An extract without rows writes nothing."""
    run_id = new_run_id()
    start = _now()
    meta = _spec_row(spark, lake, spec.name)
    last = lookback_from or str(meta["last_loaded_timestamp"])
    upper = effective_upper(upper, as_of)
    status, err, n, mark = "SUCCESS", None, 0, None
    try:
        if not meta["active_flag"]:
            raise RuntimeError(f"collection {spec.name} is inactive")
        batch = incremental_extract(source, spec.watermark_column, last, upper)
        if not batch.isEmpty():
            enriched = enrich_bronze(batch, spec.name, load_date, as_of)
            enriched, obs = observed(
                enriched, f"bronze-{run_id}", rows=F.count(F.lit(1)), mark=F.max(spec.watermark_column)
            )
            write_partition(enriched, lake.bronze(spec.name), {"load_date": load_date, "run_id": run_id})
            metrics = obs.get
            n, mark = int(metrics["rows"]), metrics["mark"]
        if mark is not None:
            advance = [(spec.name, mark, run_id, _dt.datetime.fromisoformat(as_of))]
            logs.append(local_frame(spark, advance, control.MARKS_SCHEMA), lake.marks)
    except Exception as exc:  # recorded, then re-raised
        status, err = "FAILED", f"{type(exc).__name__}: {exc}"
        raise
    finally:
        _append_audit(
            spark,
            lake,
            control.audit_record(
                spark, run_id, spec.name, "bronze", start, _now(), status,
                records_extracted=n, records_loaded=n if status == "SUCCESS" else 0,
                watermark_start=last,
                watermark_end=str(mark) if mark is not None else last,
                error_message=err, output_path=lake.bronze(spec.name), dag_id=dag_id, task_id=task_id,
            ),
        )
    return RunResult(run_id, status, n, n)


def align_with_drift_log(
    spark: SparkSession, lake: Lake, collection: str, existing: DataFrame, batch: DataFrame, as_of: str
) -> tuple[DataFrame, DataFrame]:
    """Compare the batch's content columns with the stored table's, append
    one drift-log row per added / dropped / retyped column (resolved, with how),
    and return both frames aligned to one schema."""

    def content(schema: StructType) -> StructType:
        return StructType([f for f in schema.fields if f.name not in BOOKKEEPING])

    old, new = content(existing.schema), content(batch.schema)
    if compare_schemas(old, new):
        logs.append(drift_events(spark, collection, old, new, detected_at=as_of, resolved_at=as_of), lake.drift)
    return reconcile(existing, batch)


def silver_batch(spark: SparkSession, lake: Lake, spec: CollectionSpec, load_date: str) -> DataFrame:
    """Cleansed, deduplicated, fingerprinted batch of one bronze load date.

    The runs of one date may differ in their columns, so schemas are merged.
    """
    raw = partition_scan(spark, lake.bronze(spec.name), "load_date", load_date, merge_schema=True)
    return prepare_batch(raw, spec)


def prepare_batch(raw: DataFrame, spec: CollectionSpec, watched: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Cleanse, latest row per key, fingerprint; orders with an ``items``
    column get their item features beside it.  ``watched`` sees the cleansed
    rows (to count them in the same pass)."""
    clean = cleanse(raw, spec.rules, spec.primary_key)
    if watched is not None:
        clean = watched(clean)
    clean = clean.drop(*[c for c in BRONZE_LINEAGE if c in clean.columns])
    latest = latest_per_key(clean, [spec.primary_key], [spec.watermark_column])
    stamped = add_fingerprint(latest, (*AUDIT_COLUMNS, *spec.fingerprint_exclude), spec.fingerprint_mode)
    return item_features(stamped, keep_items=True) if "items" in stamped.columns else stamped


def _touched_buckets(batch: DataFrame, key: str, buckets: int) -> list[int]:
    """Buckets that hold a key of the batch (at most ``buckets`` numbers)."""
    if buckets == 1:
        return [0]
    keyed = batch.where(F.col(key).isNotNull())
    return sorted(r[0] for r in keyed.select(manifest.bucket_of(key, buckets)).distinct().collect())


def merge_batch(
    spark: SparkSession, lake: Lake, spec: CollectionSpec, batch: DataFrame, load_date: str, as_of: str
) -> dict[str, int]:
    """Merge a prepared batch into the cleansed table and publish a version;
    returns the rows written: ``current``, ``closed`` and ``late``.

    Only the buckets that the batch's keys fall into are read and rewritten,
    in one join and one write.  Replaying a batch leaves the same rows; SCD2
    changes that are not after the version they would close are kept as late
    rows (``publish.read_late``).  The number of buckets is fixed by the first
    load.
    """
    root, key = lake.silver(spec.name), spec.primary_key
    base = manifest.newest(spark, root)
    buckets = spec.buckets if base is None else base.buckets
    touched = _touched_buckets(batch, key, buckets)
    existing = None
    if base is not None:
        # the table's columns, also those that these buckets do not have yet
        mine = [f for f in base.current if f.bucket in set(touched)]
        existing = manifest.read(spark, root, mine, base.schema() if buckets > 1 else None)
        existing, batch = align_with_drift_log(spark, lake, spec.name, existing, batch, as_of)
    if spec.scd_type == 1:
        tagged = scd1_merge(existing, batch, key, load_date, as_of).withColumn(OUTCOME, F.lit(CURRENT))
    elif existing is None:
        tagged = scd2_initial(batch, load_date, as_of, key).withColumn(OUTCOME, F.lit(CURRENT))
    else:
        tagged = scd2_merge_tagged(existing, batch, key, load_date, as_of)
    return publish_buckets(tagged, root, key, buckets, touched, base)[1]


def run_silver(
    spark: SparkSession,
    lake: Lake,
    spec: CollectionSpec,
    load_date: str,
    as_of: str,
    dag_id: str | None = None,
    task_id: str | None = None,
) -> RunResult:
    """Merge one bronze load into the cleansed table (SCD1 or SCD2) and
    publish it as a new version.  A load date without a partition (nothing was
    extracted) changes nothing.

    The audit row counts rows that cleansing rejected as failed and late SCD2
    rows as skipped.
    """
    run_id = new_run_id()
    start = _now()
    status, err = "SUCCESS", None
    seen = {"in": 0, "out": 0, "failed": 0, "late": 0}
    root = lake.silver(spec.name)
    try:
        if load_date in partition_values(spark, lake.bronze(spec.name), "load_date"):
            raw = partition_scan(spark, lake.bronze(spec.name), "load_date", load_date, merge_schema=True)
            raw, obs_raw = observed(raw, f"silver-raw-{run_id}")
            kept: list = []

            def watched(clean: DataFrame) -> DataFrame:
                clean, obs = observed(clean, f"silver-clean-{run_id}")
                kept.append(obs)
                return clean

            batch, obs_in = observed(prepare_batch(raw, spec, watched), f"silver-in-{run_id}")
            written = merge_batch(spark, lake, spec, materialized(batch, f"silver-{spec.name}"), load_date, as_of)
            seen = {
                "in": int(obs_in.get["rows"]),
                "out": written[CURRENT] + written[CLOSED],
                "failed": int(obs_raw.get["rows"]) - int(kept[0].get["rows"]),
                "late": written[LATE],
            }
    except Exception as exc:
        status, err = "FAILED", f"{type(exc).__name__}: {exc}"
        raise
    finally:
        _append_audit(
            spark,
            lake,
            control.audit_record(
                spark, run_id, spec.name, "silver", start, _now(), status,
                records_extracted=seen["in"], records_loaded=seen["out"], records_failed=seen["failed"],
                records_skipped=seen["late"], error_message=err, output_path=root, dag_id=dag_id, task_id=task_id,
            ),
        )
    return RunResult(run_id, status, seen["in"], seen["out"])


def run_gold(
    spark: SparkSession,
    lake: Lake,
    report_date: str,
    as_of: str,
    order_lines: DataFrame | None = None,
    dag_id: str | None = None,
    task_id: str | None = None,
) -> RunResult:
    """Build the three marts; one failing mart does not stop the others.

    A mart sees the current rows of an SCD2 table only.  Order lines come
    from the ``items`` of the cleansed orders unless a line table is given.

    Status: SUCCESS (all built), PARTIAL (some), FAILED (none).
    """
    run_id = new_run_id()
    start = _now()

    def cur(name: str) -> DataFrame:
        df = read_snapshot(spark, lake.silver(name))
        if df is None:
            raise RuntimeError(f"{name} has not been published")
        return df

    def lines() -> DataFrame:
        return explode_items(cur("orders")) if order_lines is None else order_lines

    builders = {
        "customer_sales_summary": lambda: marts.customer_sales_summary(cur("customers"), cur("orders"), as_of=as_of),
        "order_analytics": lambda: marts.order_analytics(cur("orders"), cur("customers"), as_of=as_of),
        "top_products": lambda: marts.top_products(cur("products"), lines(), cur("reviews"), as_of=as_of),
    }

    def shaped(name: str, mart: DataFrame) -> DataFrame:
        return conform(mart, contract(f"gold_{name}")).drop("report_date")

    built, errors, rows = [], {}, 0
    for name, build in builders.items():
        try:
            df, obs = observed(shaped(name, build()), f"gold-{name}-{run_id}")
            write_partition(df, lake.gold(name), {"report_date": report_date})
            rows += int(obs.get["rows"])
            built.append(name)
        except Exception as exc:  # isolate marts
            errors[name] = f"{type(exc).__name__}: {exc}"
    status = "SUCCESS" if not errors else ("PARTIAL" if built else "FAILED")
    _append_audit(
        spark,
        lake,
        control.audit_record(
            spark, run_id, "gold", "gold", start, _now(), status,
            records_loaded=rows, error_message="; ".join(f"{k}: {v}" for k, v in errors.items()) or None,
            output_path=lake.gold(""), dag_id=dag_id, task_id=task_id,
        ),
    )
    return RunResult(run_id, status, 0, rows, "; ".join(errors.values()) or None, {"built": built})
