from datetime import datetime
from decimal import Decimal

import pytest

from strata.operators import control, reports
from strata.rules import COLLECTIONS, CollectionSpec

AS_OF = "2024-01-01 00:00:00"


def _registry(spark):
    rows = control.spec_rows(COLLECTIONS.values(), "/lake")
    return control.build_registry(spark, rows, None, AS_OF)


def test_registry_seed(spark):
    reg = {r.collection_name: r for r in _registry(spark).collect()}
    assert reg["customers"].scd_type == 2 and reg["orders"].scd_type == 1
    assert reg["payments"].watermark_column == "created_at"
    assert reg["products"].gold_path == "/lake/gold/top_products" and reg["reviews"].gold_path is None
    assert reg["orders"].last_loaded_timestamp == datetime(1970, 1, 1)


def test_active_collections_sorted(spark):
    names = [r.collection_name for r in control.active_collections(_registry(spark)).collect()]
    assert names == sorted(COLLECTIONS)


def test_upsert_inserts_and_updates_keeping_paths(spark):
    reg = _registry(spark)
    req = spark.createDataFrame(
        control.spec_rows([CollectionSpec("reviews", "rid", "updated_at", 2), CollectionSpec("suppliers", "sid", "ts", 1)], "/other"),
        control.REGISTRY_SCHEMA,
    )
    out = {r.collection_name: r for r in control.registry_upsert(reg, req, "2024-02-01 00:00:00").collect()}
    assert len(out) == 6
    assert out["reviews"].primary_key_column == "rid" and out["reviews"].scd_type == 2
    assert out["reviews"].bronze_path == "/lake/bronze/reviews"  # paths kept on conflict
    assert out["reviews"].updated_at == datetime(2024, 2, 1)
    assert out["suppliers"].bronze_path == "/other/bronze/suppliers" and out["suppliers"].active_flag
    assert out["orders"].updated_at == datetime(2024, 1, 1)


def test_upsert_reactivates(spark):
    reg = control.build_registry(spark, control.spec_rows([COLLECTIONS["orders"]], "/lake", active=False), None, AS_OF)
    req = spark.createDataFrame(control.spec_rows([COLLECTIONS["orders"]], "/lake"), control.REGISTRY_SCHEMA)
    assert control.registry_upsert(reg, req, AS_OF).collect()[0].active_flag is True


def _mark(spark, ts):
    return spark.createDataFrame([(ts,)], "mark timestamp_ntz")


def test_advance_watermark_moves_forward_only(spark):
    reg = _registry(spark)
    moved = control.advance_watermark(reg, "orders", _mark(spark, datetime(2024, 1, 5)), "2024-01-06 00:00:00")
    got = {r.collection_name: r.last_loaded_timestamp for r in moved.collect()}
    assert got["orders"] == datetime(2024, 1, 5) and got["customers"] == datetime(1970, 1, 1)
    back = control.advance_watermark(moved, "orders", _mark(spark, datetime(2023, 1, 1)), "2024-01-07 00:00:00")
    assert {r.collection_name: r.last_loaded_timestamp for r in back.collect()}["orders"] == datetime(2024, 1, 5)
    empty = control.advance_watermark(moved, "orders", _mark(spark, None), "2024-01-07 00:00:00")
    assert {r.collection_name: r.last_loaded_timestamp for r in empty.collect()}["orders"] == datetime(2024, 1, 5)


def test_inactive_collection_does_not_move(spark):
    reg = control.build_registry(spark, control.spec_rows([COLLECTIONS["orders"]], "/lake", active=False), None, AS_OF)
    out = control.advance_watermark(reg, "orders", _mark(spark, datetime(2024, 1, 5)), AS_OF).collect()[0]
    assert out.last_loaded_timestamp == datetime(1970, 1, 1)


def test_audit_record_duration_and_checks(spark):
    r = control.audit_record(spark, "r1", "orders", "bronze", "2024-01-01 00:00:00", "2024-01-01 00:01:30", "SUCCESS", 5, 5).collect()[0]
    assert r.duration_seconds == Decimal("90.00")
    with pytest.raises(ValueError):
        control.audit_record(spark, "r1", "orders", "platinum", AS_OF, AS_OF, "SUCCESS")
    with pytest.raises(ValueError):
        control.audit_record(spark, "r1", "orders", "gold", AS_OF, AS_OF, "DONE")


def test_run_summary_and_recent(spark):
    rows = [
        control.audit_record(spark, f"r{i}", "orders", "bronze", f"2024-01-0{i} 00:00:00", f"2024-01-0{i} 00:00:10", s, 10, 10)
        for i, s in ((1, "SUCCESS"), (2, "FAILED"), (3, "SUCCESS"))
    ]
    audit = rows[0].unionByName(rows[1]).unionByName(rows[2])
    s = reports.run_summary(audit).collect()[0]
    assert (s.total_runs, s.successful_runs, s.failed_runs, s.total_extracted) == (3, 2, 1, 30)
    assert s.last_run == datetime(2024, 1, 3)
    assert [r.run_id for r in reports.recent_runs(audit, 2).collect()] == ["r3", "r2"]
