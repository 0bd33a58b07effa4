from strata.plans import business as B
from strata.rules import COLLECTIONS, CollectionSpec
from strata.session import scratch_path
from strata.sources.publish import read_scd2_full
from strata.plans.jobs import Lake
from strata.streaming.incremental import stream_into_silver

SF = "/root/testdata/sf0.001"


def test_available_now_stream_matches_batch_merge(spark):
    src_root = scratch_path(spark, "stream-src")
    b1, b2 = B.order_batches(spark, SF)
    b1.write.parquet(f"{src_root}/b1")
    schema = b1.schema
    spec = CollectionSpec("orders", "order_id", "updated_at", 2, COLLECTIONS["orders"].rules)
    lake, ckpt = Lake(scratch_path(spark, "stream-lake")), scratch_path(spark, "stream-ckpt")
    table = lake.silver("orders")
    loads = iter([B.LOAD1, B.LOAD2])

    def run():
        q = stream_into_silver(spark, f"{src_root}/*", schema, spec, lake, ckpt, lambda: next(loads))
        q.awaitTermination(300)
        assert q.exception() is None

    run()
    first = read_scd2_full(spark, table).count()
    assert first == b1.count()
    b2.write.parquet(f"{src_root}/b2")
    run()  # only the new files are processed
    full = read_scd2_full(spark, table)
    from strata.plans.queries import QUERIES

    expected = QUERIES["scd2_merge"](spark, SF)
    cols = sorted(expected.columns)
    assert sorted(map(tuple, full.select(cols).collect())) == sorted(map(tuple, expected.select(cols).collect()))


def test_micro_batches_of_one_run_and_redelivery(spark):
    from strata.streaming.incremental import merge_micro_batch

    lake = Lake(scratch_path(spark, "stream-replay"))
    spec = CollectionSpec("orders", "order_id", "updated_at", 2, COLLECTIONS["orders"].rules)
    b1, b2 = B.order_batches(spark, SF)
    fresh = b2.join(b1.select("order_id"), "order_id", "left_anti").select(b1.columns)
    for batch in (b1, fresh, b1, fresh):  # one processing time for all
        merge_micro_batch(batch, spec, lake, *B.LOAD1)
    full = read_scd2_full(spark, lake.silver("orders"))
    assert full.count() == b1.count() + fresh.count()
    assert full.where("NOT is_current OR version_number > 1").count() == 0
